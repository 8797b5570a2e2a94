"""A table of the latest row of each key, kept up to date by the batches of a stream.

The rows lie in buckets by a hash of the key. A batch rewrites the buckets it touches into a folder of
its own and then adds a manifest, a small file that names the folder of every bucket; readers take the
newest whole manifest, so they see all of a batch or nothing. Folders carry the id of the streaming query,
which belongs to the checkpoint, so neither a replayed batch nor a new checkpoint can write over what is
there.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tunemill.streaming.sinks import TRIGGER, triggered

BUCKETS = 16
BUCKET = "_bucket"
_MANIFESTS = "_manifests"


def _folder(spark: SparkSession, path: str):
    """Hadoop's file system and path, which reach whatever Spark can write to."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _versions(spark: SparkSession, path: str) -> list[int]:
    fs, at = _folder(spark, f"{path}/{_MANIFESTS}")
    if not fs.exists(at):
        return []
    return sorted(int(f.getPath().getName().split(".")[0]) for f in fs.listStatus(at)
                  if f.getPath().getName().endswith(".json"))


def _read_manifest(spark: SparkSession, path: str, version: int) -> dict | None:
    """A manifest, or nothing if its writer was lost before it was whole."""
    fs, at = _folder(spark, f"{path}/{_MANIFESTS}/{version:012d}.json")
    stream = fs.open(at)
    try:
        text = bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()
    try:
        return json.loads(text)
    except ValueError:
        return None


def manifest(spark: SparkSession, path: str) -> dict:
    """The newest whole manifest: ``version``, ``buckets`` by number, and the last batch ``applied`` of each query."""
    for version in reversed(_versions(spark, path)):
        found = _read_manifest(spark, path, version)
        if found is not None:
            return found
    return {"version": 0, "buckets": {}, "applied": {}}


def _add_manifest(spark: SparkSession, path: str, content: dict) -> None:
    version = max(_versions(spark, path), default=0) + 1
    fs, at = _folder(spark, f"{path}/{_MANIFESTS}/{version:012d}.json")
    stream = fs.create(at, False)  # fails if another writer took the number
    try:
        stream.write(bytearray(json.dumps({**content, "version": version}).encode()))
    finally:
        stream.close()


def _bucket(keys: tuple[str, ...], buckets: int):
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def upsert(batch: DataFrame, path: str, keys: tuple[str, ...], source: str, number: int,
           buckets: int = BUCKETS) -> bool:
    """Put the rows of ``batch``, one a key, in place of those with their keys. False if it was applied before.

    Only touched buckets are read and written. All writers of a table must use one number of buckets.
    """
    spark = batch.sparkSession
    now = manifest(spark, path)
    if now["applied"].get(source, -1) >= number:
        return False
    rows = batch.withColumn(BUCKET, _bucket(keys, buckets))
    touched = [r[0] for r in rows.select(BUCKET).distinct().collect()]  # no more than there are buckets
    held = [now["buckets"][str(b)] for b in touched if str(b) in now["buckets"]]
    if held:
        old = spark.read.schema(batch.schema).parquet(*[f"{path}/{h}" for h in held])
        on = [F.col(f"_old.{k}").eqNullSafe(F.col(f"_new.{k}")) for k in keys]
        stay = old.alias("_old").join(batch.select(*keys).alias("_new"), on, "left_anti")
        rows = stay.withColumn(BUCKET, _bucket(keys, buckets)).unionByName(rows)
    folder = f"data/{source}-{number}-{uuid.uuid4().hex}"
    # AQE splits a large bucket into several files
    rows.hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(f"{path}/{folder}")
    _add_manifest(spark, path, {
        "buckets": now["buckets"] | {str(b): f"{folder}/{BUCKET}={b}" for b in touched},
        "applied": now["applied"] | {source: number}})
    return True


def keyed_table_sink(df: DataFrame, path: str, checkpoint: str, keys: tuple[str, ...],
                     trigger: str = TRIGGER, buckets: int = BUCKETS) -> DataStreamWriter:
    """Aggregates in update mode to a table with the latest row of each key; see :func:`read_state`."""
    def write(batch: DataFrame, batch_id: int) -> None:
        source = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        upsert(batch, path, keys, source, batch_id, buckets)

    writer = df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).outputMode("update")
    return triggered(writer, trigger)


def read_state(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """The latest row of every key. The folders are those of one manifest, also while batches come in."""
    folders = [f"{path}/{f}" for f in manifest(spark, path)["buckets"].values()]
    return spark.read.schema(like.schema).parquet(*folders) if folders else spark.createDataFrame([], like.schema)


def compact(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Delete manifests but the newest ``keep`` whole ones, and data that none of those names. Number of folders gone.

    Call it when no batch is being written. A batch's folder goes when all of its buckets were replaced.
    """
    whole = [(v, found) for v in _versions(spark, path) if (found := _read_manifest(spark, path, v)) is not None]
    kept = whole[-keep:]
    named = {folder.rsplit("/", 1)[0] for _, found in kept for folder in found["buckets"].values()}
    fs, data = _folder(spark, f"{path}/data")
    gone = 0
    for entry in fs.listStatus(data) if fs.exists(data) else []:
        if f"data/{entry.getPath().getName()}" not in named:
            fs.delete(entry.getPath(), True)
            gone += 1
    for version in set(_versions(spark, path)) - {v for v, _ in kept}:
        fs.delete(_folder(spark, f"{path}/{_MANIFESTS}/{version:012d}.json")[1], False)
    return gone
