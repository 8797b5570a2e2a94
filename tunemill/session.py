"""Session factory and the shared working folder of a run."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on. Executor sizes and shuffle.partitions stay with
# spark-submit, because they depend on the cluster and not on the code.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Hot join keys are split even when that costs one more exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

ROCKSDB_STATE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def get_session(app_name: str, master: str | None = None, rocksdb: bool = False,
                conf: dict[str, str] | None = None) -> SparkSession:
    """Get or create the session; without ``master`` spark-submit decides."""
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    settings = {**BASE_CONF, **(ROCKSDB_STATE if rocksdb else {}), **(conf or {})}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor can reach, as named in ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of its own: on a cluster a
    machine-local path would be lost together with the executor.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    own = spark.conf.get("spark.tunemill.localDir", None)
    if own is None:
        own = tempfile.mkdtemp(prefix="tunemill-")
        spark.conf.set("spark.tunemill.localDir", own)
    return own


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other call gets."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage with files that outlive any executor, stores the rows
    columnar, and gives the optimizer true sizes for whatever joins it next.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
