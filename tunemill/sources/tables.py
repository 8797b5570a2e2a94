"""Staging and warehouse tables as Parquet folders, and views."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tunemill import schemas
from tunemill.functions.time import five_minute_interval, ts_hour

# Shuffled bytes that a task of a partitioned write takes at most. They are packed: rows of the fact, whose
# keys repeat, take ten times as much where the task sorts them by partition.
TASK_BYTES = 16 << 20
_ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


@contextmanager
def small_tasks(spark: SparkSession, size: int = TASK_BYTES) -> Iterator[None]:
    """AQE deals out ``size`` bytes a task at most to what runs here; a session that asks for less gets less."""
    before = spark.conf.get(_ADVISORY, None)
    now = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(_ADVISORY))
    spark.conf.set(_ADVISORY, f"{min(now, size)}b")
    try:
        yield
    finally:
        spark.conf.unset(_ADVISORY) if before is None else spark.conf.set(_ADVISORY, before)


def ensure_table(spark: SparkSession, path: str, topic: str) -> None:
    """Create the hour-partitioned staging table unless it is there already."""
    empty = spark.createDataFrame([], schemas.staging_table_schema(topic))
    empty.write.mode("ignore").partitionBy(*schemas.STAGING_PARTS).parquet(path)


def append_staging(df: DataFrame, path: str, topic: str, mode: str = "append") -> None:
    """Add staged rows to the table.

    ``append`` adds them again on a rerun. ``replace_slot`` overwrites just the
    slots present in ``df``, so a rerun leaves the table as it was.
    """
    if mode not in ("append", "replace_slot"):
        raise ValueError(f"unknown mode: {mode}")
    rows = df.select(*schemas.STAGING[topic].names).withColumns({
        "ts_hour": ts_hour(F.col("ts")), "slot": five_minute_interval(F.col("ts"))})
    # AQE evens out the write: it merges small slots and splits a hot one.
    writer = rows.hint("rebalance", *schemas.STAGING_PARTS).write
    if mode == "replace_slot":
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        writer = writer.mode("append")
    writer.partitionBy(*schemas.STAGING_PARTS).parquet(path)


def clear_slots(spark: SparkSession, path: str, slots: DataFrame) -> int:
    """Delete the folders of ``slots`` (column ``slot``) from a staging table; how many there were.

    The names come to the driver one partition at a time. A slot belongs to one hour, the one it starts in.
    """
    root = spark._jvm.org.apache.hadoop.fs.Path
    fs = root(path).getFileSystem(spark._jsc.hadoopConfiguration())
    hour, slot = schemas.STAGING_PARTS
    gone = 0
    for row in slots.select("slot").toLocalIterator():
        gone += fs.delete(root(f"{path}/{hour}={row.slot[:13]}/{slot}={row.slot}"), True)
    return gone


def drop_slice(spark: SparkSession, name: str) -> bool:
    """Forget a temporary view; its files stay."""
    return spark.catalog.dropTempView(name)


def materialize(df: DataFrame, path: str, hour_of: str | None = None,
                only_hours: bool = False) -> None:
    """Full refresh of a table, partitioned by the hour of ``hour_of`` when given.

    With ``only_hours`` just the hours present in ``df`` are replaced.
    """
    if hour_of is None:
        df.write.mode("overwrite").parquet(path)
        return
    rows = df.withColumn("ts_hour", ts_hour(F.col(hour_of)))
    writer = rows.hint("rebalance", "ts_hour").write.mode("overwrite").partitionBy("ts_hour")
    if only_hours:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    with small_tasks(df.sparkSession):
        writer.parquet(path)


def read_table(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """Read a materialized table back with the columns of ``like``, without inference."""
    return spark.read.schema(like.schema).parquet(path).select(*like.columns)


def register_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


def compact_slots(spark: SparkSession, base: str, out: str, topic: str) -> None:
    """Rewrite lake files into few per slot; a micro-batch sink leaves one per task."""
    rows = spark.read.schema(schemas.lake_schema(topic)).parquet(base)
    (rows.hint("rebalance", *schemas.LAKE_PARTS).write.mode("overwrite")
         .partitionBy(*schemas.LAKE_PARTS).parquet(out))
