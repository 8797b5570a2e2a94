"""File scans: CSV, the event lake, seeds, vocabulary tables."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tunemill import schemas
from tunemill.functions.time import time_bucket
from tunemill.sources.seeds import STATE_NAMES


def csv_scan(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV with a header line. Without a schema the column types are inferred.

    A quote inside a quoted value is written twice, as most tools write it.
    """
    reader = spark.read.option("header", True).option("escape", '"')
    # FAILFAST: a row that does not fit must not turn into NULLs unseen.
    reader = reader.schema(schema).option("mode", "FAILFAST") if schema is not None \
        else reader.option("inferSchema", True)
    return reader.csv(path)


def csv_to_parquet(spark: SparkSession, src: str, dst: str,
                   schema: T.StructType | None = None) -> None:
    """Convert a CSV file or folder to Parquet."""
    if not src.rstrip("/").endswith("csv"):
        raise ValueError(f"not a csv input: {src}")
    csv_scan(spark, src, schema).write.mode("overwrite").parquet(dst)


def load_seed(spark: SparkSession, path: str | None = None, trim_seed: bool = False) -> DataFrame:
    """State codes and names. One key carries a trailing blank; ``trim_seed`` removes it.

    The shipped table is a literal of 57 rows: no file has to be present on the
    executors, and the optimizer knows how small it is.
    """
    if path is None:
        pair = F.split("line", ",")
        seed = (spark.range(1)
                .select(F.explode(F.split(F.lit(STATE_NAMES.strip("\n")), "\n")).alias("line"))
                .select(pair[0].alias("stateCode"), pair[1].alias("stateName")))
    else:
        seed = csv_scan(spark, path, schemas.STATE_CODES)
    return seed.withColumn("stateCode", F.trim("stateCode")) if trim_seed else seed


def slot_parts(slot: datetime) -> dict[str, object]:
    """Partition values of the five-minute slot that starts at ``slot``."""
    start = slot.replace(minute=slot.minute - slot.minute % 5, second=0, microsecond=0)
    return {
        "year": start.year, "month": start.month, "day": start.day, "hour": start.hour,
        "five_minute_interval": start.strftime("%Y-%m-%d %H-%M"),
    }


def lake_slice(spark: SparkSession, base: str, topic: str, slot: datetime) -> DataFrame:
    """Rows of exactly one slot, without the partition columns.

    Reads the slot's own directory, so the driver lists that one and not the
    hundred thousand of a year. A slot nobody wrote to has no rows; a lake that
    isn't there is an error.
    """
    schema = schemas.lake_schema(topic)
    parts = slot_parts(slot)
    path = "/".join([base.rstrip("/"), *(f"{k}={v}" for k, v in parts.items())])
    try:
        rows = spark.read.schema(schema).option("basePath", base).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        spark.read.schema(schema).parquet(base)  # raises unless the topic's folder exists
        rows = spark.createDataFrame([], schema)
    return rows.select(*[c for c in schema.names if c not in schemas.LAKE_PARTS])


def lake_scan(spark: SparkSession, base: str, topic: str) -> DataFrame:
    """The whole lake of a topic; filters on the partition columns prune directories."""
    schema = schemas.lake_schema(topic)
    return spark.read.schema(schema).parquet(base).select(*schema.names)


def _utc(moment: datetime) -> datetime:
    return moment if moment.tzinfo else moment.replace(tzinfo=timezone.utc)


def staging_scan(spark: SparkSession, path: str, topic: str, start: datetime | None = None,
                 end: datetime | None = None) -> DataFrame:
    """Staging columns of the rows with ``start <= ts < end``; the hour prunes partitions."""
    rows = spark.read.schema(schemas.staging_table_schema(topic)).parquet(path)
    hour = F.to_timestamp("ts_hour", "yyyy-MM-dd HH")
    if start is not None:
        first = F.lit(_utc(start))
        rows = rows.where((hour >= time_bucket(first, "hour")) & (F.col("ts") >= first))
    if end is not None:
        last = F.lit(_utc(end))
        rows = rows.where((hour < last) & (F.col("ts") < last))
    return rows.select(*schemas.STAGING[topic].names)


def save_vocab(vocab: DataFrame, path: str) -> None:
    vocab.select("label", "song").write.mode("overwrite").parquet(path)


def load_vocab(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("label bigint, song string").parquet(path)
