"""Stream sinks. Each query has a checkpoint folder of its own."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from tunemill import schemas
from tunemill.streaming.ingest import CORRUPT

TRIGGER = "60 seconds"
BATCH = "batch_id"
LANDED = "landed"
# Rows of one slot that a task lands.
TASK_ROWS = 1_000_000


def triggered(writer: DataStreamWriter, trigger: str) -> DataStreamWriter:
    """``trigger`` is an interval, or ``available`` for all data there is and then stop."""
    if trigger == "available":
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=trigger)


def lake_sink(df: DataFrame, path: str, checkpoint: str, trigger: str = TRIGGER,
              mode: str = "append", fmt: str = "parquet") -> DataStreamWriter:
    """Files partitioned by year, month, day, hour and five-minute slot."""
    writer = (df.writeStream.format(fmt).partitionBy(*schemas.LAKE_PARTS)
              .option("path", path).option("checkpointLocation", checkpoint).outputMode(mode))
    return triggered(writer, trigger)


def spread_slots(rows: DataFrame, tasks: int, most: int = TASK_ROWS) -> DataFrame:
    """Lake rows dealt to ``tasks`` partitions by slot; a slot of more than ``most`` rows to as many as it fills.

    So a slot has one file, however many rows the others have, and a slot with most of the rows has several.
    """
    parts = schemas.LAKE_PARTS
    large = rows.groupBy(*parts).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > most).select(
        *[F.col(c).alias(f"_{c}") for c in parts], F.ceil(F.col("_n") / most).alias("_shares"))
    on = [F.col(c) == F.col(f"_{c}") for c in parts]
    # One row per ``most`` rows at most, so the hint has a bound.
    sized = rows.join(F.broadcast(large), on, "left")
    share = F.pmod(F.xxhash64(*rows.columns), F.coalesce("_shares", F.lit(1)))
    return sized.repartition(tasks, *parts, share).select(*rows.columns)


def checked_lake_sink(df: DataFrame, path: str, quarantine: str, checkpoint: str,
                      trigger: str = TRIGGER) -> DataStreamWriter:
    """Rows of ``ingest_checked`` to two places: good ones to the lake, the text of the others to ``quarantine``.

    Each batch is read once, stored beside the checkpoint, and written from there to both. In both places
    the last partition column, ``landed``, names the query and its batch. A batch that has landed is marked
    and never lands again; one that was lost on the way overwrites what it had landed. So a replayed batch
    is there once, and a new checkpoint leaves what others landed.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        landed = f"{spark.sparkContext.getLocalProperty('sql.streaming.queryId')}-{batch_id}"
        held, mark = (spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/{d}/{landed}") for d in ("held", "landed"))
        fs = held.getFileSystem(spark._jsc.hadoopConfiguration())
        if fs.exists(mark):
            return
        tried = fs.exists(held)
        batch.write.mode("overwrite").parquet(held.toString())
        rows = spark.read.schema(batch.schema).parquet(held.toString()).withColumn(LANDED, F.lit(landed))
        shares = 1 + rows.count() // TASK_ROWS  # from the file footers
        good = spread_slots(rows.where(F.col(CORRUPT).isNull()).drop(CORRUPT),
                            max(shares, spark.sparkContext.defaultParallelism))
        bad = rows.where(F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias("value"), LANDED)
        for part, to, by in ((good, path, (*schemas.LAKE_PARTS, LANDED)), (bad, quarantine, (LANDED,))):
            (part.write.mode("overwrite" if tried else "append").option("partitionOverwriteMode", "dynamic")
             .partitionBy(*by).parquet(to))
        fs.create(mark, True).close()
        fs.delete(held, True)

    writer = df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).outputMode("append")
    return triggered(writer, trigger)


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    """The messages that couldn't land, and the batch that met them: ``value, landed``."""
    return spark.read.schema(f"value string, {LANDED} string").parquet(path)


def table_sink(df: DataFrame, path: str, checkpoint: str, mode: str = "append",
               trigger: str = TRIGGER, fmt: str = "parquet") -> DataStreamWriter:
    """Aggregates to a table whose partitions are the micro-batches.

    A batch overwrites its own partition, so a batch that runs twice after a
    failure is stored once. In append mode the table is the result. In update
    mode it is a log of changed keys, which costs a batch no more than what
    changed; :func:`latest_rows` gives the state of each key.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.format(fmt).mode("overwrite").save(f"{path}/{BATCH}={batch_id}")

    writer = (df.writeStream.foreachBatch(write)
              .option("checkpointLocation", checkpoint).outputMode(mode))
    return triggered(writer, trigger)


def read_log(spark: SparkSession, path: str, like: DataFrame, fmt: str = "parquet") -> DataFrame:
    """All rows a :func:`table_sink` wrote, with the batch they came from."""
    return spark.read.format(fmt).schema(like.schema.add(BATCH, T.LongType())).load(path)


def latest_rows(log: DataFrame, *keys: str) -> DataFrame:
    """The newest row per key of an update log; older ones go in the map-side combine."""
    rest = [c for c in log.columns if c not in keys and c != BATCH]
    newest = log.groupBy(*keys).agg(F.max_by(F.struct(*rest), BATCH).alias("_row"))
    return newest.select(*keys, "_row.*")


def console_sink(df: DataFrame, mode: str = "append") -> DataStreamWriter:
    return df.writeStream.format("console").option("truncate", False).outputMode(mode)


def memory_sink(df: DataFrame, name: str, mode: str = "append") -> DataStreamWriter:
    """In-memory table on the driver, for tests and short demonstrations."""
    return df.writeStream.format("memory").queryName(name).outputMode(mode)


def kafka_stream_sink(df: DataFrame, servers: str, topic: str, checkpoint: str,
                      trigger: str = TRIGGER) -> DataStreamWriter:
    writer = (df.writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
              .option("topic", topic).option("checkpointLocation", checkpoint))
    return triggered(writer, trigger)
