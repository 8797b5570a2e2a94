"""Numbering rows in a total order without one task seeing them all."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tunemill.session import written

# monotonically_increasing_id() keeps the row number of a task in its low 33 bits.
_ROW_BITS = (1 << 33) - 1


def with_global_index(df: DataFrame, *order: str, name: str = "idx") -> DataFrame:
    """Add ``name``: the 0-based place of each row in the order of ``order``.

    The rows are range-partitioned and sorted, so a row's place is the number
    of rows in the partitions before plus its place in its own. Range bounds
    come from a sample; the placed rows are therefore written once, and the
    counts and the numbering both read those files. ``order`` should tell all
    rows apart, otherwise the place of equal rows is arbitrary.
    """
    placed = written(
        df.repartitionByRange(*order).sortWithinPartitions(*order)
          .withColumn("_part", F.spark_partition_id())
          .withColumn("_row", F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_BITS))),
        "placed")
    # One row per partition, so this window and its broadcast have a fixed bound.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
               .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")))
    return (placed.join(F.broadcast(offsets), "_part")
            .withColumn(name, F.col("_offset") + F.col("_row"))
            .drop("_part", "_row", "_offset"))


def sort_events(df: DataFrame) -> DataFrame:
    """All events by user and time. Range partitions spread a busy user by time."""
    return df.orderBy("userId", "ts")


def sort_within_user(df: DataFrame) -> DataFrame:
    """Rows of each user together and in time order, without a total sort.

    The range covers the time as well, so a user too big for one partition goes
    on in the next.
    """
    return df.repartitionByRange("userId", "ts").sortWithinPartitions("userId", "ts")


def preview(df: DataFrame, *order: str, n: int = 5) -> DataFrame:
    """The first ``n`` rows in a given order; each task keeps ``n`` rows."""
    return df.orderBy(*order).limit(n)
