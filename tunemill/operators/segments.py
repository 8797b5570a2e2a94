"""Order-dependent work on the rows of a key, without one task that sees a whole key.

The rows are range-partitioned by the key and an ordering column, so a busy key is spread over as many
partitions as its size asks for, and the rows of one key in one partition are a segment. Only the first
and the last key of a partition can have rows in another one. So what a window would carry along a key is
found in two steps: inside each segment, and over one summary row per segment of those few keys.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tunemill.session import written

PART = "_part"
# Rows of a segment at most, but for what range bounds from a sample miss: the work of one task.
SEGMENT_ROWS = 1_000_000


@dataclass(frozen=True)
class Segments:
    """Rows in segments, with the number of their partition as ``_part``, and how many partitions there are."""

    rows: DataFrame
    parts: int

    def of(self, rows: DataFrame, name: str) -> Segments:
        """Other rows that are cut in the same way, stored if summaries will read them too."""
        return Segments(rows if self.parts == 1 else written(rows, name), self.parts)


def in_segments(df: DataFrame, keys: Iterable[str], at: str) -> Segments:
    """``df`` placed by ``keys`` and ``at``, :data:`SEGMENT_ROWS` rows a partition or about so.

    Rows equal in ``keys`` and ``at`` are in one segment, and later segments of a key have later values.
    The rows are stored, which also counts them; what fits into one partition isn't moved. Range bounds
    come from a sample, so placed rows are stored once more and everything reads those files.
    """
    stored = written(df, "rows")
    parts = 1 + stored.count() // SEGMENT_ROWS
    if parts == 1:
        return Segments(stored.withColumn(PART, F.lit(0)), 1)
    placed = stored.repartitionByRange(parts, *keys, at).withColumn(PART, F.spark_partition_id())
    return Segments(written(placed, "segments"), parts)


def local(keys: Iterable[str]) -> WindowSpec:
    """The rows of a segment."""
    return Window.partitionBy(PART, *keys)


def spanning(placed: Segments, keys: Iterable[str]) -> DataFrame:
    """The rows of the keys that may have more than one segment: two keys a partition, so the hint is bounded."""
    keys = list(keys)
    ends = (placed.rows.groupBy(PART).agg(F.min(F.struct(*keys)).alias("a"), F.max(F.struct(*keys)).alias("z"))
            .select(F.inline(F.array("a", "z"))).distinct())
    return placed.rows.join(F.broadcast(ends), keys, "left_semi")


def with_carry(rows: DataFrame, placed: Segments, keys: Iterable[str], summary: Callable[[DataFrame], DataFrame],
               carry: dict[str, tuple[str, Callable[[WindowSpec], Column]]]) -> DataFrame:
    """Attach to ``rows`` what the other segments of their key tell; NULL for a key with one segment.

    ``summary`` makes of the :func:`spanning` rows of ``placed`` one row for each segment (``_part``, keys,
    what is told), two a partition at most, so sending them to all tasks has a bound. ``carry`` has types,
    and functions of the window over the summaries of a key in the order of its segments. With one
    partition there is nothing to carry. The key columns hold no NULL.
    """
    keys = list(keys)
    if placed.parts == 1:
        return rows.withColumns({name: F.lit(None).cast(kind) for name, (kind, _) in carry.items()})
    in_order = Window.partitionBy(*keys).orderBy(PART)
    told = summary(spanning(placed, keys)).select(
        PART, *keys, *[column(in_order).cast(kind).alias(name) for name, (kind, column) in carry.items()])
    return rows.join(F.broadcast(told), [PART, *keys], "left")
