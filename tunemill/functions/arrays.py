"""Array expressions of the sequence jobs. Positions are 1-based, as in Spark."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def prefix(a: Column, n: Column | int) -> Column:
    return F.slice(a, 1, n)


def last_n(a: Column, n: int) -> Column:
    """The last ``n`` items, or all of them when there are fewer."""
    return F.slice(a, F.greatest(F.size(a) - F.lit(n - 1), F.lit(1)), n)


def pad_sequence(a: Column, length: int = 19, label_offset: int = 0) -> Column:
    """Right-pad with 0 to ``length``; ``label_offset=1`` keeps label 0 apart from padding."""
    items = F.transform(a, lambda x: x + label_offset) if label_offset else a
    missing = F.greatest(F.lit(length) - F.size(a), F.lit(0))
    return F.concat(items, F.array_repeat(F.lit(0), missing))
