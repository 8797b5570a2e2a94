"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def surrogate_key(*cols: str | Column) -> Column:
    """MD5 hex of the columns as text, NULL as empty text, joined by ``-``."""
    parts = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(""))
             for c in cols]
    return F.md5(F.concat_ws("-", *parts))


def spread(col: str | Column, seed: int) -> Column:
    """Repeatable pseudo-random hex text of a row, for ordering by chance."""
    c = F.col(col) if isinstance(col, str) else col
    return F.md5(F.concat_ws("-", c.cast("string"), F.lit(str(seed))))


def spread_number(col: str | Column, seed: int) -> Column:
    """First 60 bits of :func:`spread` as a non-negative number."""
    return F.conv(F.substring(spread(col, seed), 1, 15), 16, 10).cast("bigint")
