"""Time columns: epoch conversion, lake partitions, slots, calendar parts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLOT_SECONDS = 300
SLOT_FORMAT = "yyyy-MM-dd HH-mm"
HOUR_FORMAT = "yyyy-MM-dd HH"


def epoch_ms_to_ts(ms: Column) -> Column:
    """Epoch milliseconds to a timestamp, exact to the millisecond."""
    return F.timestamp_millis(ms)


def floor_to(ts: Column, seconds: int) -> Column:
    """Largest multiple of ``seconds`` since the epoch that is not after ``ts``."""
    return F.timestamp_seconds(F.floor(F.unix_seconds(ts) / seconds) * seconds)


def five_minute_interval(ts: Column) -> Column:
    """Label of the five-minute slot, such as ``2024-01-01 00-05``."""
    return F.date_format(floor_to(ts, SLOT_SECONDS), SLOT_FORMAT)


def slot_for(run_ts: Column) -> Column:
    """Slot that a load started at ``run_ts`` has to read: the one just finished."""
    return five_minute_interval(run_ts - F.expr("INTERVAL 5 MINUTES"))


def ts_hour(ts: Column) -> Column:
    """Label of the hour, used as a partition value."""
    return F.date_format(ts, HOUR_FORMAT)


def time_parts(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Add ``year``, ``month``, ``day`` and ``hour``."""
    c = F.col(ts)
    return df.withColumns({
        "year": F.year(c), "month": F.month(c), "day": F.dayofmonth(c), "hour": F.hour(c)})


def with_slot(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Add ``five_minute_interval``."""
    return df.withColumn("five_minute_interval", five_minute_interval(F.col(ts)))


def week_of_year(ts: Column) -> Column:
    """Week number 0 to 53 with weeks that start on Sunday (not the ISO week)."""
    return F.floor((F.dayofyear(ts) + 7 - F.dayofweek(ts)) / 7).cast("int")


def time_bucket(ts: Column, unit: str) -> Column:
    """Coarse time bucket; splits the rows of one busy user into many small groups.

    Rows without a time fall into a bucket before all others, where a sort puts
    them too. The bucket is never NULL, so it can be joined on by equality.
    """
    return F.coalesce(F.date_trunc(unit, ts), F.expr("TIMESTAMP '0001-01-01 00:00:00'"))
