"""Event-time aggregates. The same functions run on batch and on streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WATERMARK = "10 minutes"
WINDOW = "5 minutes"


def window_bounds(df: DataFrame) -> DataFrame:
    """``window`` struct to ``start`` and ``end``, other columns after them."""
    rest = [c for c in df.columns if c != "window"]
    return df.select("window.start", "window.end", *rest)


def song_trends(df: DataFrame, watermark: str = WATERMARK, window: str = WINDOW) -> DataFrame:
    """Plays per song and window."""
    counted = (df.withWatermark("ts", watermark)
                 .groupBy(F.window("ts", window), "song").count())
    return window_bounds(counted)


def user_engagement(df: DataFrame) -> DataFrame:
    """Average listening time per user."""
    return df.groupBy("userId").agg(F.avg("duration").alias("avg_session_duration"))


def auth_success_rate(df: DataFrame, watermark: str = WATERMARK, window: str = WINDOW) -> DataFrame:
    """Per window: share of rows with any outcome, and share of successes among outcomes."""
    rated = (df.withWatermark("ts", watermark)
               .groupBy(F.window("ts", window))
               .agg((F.count("success") / F.count(F.lit(1))).alias("success_rate"),
                    F.avg(F.col("success").cast("int")).alias("true_rate")))
    return window_bounds(rated)


def user_count(df: DataFrame) -> DataFrame:
    """Number of users. Two levels, so that no task sees more than its share of ids."""
    return df.select("userId").distinct().agg(F.count(F.lit(1)).alias("users"))
