"""The star schema: seed, dimensions, fact, wide view, in the order they need each other."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tunemill.operators import dims
from tunemill.operators.facts import fact_streams, wide_streams
from tunemill.sources.tables import materialize, read_table


@dataclass
class Star:
    users: DataFrame
    artists: DataFrame
    songs: DataFrame
    location: DataFrame
    datetime: DataFrame
    fact: DataFrame
    wide: DataFrame


def build_star(spark: SparkSession, events: DataFrame, songs: DataFrame, state_codes: DataFrame,
               base: str, special_ids: tuple[int, ...] = (0, 1), dedupe_dims: bool = False,
               calendar: tuple[str, str] | None = None) -> Star:
    """Build all tables under ``base`` and return them as read back.

    Each table is written once. The fact and the wide view then join stored
    dimensions: nothing is computed twice, a lost executor costs no rebuild of
    a dimension, and join choices rest on true sizes. Without ``calendar`` the
    hours run from the first event to the last.
    """
    def stored(name: str, df: DataFrame, hour_of: str | None = None) -> DataFrame:
        materialize(df, f"{base}/{name}", hour_of)
        return read_table(spark, f"{base}/{name}", df)

    hours = dims.dim_datetime(spark, *calendar) if calendar else dims.dim_datetime_of(events)
    users = stored("dim_users", dims.dim_users(events, special_ids))
    artists = stored("dim_artists", dims.dim_artists(songs, dedupe_dims))
    catalogue = stored("dim_songs", dims.dim_songs(songs, dedupe_dims))
    location = stored("dim_location", dims.dim_location(events, state_codes))
    datetime = stored("dim_datetime", hours)
    fact = stored("fact_streams",
                  fact_streams(events, users, artists, catalogue, location, datetime), "ts")
    wide = wide_streams(fact, users, artists, catalogue, location, datetime)
    return Star(users, artists, catalogue, location, datetime, fact, wide)


def refresh_fact(star: Star, events: DataFrame, base: str, since: Column) -> None:
    """Recompute the fact rows of the day of ``since`` and later, leaving older hours alone.

    For loads every few minutes, which would otherwise rebuild years of plays.
    The dimensions in ``star`` are to be the current ones. Their user rows
    change by whole days, so the recomputed part starts with a day.
    """
    recent = events.where(F.col("ts") >= F.date_trunc("day", since))
    fact = fact_streams(recent, star.users, star.artists, star.songs, star.location,
                        star.datetime)
    materialize(fact, f"{base}/fact_streams", "ts", only_hours=True)
