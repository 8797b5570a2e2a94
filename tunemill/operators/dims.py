"""Dimension builders: songs, artists, places, calendar, users."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tunemill import schemas
from tunemill.functions.keys import surrogate_key
from tunemill.functions.text import clean_name
from tunemill.functions.time import week_of_year
from tunemill.operators.scd2 import users_with_special

# The unknown member of each dimension.
UNKNOWN_ARTIST = ("NNNNNNNNNNNNNNN", 0.0, 0.0, "NA", "NA")
UNKNOWN_SONG = ("NNNNNNNNNNNNNNNNNNN", "NA", 0.0, -1, -1.0, -1.0, -1.0, -1.0, "NA", 0)
UNKNOWN_PLACE = ("NA", "NA", "NA", 0.0, 0.0)
# Days counted as weekend, 1 = Sunday; these two are Friday and Saturday.
WEEKEND_DAYS = (6, 7)
# Default range of the calendar, both ends included.
# Events outside of these don't stretch a calendar that follows the data.
LIMITS = ("1900-01-01 00:00:00", "2199-12-31 23:59:59.999999")
CALENDAR = ("2018-10-01", "2023-01-01")


def _keyed(df: DataFrame, name: str, *cols: str) -> DataFrame:
    return df.select(surrogate_key(*cols).alias(name), "*")


def _with_member(df: DataFrame, member: tuple) -> DataFrame:
    # Built from range() so that the optimizer knows it is one row.
    row = df.sparkSession.range(1).select(
        *[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(member, df.schema.fields)])
    return df.unionByName(row)


def one_per_key(df: DataFrame, *keys: str) -> DataFrame:
    """One row per natural key, the one whose columns compare lowest."""
    first = df.groupBy(*keys).agg(F.min(F.struct(*df.columns)).alias("_row"))
    return first.select("_row.*")


def artist_attributes(songs: DataFrame) -> DataFrame:
    """Per spelling of an artist name the highest value of each attribute."""
    per_name = songs.groupBy("artist_name").agg(
        F.max("artist_id").alias("artistId"),
        F.max("artist_latitude").alias("latitude"),
        F.max("artist_longitude").alias("longitude"),
        F.max("artist_location").alias("location"))
    return per_name.select("artistId", "latitude", "longitude", "location",
                           clean_name("artist_name").alias("name"))


def artists_with_default(songs: DataFrame) -> DataFrame:
    return _with_member(artist_attributes(songs), UNKNOWN_ARTIST)


def dim_artists(songs: DataFrame, dedupe_dims: bool = False) -> DataFrame:
    """Two spellings of one name give two rows, unless ``dedupe_dims``."""
    artists = artists_with_default(songs)
    return _keyed(one_per_key(artists, "name") if dedupe_dims else artists,
                  "artistKey", "artistId")


def songs_with_default(songs: DataFrame) -> DataFrame:
    renamed = songs.select(
        F.col("song_id").alias("songId"), clean_name("artist_name").alias("artistName"),
        "duration", "key", F.col("key_confidence").alias("keyConfidence"), "loudness",
        F.col("song_hotttnesss").alias("songHotness"), "tempo", "title", "year")
    return _with_member(renamed, UNKNOWN_SONG)


def dim_songs(songs: DataFrame, dedupe_dims: bool = False) -> DataFrame:
    rows = songs_with_default(songs)
    return _keyed(one_per_key(rows, "artistName", "title") if dedupe_dims else rows,
                  "songKey", "songId")


def join_state_names(events: DataFrame, state_codes: DataFrame) -> DataFrame:
    """Add ``stateCode`` and ``stateName`` by the event's state, ``'NA'`` when unknown.

    The seed is far below the optimizer's broadcast limit, so no hint is needed.
    """
    seed = state_codes.select(F.col("stateCode").alias("_code"), F.col("stateName").alias("_name"))
    joined = events.join(seed, F.col("state") == F.col("_code"), "left")
    return joined.select(
        *events.columns,
        F.coalesce("_code", F.lit(schemas.TEXT_DEFAULT)).alias("stateCode"),
        F.coalesce("_name", F.lit(schemas.TEXT_DEFAULT)).alias("stateName"))


def distinct_locations(events: DataFrame, state_codes: DataFrame) -> DataFrame:
    """Distinct places; the events shrink in the map-side combine."""
    places = events.select("city", "state", "lat", "lon")
    return (join_state_names(places, state_codes)
            .select("city", "stateCode", "stateName", F.col("lat").alias("latitude"),
                    F.col("lon").alias("longitude")).distinct())


def locations_with_default(events: DataFrame, state_codes: DataFrame) -> DataFrame:
    return _with_member(distinct_locations(events, state_codes), UNKNOWN_PLACE)


def dim_location(events: DataFrame, state_codes: DataFrame) -> DataFrame:
    return _keyed(locations_with_default(events, state_codes),
                  "locationKey", "latitude", "longitude", "city", "stateName")


def dim_users(events: DataFrame, special_ids: tuple[int, ...] = (0, 1)) -> DataFrame:
    return _keyed(users_with_special(events, special_ids),
                  "userKey", "userId", "rowActivationDate", "level")


def calendar(hours: DataFrame, weekend_days: tuple[int, ...] = WEEKEND_DAYS) -> DataFrame:
    """Calendar attributes of the hours in column ``date``."""
    d = F.col("date")
    return hours.select(
        F.unix_seconds(d).alias("dateKey"), d,
        F.dayofweek(d).alias("dayOfWeek"), F.dayofmonth(d).alias("dayOfMonth"),
        week_of_year(d).alias("weekOfYear"), F.month(d).alias("month"), F.year(d).alias("year"),
        F.dayofweek(d).isin(*weekend_days).alias("weekendFlag"))


def _hours(spark: SparkSession, first: int | None, last: int | None) -> DataFrame:
    """One row per hour from epoch second ``first`` to ``last``, made by many tasks."""
    numbers = spark.range(0) if first is None else spark.range(first // 3600, last // 3600 + 1)
    return numbers.select(F.timestamp_seconds(F.col("id") * 3600).alias("date"))


def dim_datetime(spark: SparkSession, start: str = CALENDAR[0], end: str = CALENDAR[1],
                 weekend_days: tuple[int, ...] = WEEKEND_DAYS) -> DataFrame:
    """One row per hour of a fixed range, both ends included."""
    first, last = spark.range(1).select(*[F.unix_seconds(F.lit(t).cast("timestamp")) for t in (start, end)]).first()
    return calendar(_hours(spark, first, last), weekend_days)


def dim_datetime_of(events: DataFrame, weekend_days: tuple[int, ...] = WEEKEND_DAYS,
                    limits: tuple[str, str] = LIMITS) -> DataFrame:
    """The calendar of the hours between the first and the last event within ``limits``.

    An event outside of them (a broken clock) is left without a key and makes the calendar no longer.
    """
    ts = F.col("ts").cast("timestamp")
    within = events.where(ts.between(*[F.lit(t).cast("timestamp") for t in limits]))
    first, last = within.agg(F.min(F.unix_seconds(ts)), F.max(F.unix_seconds(ts))).first()
    return calendar(_hours(events.sparkSession, first, last), weekend_days)
