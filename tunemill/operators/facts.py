"""Fact table and the wide view: the joins of the star.

No join carries a broadcast hint. The optimizer broadcasts a dimension when its
known or measured size is below ``spark.sql.autoBroadcastJoinThreshold`` and
shuffles it otherwise, and AQE splits the hot keys of a shuffled join. The wide
view is the exception: see :func:`wide_streams`.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunemill.functions.text import clean_name

KEYS = ("userKey", "artistKey", "songKey", "dateKey", "locationKey")
# Rows of users or songs that may still be small enough to broadcast.
SMALL_ROWS = 50_000


def with_join_keys(events: DataFrame) -> DataFrame:
    """Add the derived join keys once, ahead of all joins."""
    return events.withColumns({
        "_day": F.col("ts").cast("date"),
        "_artist": clean_name("artist"),
        "_hour": F.date_trunc("hour", "ts"),
    })


def month_number(day: Column) -> Column:
    return F.year(day) * 12 + F.month(day)


def history_by_month(dim_users: DataFrame, plays: DataFrame, carry: Iterable[str] = ("userKey",)) -> DataFrame:
    """The user rows cut at month edges: ``_userId, _rowMonth``, both days of the row, and ``carry``.

    A row is only cut between the user's own first and last play in ``plays``, so an open end costs as
    many pieces as that user has months, and a user who never plays none. Rows that end on the day they
    start contain no day and are left out.
    """
    spans = (plays.groupBy(F.col("userId").alias("_userId"))
             .agg(F.min("_day").alias("_first"), F.max("_day").alias("_last")))
    starts, ends = F.col("rowActivationDate"), F.date_sub("rowExpirationDate", 1)
    months = F.sequence(month_number(F.greatest(starts, F.col("_first"))),
                        month_number(F.least(ends, F.col("_last"))))
    rows = (dim_users.where(F.col("rowActivationDate") < F.col("rowExpirationDate"))
            .select(F.col("userId").alias("_userId"), "rowActivationDate", "rowExpirationDate", *carry))
    return (rows.join(spans, "_userId").where((starts <= F.col("_last")) & (ends >= F.col("_first")))
            .select("_userId", F.explode(months).alias("_rowMonth"),
                    "rowActivationDate", "rowExpirationDate", *carry))


def join_user_scd2(plays: DataFrame, dim_users: DataFrame, seen: DataFrame | None = None,
                   carry: Iterable[str] = ("userKey",), hashed: bool = False) -> DataFrame:
    """Left interval join: ``carry`` of the user's row whose days contain the day of the play.

    User and month are the join key, so a play meets the rows of one month, 31 at most for a plain
    history, however long it is; the days are the residual condition. AQE splits the plays of a hot
    user. ``seen`` may give the same plays as narrow rows (``userId, _day``), to spare what ``plays``
    has been joined with before. With ``hashed`` the user's rows are the hashed side of a shuffled join, so
    that wide plays are not sorted.
    """
    carry = tuple(carry)
    rows = history_by_month(dim_users, plays if seen is None else seen, carry)
    rows = rows.hint("shuffle_hash") if hashed else rows
    on = ((F.col("userId") == F.col("_userId")) & (F.col("_month") == F.col("_rowMonth"))
          & (F.col("_day") >= F.col("rowActivationDate"))
          & (F.col("_day") < F.col("rowExpirationDate")))
    return (plays.withColumn("_month", month_number(F.col("_day"))).join(rows, on, "left")
            .drop("_userId", "_month", "_rowMonth", "rowActivationDate", "rowExpirationDate"))


def join_artist(plays: DataFrame, dim_artists: DataFrame,
                carry: Iterable[str] = ("artistKey",)) -> DataFrame:
    rows = dim_artists.select(*carry, F.col("name").alias("_name"))
    return plays.join(rows, F.col("_artist") == F.col("_name"), "left").drop("_name")


def join_song(plays: DataFrame, dim_songs: DataFrame, carry: Iterable[str] = ("songKey",)) -> DataFrame:
    rows = dim_songs.select(*carry, F.col("artistName").alias("_name"),
                            F.col("title").alias("_title"))
    on = (F.col("_artist") == F.col("_name")) & (F.col("song") == F.col("_title"))
    return plays.join(rows, on, "left").drop("_name", "_title")


def join_location(plays: DataFrame, dim_location: DataFrame,
                  carry: Iterable[str] = ("locationKey",)) -> DataFrame:
    rows = dim_location.select(
        *carry, F.col("city").alias("_city"), F.col("stateCode").alias("_state"),
        F.col("latitude").alias("_lat"), F.col("longitude").alias("_lon"))
    on = ((F.col("city") == F.col("_city")) & (F.col("state") == F.col("_state"))
          & (F.col("lat") == F.col("_lat")) & (F.col("lon") == F.col("_lon")))
    return plays.join(rows, on, "left").drop("_city", "_state", "_lat", "_lon")


def join_datetime(plays: DataFrame, dim_datetime: DataFrame,
                  carry: Iterable[str] = ("dateKey",)) -> DataFrame:
    """Hours outside the calendar get a NULL key."""
    rows = dim_datetime.select(*carry, F.col("date").alias("_date"))
    return plays.join(rows, F.col("_hour") == F.col("_date"), "left").drop("_date")


def attributes(dim_users: DataFrame, dim_artists: DataFrame, dim_songs: DataFrame,
               dim_location: DataFrame, dim_datetime: DataFrame) -> dict[str, DataFrame]:
    """What the wide view takes from each dimension, by the key it is found with."""
    return {
        "userKey": dim_users.select("userKey", "firstName", "lastName", "gender", "level", "userId",
                                    "currentRow"),
        "artistKey": dim_artists.select("artistKey", F.col("latitude").alias("artistLatitude"),
                                        F.col("longitude").alias("artistLongitude"),
                                        F.col("name").alias("artistName")),
        "songKey": dim_songs.select("songKey", F.col("duration").alias("songDuration"), "tempo",
                                    "title"),
        "dateKey": dim_datetime.select("dateKey", "date", "dayOfMonth", "dayOfWeek"),
        "locationKey": dim_location.select("locationKey", "city", "stateName", "latitude",
                                           "longitude"),
    }


def _found(key: str) -> str:
    """Column of a fact that has the attributes under ``key``."""
    return f"_{key}Attributes"


def _looked_up(dimension: DataFrame, key: str, rows: DataFrame) -> DataFrame:
    """``dimension`` with the attributes under its key, a row for each of ``rows`` with that key."""
    found = F.struct(*[c for c in rows.columns if c != key]).alias(_found(key))
    return dimension.join(rows.select(key, found), key)


def fact_streams(events: DataFrame, dim_users: DataFrame, dim_artists: DataFrame,
                 dim_songs: DataFrame, dim_location: DataFrame,
                 dim_datetime: DataFrame, with_attributes: bool = False,
                 small: int = SMALL_ROWS) -> DataFrame:
    """One row per play and match, with the five keys.

    Places and calendar are small and turn wide columns into keys, so they come
    first. The join on the user is the one that needs an exchange; it comes
    before artists and songs, which multiply the rows.

    For a wide view of a fact that isn't stored, ``with_attributes`` looks each key up in its
    dimension before the plays meet that, so a row has what :func:`wide_streams` would join to it (and is
    there once for each row of its keys). What songs have multiplied is then neither stored nor
    shuffled. Users and songs of more than ``small`` rows, which are counted, are the hashed side.
    """
    hashed = False
    tables = dict(zip(KEYS, (dim_users, dim_artists, dim_songs, dim_datetime, dim_location)))
    carry = {key: (key,) for key in KEYS}
    if with_attributes:
        rows = attributes(dim_users, dim_artists, dim_songs, dim_location, dim_datetime)
        tables = {key: _looked_up(table, key, rows[key]) for key, table in tables.items()}
        hashed = dim_users.count() > small
        if dim_songs.count() > small:
            tables["songKey"] = tables["songKey"].hint("shuffle_hash")
        carry = {key: (key, _found(key)) for key in KEYS}
    plays = with_join_keys(events.select("ts", "userId", "artist", "song", "city", "state",
                                         "lat", "lon"))
    plays = join_datetime(plays, tables["dateKey"], carry["dateKey"]).drop("_hour")
    plays = (join_location(plays, tables["locationKey"], carry["locationKey"])
             .drop("city", "state", "lat", "lon"))
    seen = events.select("userId", F.col("ts").cast("date").alias("_day"))
    plays = (join_user_scd2(plays, tables["userKey"], seen, carry["userKey"], hashed)
             .drop("userId", "_day"))
    plays = join_artist(plays, tables["artistKey"], carry["artistKey"])
    plays = join_song(plays, tables["songKey"], carry["songKey"])
    return plays.select(*KEYS, "ts", *[name for key in KEYS for name in carry[key][1:]])


def wide_projection(joined: DataFrame) -> DataFrame:
    """The 25 columns of the wide view from the joined star."""
    return joined.select(
        *KEYS, F.col("ts").alias("timestamp"),
        "firstName", "lastName", "gender", "level", "userId",
        F.col("currentRow").alias("currentUserRow"),
        F.col("songDuration"), "tempo", F.col("title").alias("songName"),
        "city", F.col("stateName").alias("state"), "latitude", "longitude",
        F.col("date").alias("dateHour"), "dayOfMonth", "dayOfWeek",
        "artistLatitude", "artistLongitude", "artistName")


def _hashed(dimension: DataFrame, small: int) -> DataFrame:
    """``dimension`` as the hashed side of a shuffled join, unless it has no more than ``small`` rows."""
    return dimension.hint("shuffle_hash") if dimension.count() > small else dimension


def wide_streams(fact: DataFrame, dim_users: DataFrame, dim_artists: DataFrame,
                 dim_songs: DataFrame, dim_location: DataFrame,
                 dim_datetime: DataFrame, small: int = SMALL_ROWS) -> DataFrame:
    """The fact with the attributes of all dimensions; plays with a missing key drop out.

    Rows with a NULL key are filtered before any join, so they are neither
    shuffled nor able to form a hot key. The users come first: that exchange
    then moves keys only, and the small dimensions join without one.

    Users and songs of more than ``small`` rows, which are counted, are hashed: a task
    holds its share of the dimension and lets the fact through, where a merge join
    would sort as much of the fact as a partition has. AQE still splits hot keys.

    A fact made ``with_attributes`` has been joined with the dimensions by its keys.
    """
    complete = fact.where(" AND ".join(f"{k} IS NOT NULL" for k in KEYS))
    if {_found(key) for key in KEYS} <= {*fact.columns}:
        return wide_projection(complete.select(*KEYS, "ts", *[f"{_found(key)}.*" for key in KEYS]))
    rows = attributes(dim_users, dim_artists, dim_songs, dim_location, dim_datetime)
    joined = (complete.join(_hashed(rows["userKey"], small), "userKey").join(rows["dateKey"], "dateKey")
              .join(rows["locationKey"], "locationKey").join(rows["artistKey"], "artistKey")
              .join(_hashed(rows["songKey"], small), "songKey"))
    return wide_projection(joined)
