"""Queries of staging, joins, dimensions, history and the star."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunemill.operators import dims, facts, scd2, staging
from tunemill.plans.star import Star, build_star
from tunemill.registry.base import query, stored_once
from tunemill.session import scratch_path, written
from tunemill.sources.given_tables import GivenTables
from tunemill.sources.tables import small_tasks

# Rows of the fact that a partition of the listening summary takes about.
SLICE_ROWS = 1_000_000

def staged(g: GivenTables) -> DataFrame:
    return staging.stg_listen_events(g.listen_raw())


def plays_with_keys(g: GivenTables) -> DataFrame:
    return facts.with_join_keys(staged(g))


# Staging ---------------------------------------------------------------------

@query("stg_listen_events", "SELECT * FROM stg_listen")
def _(g):
    return staged(g)


@query("stg_page_view_events", "SELECT * FROM stg_page")
def _(g):
    return staging.stg_page_view_events(g.page_raw())


@query("stg_auth_events", "SELECT * FROM stg_auth")
def _(g):
    return staging.stg_auth_events(g.auth_raw())


@query("known_users", "SELECT * FROM stg_listen WHERE userId <> 0")
def _(g):
    return staging.known_users(staged(g))


@query("special_users", "SELECT * FROM stg_listen WHERE userId = 0 OR userId = 1")
def _(g):
    return staging.special_users(staged(g))


@query("drop_duplicate_events", "SELECT * FROM stg_listen")
def _(g):
    rows = staged(g)
    return staging.drop_duplicate_events(rows.unionByName(rows))


# History of the user's level ---------------------------------------------------

@query("distinct_user_states", "SELECT * FROM user_states")
def _(g):
    return scd2.distinct_user_states(staged(g))


@query("level_change_flag", "SELECT * FROM flagged")
def _(g):
    return scd2.level_change_flag(scd2.distinct_user_states(staged(g)))


@query("level_run_number", "SELECT * FROM numbered")
def _(g):
    return scd2.level_run_number(scd2.level_change_flag(scd2.distinct_user_states(staged(g))))


def _runs(g: GivenTables) -> DataFrame:
    states = scd2.distinct_user_states(staged(g))
    return scd2.level_runs(scd2.level_run_number(scd2.level_change_flag(states)))


@query("level_runs", "SELECT * FROM runs")
def _(g):
    return _runs(g)


@query("row_expiration", """
SELECT userId, firstName, lastName, gender, registration, level, run, firstDay,
  rowExpirationDate FROM dated""")
def _(g):
    return scd2.row_expiration(_runs(g))


@query("current_row_flag", """
SELECT userId, firstName, lastName, gender, registration, level, run, firstDay,
  currentRow FROM dated""")
def _(g):
    return scd2.current_row_flag(_runs(g))


@query("scd2_level_history", "SELECT * FROM history")
def _(g):
    return scd2.scd2_level_history(staged(g))


@query("special_user_rows", "SELECT * FROM special_rows")
def _(g):
    return scd2.special_user_rows(staged(g))


@query("users_with_special", "SELECT * FROM all_users")
def _(g):
    return scd2.users_with_special(staged(g))


# Dimensions --------------------------------------------------------------------

@query("dim_users", "SELECT * FROM dim_users")
def _(g):
    return dims.dim_users(staged(g))


@query("dim_users_clean_ids", """
SELECT md5(concat_ws('-', CAST(userId AS VARCHAR), CAST(rowActivationDate AS VARCHAR), level))
  AS userKey, * FROM (SELECT * FROM history UNION ALL SELECT * FROM special_rows WHERE userId = 0)""")
def _(g):
    return dims.dim_users(staged(g), special_ids=(0,))


@query("artist_attributes", "SELECT * FROM artist_rows")
def _(g):
    return dims.artist_attributes(g.songs())


@query("artists_with_default", "SELECT * FROM all_artists")
def _(g):
    return dims.artists_with_default(g.songs())


@query("dim_artists", "SELECT * FROM dim_artists")
def _(g):
    return dims.dim_artists(g.songs())


@query("songs_with_default", "SELECT * FROM all_songs")
def _(g):
    return dims.songs_with_default(g.songs())


@query("dim_songs", "SELECT * FROM dim_songs")
def _(g):
    return dims.dim_songs(g.songs())


@query("dim_artists_deduped", """
SELECT artistKey, artistId, latitude, longitude, location, name FROM (
  SELECT *, row_number() OVER (PARTITION BY name ORDER BY artistId NULLS FIRST,
    latitude NULLS FIRST, longitude NULLS FIRST, location NULLS FIRST) AS rn FROM dim_artists)
WHERE rn = 1""")
def _(g):
    return dims.dim_artists(g.songs(), dedupe_dims=True)


@query("join_state_names", """
SELECT l.userId, l.ts, l.state, COALESCE(s.stateCode, 'NA') AS stateCode,
  COALESCE(s.stateName, 'NA') AS stateName
FROM stg_listen l LEFT JOIN state_codes s ON l.state = s.stateCode""")
def _(g):
    events = staged(g).select("userId", "ts", "state")
    return dims.join_state_names(events, g.state_codes())


@query("distinct_locations", "SELECT * FROM places")
def _(g):
    return dims.distinct_locations(staged(g), g.state_codes())


@query("locations_with_default", "SELECT * FROM all_places")
def _(g):
    return dims.locations_with_default(staged(g), g.state_codes())


@query("dim_location", "SELECT * FROM dim_location")
def _(g):
    return dims.dim_location(staged(g), g.state_codes())


@query("dim_datetime", "SELECT * FROM dim_datetime")
def _(g):
    return dims.dim_datetime_of(staged(g))


# Joins of the star ---------------------------------------------------------------

@query("join_user_scd2", f"""
SELECT e.userId, e.ts, u.userKey FROM stg_listen e
LEFT JOIN dim_users u ON e.userId = u.userId AND CAST(e.ts AS DATE) >= u.rowActivationDate
  AND CAST(e.ts AS DATE) < u.rowExpirationDate""")
def _(g):
    joined = facts.join_user_scd2(plays_with_keys(g), dims.dim_users(staged(g)))
    return joined.select("userId", "ts", "userKey")


@query("plays_per_level_and_day", """
SELECT u.userId, u.level, CAST(e.ts AS DATE) AS day, count(*) AS plays FROM stg_listen e
JOIN dim_users u ON e.userId = u.userId AND CAST(e.ts AS DATE) >= u.rowActivationDate
  AND CAST(e.ts AS DATE) < u.rowExpirationDate GROUP BY ALL""")
def plays_per_level_and_day(g):
    """Plays per user, level on that day, and day: staging, history and interval join at once."""
    plays = staged(g).select("userId", F.col("ts").cast("date").alias("_day"))
    joined = facts.join_user_scd2(plays, dims.dim_users(staged(g)), carry=("userKey", "level"))
    return (joined.where("userKey IS NOT NULL").groupBy("userId", "level", F.col("_day").alias("day"))
            .agg(F.count(F.lit(1)).alias("plays")))


@query("join_artist", """
SELECT e.userId, e.ts, e.artist, a.artistKey FROM stg_listen e
LEFT JOIN dim_artists a ON replace(replace(e.artist, chr(34), ''), chr(92), '') = a.name""")
def _(g):
    joined = facts.join_artist(plays_with_keys(g), dims.dim_artists(g.songs()))
    return joined.select("userId", "ts", "artist", "artistKey")


@query("join_song", """
SELECT e.userId, e.ts, e.song, s.songKey FROM stg_listen e
LEFT JOIN dim_songs s ON replace(replace(e.artist, chr(34), ''), chr(92), '') = s.artistName
  AND e.song = s.title""")
def _(g):
    joined = facts.join_song(plays_with_keys(g), dims.dim_songs(g.songs()))
    return joined.select("userId", "ts", "song", "songKey")


@query("join_location", """
SELECT e.userId, e.ts, e.city, l.locationKey FROM stg_listen e
LEFT JOIN dim_location l ON e.city = l.city AND e.state = l.stateCode
  AND e.lat = l.latitude AND e.lon = l.longitude""")
def _(g):
    joined = facts.join_location(plays_with_keys(g),
                                 dims.dim_location(staged(g), g.state_codes()))
    return joined.select("userId", "ts", "city", "locationKey")


@query("join_datetime", """
SELECT e.userId, e.ts, d.dateKey FROM stg_listen e LEFT JOIN (
  SELECT * FROM dim_datetime WHERE date < (SELECT date_trunc('day', MAX(ts)) FROM stg_listen)) d
ON d.date = date_trunc('hour', e.ts)""")
def _(g):
    """The calendar ends before the last day of the events, which gets NULL keys."""
    plays = plays_with_keys(g)
    last_day = plays.agg(F.date_trunc("day", F.max("ts"))).scalar()
    hours = dims.dim_datetime_of(plays).where(F.col("date") < last_day)
    return facts.join_datetime(plays, hours).select("userId", "ts", "dateKey")


def star_of(g: GivenTables) -> Star:
    def build() -> Star:
        # The staged events feed four tables, so they are stored first.
        events = written(staged(g), "staged")
        return build_star(g.spark, events, g.songs(), g.state_codes(),
                          scratch_path(g.spark, "star"))

    return stored_once(g, "star", build)


def fact_tables(g: GivenTables) -> tuple[DataFrame, ...]:
    """Stored events and user history, and the small dimensions as plans."""
    events = written(staged(g), "staged")
    return (events, written(dims.dim_users(events), "dim_users"), dims.dim_artists(g.songs()),
            dims.dim_songs(g.songs()), dims.dim_location(events, g.state_codes()),
            dims.dim_datetime_of(events))


@query("fact_streams", "SELECT * FROM fact_streams")
def _(g):
    return facts.fact_streams(*fact_tables(g))


@query("wide_streams", "SELECT * FROM wide_streams")
def _(g):
    events, *dimensions = fact_tables(g)
    fact = facts.fact_streams(events, *dimensions, with_attributes=True)
    return facts.wide_streams(fact, *dimensions)


@query("wide_projection", """
SELECT userId, level, count(*) AS plays, count(DISTINCT songKey) AS songs,
  min("timestamp") AS first_play, max("timestamp") AS last_play
FROM wide_streams GROUP BY userId, level""")
def _(g):
    """Listening summary over the wide view, by its column names."""
    star = star_of(g)
    partitions = int(g.spark.conf.get("spark.sql.shuffle.partitions"))
    return listening(star.wide, star.fact.count() // (partitions * SLICE_ROWS) + 1)


def listening(wide: DataFrame, slices: int = 1) -> DataFrame:
    """Plays, distinct songs, first and last play per user and level.

    A task keeps every user, level and song of its partition, so a long fact is taken in ``slices`` by
    song: no song is in two of them, their counts add up, and a slice joins and shuffles its own rows only.
    """
    def summary(rows: DataFrame) -> DataFrame:
        return rows.groupBy("userId", "level").agg(
            F.count(F.lit(1)).alias("plays"), F.count_distinct("songKey").alias("songs"),
            F.min("timestamp").alias("first_play"), F.max("timestamp").alias("last_play"))

    if slices == 1:
        return summary(wide)
    number = F.pmod(F.xxhash64("songKey"), F.lit(slices))
    with small_tasks(wide.sparkSession):
        parts = [written(summary(wide.where(number == i)), "listening") for i in range(slices)]
    return reduce(DataFrame.unionByName, parts).groupBy("userId", "level").agg(
        F.sum("plays").alias("plays"), F.sum("songs").alias("songs"),
        F.min("first_play").alias("first_play"), F.max("last_play").alias("last_play"))


@query("build_star", """
SELECT 'dim_users' AS name, count(*) AS n FROM dim_users
UNION ALL SELECT 'dim_artists', count(*) FROM dim_artists
UNION ALL SELECT 'dim_songs', count(*) FROM dim_songs
UNION ALL SELECT 'dim_location', count(*) FROM dim_location
UNION ALL SELECT 'dim_datetime', count(*) FROM dim_datetime
UNION ALL SELECT 'fact_streams', count(*) FROM fact_streams
UNION ALL SELECT 'wide_streams', count(*) FROM wide_streams""")
def _(g):
    star = star_of(g)
    tables = {"dim_users": star.users, "dim_artists": star.artists, "dim_songs": star.songs,
              "dim_location": star.location, "dim_datetime": star.datetime,
              "fact_streams": star.fact, "wide_streams": star.wide}
    counts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n")
              for name, df in tables.items()]
    total = counts[0]
    for one in counts[1:]:
        total = total.unionByName(one)
    return total


