"""Listening data derived from general sales and event tables.

The SQL runs unchanged in Spark SQL (UTC session) and in DuckDB, so both sides
of a check start from the same rows. ``{events}``, ``{part}`` and ``{nation}``
stand for the source tables, ``{raw_events}`` for the view of that name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tunemill import schemas
from tunemill.functions.text import escape_text

SONGS_SQL = """
SELECT CONCAT('S', CAST(p_partkey AS STRING)) AS song_id,
  CASE WHEN p_partkey % 10 = 0 THEN CONCAT(chr(34), p_brand, chr(34))
       WHEN p_partkey % 25 = 3 THEN CONCAT(p_brand, chr(92)) ELSE p_brand END AS artist_name,
  CONCAT('A-', CASE WHEN p_partkey % 10 = 0 THEN 'q-' WHEN p_partkey % 25 = 3 THEN 'b-'
       ELSE '' END, p_brand) AS artist_id,
  CASE WHEN p_partkey % 7 = 0 THEN NULL
       ELSE CAST(p_partkey % 90 AS DOUBLE) + 0.5 END AS artist_latitude,
  CASE WHEN p_partkey % 7 = 0 THEN NULL
       ELSE CAST(p_partkey % 180 AS DOUBLE) + 0.25 END AS artist_longitude,
  p_type AS artist_location, p_retailprice / 4 AS duration, CAST(p_size % 12 AS INT) AS key,
  CAST(0.5 AS DOUBLE) AS key_confidence, CAST(-7.5 AS DOUBLE) AS loudness,
  CAST(0.25 AS DOUBLE) AS song_hotttnesss, CAST(60 + p_size AS DOUBLE) AS tempo,
  CONCAT(p_name, ' ', CAST(p_size AS STRING)) AS title, CAST(1970 + p_size AS INT) AS year
FROM {part}
"""

STATE_CODES_SQL = """
SELECT CONCAT('N', CAST(n_nationkey AS STRING)) AS stateCode, n_name AS stateName
FROM {nation} WHERE n_nationkey < 20
"""

RAW_EVENTS_SQL = """
SELECT e.event_id, e.event_type, CAST(e.ts AS TIMESTAMP) AS ts, e.user_id AS userId,
  CASE WHEN e.event_id % 97 = 0 THEN 'paid'
       WHEN (e.user_id + CAST(FLOOR(dayofyear(e.ts) / 10) AS INT)) % 2 = 0 THEN 'free'
       ELSE 'paid' END AS level,
  CASE WHEN e.event_id % 31 = 0 THEN NULL ELSE 'Logged In' END AS auth,
  CASE WHEN e.event_type = 'click' THEN 'Home' ELSE 'NextSong' END AS page,
  CASE WHEN e.event_id % 3 = 0 THEN 'GET' ELSE 'PUT' END AS method,
  CASE WHEN e.event_id % 41 = 0 THEN NULL ELSE 200 END AS status,
  CONCAT('City_', CAST(e.user_id % 20 AS STRING)) AS city,
  CONCAT('N', CAST(e.user_id % 25 AS STRING)) AS state,
  CONCAT('Agent/', CAST(e.user_id % 5 AS STRING)) AS userAgent,
  CASE WHEN e.event_id % 53 = 0 THEN NULL
       ELSE CAST(e.user_id % 20 AS DOUBLE) - 100.25 END AS lon,
  CASE WHEN e.event_id % 53 = 0 THEN NULL
       ELSE CAST(e.user_id % 20 AS DOUBLE) + 30.5 END AS lat,
  CONCAT('Last', CAST(e.user_id AS STRING)) AS lastName,
  CONCAT('First', CAST(e.user_id AS STRING)) AS firstName,
  CASE WHEN e.user_id % 2 = 0 THEN 'M' ELSE 'F' END AS gender,
  CASE WHEN e.user_id % 29 = 0 THEN NULL
       ELSE CAST(1700000000000 + e.user_id AS BIGINT) END AS registration,
  CASE WHEN e.event_id % 50 = 0 THEN NULL
       WHEN e.event_id % 40 = 1 THEN CONCAT(chr(34), p.p_brand, chr(34))
       ELSE p.p_brand END AS artist,
  CASE WHEN e.event_id % 50 = 0 THEN NULL
       ELSE CONCAT(p.p_name, ' ', CAST(p.p_size AS STRING)) END AS song,
  CASE WHEN e.event_id % 50 = 0 THEN NULL ELSE e.value END AS duration,
  CASE WHEN e.event_id % 11 = 0 THEN NULL ELSE e.event_type = 'signup' END AS success
FROM {events} e
LEFT JOIN {part} p ON p.p_partkey = CAST(regexp_extract(e.props, '[0-9]+', 0) AS BIGINT)
"""

LISTEN_RAW_SQL = """
SELECT artist, song, duration, ts, auth, level, city, state, userAgent, lon, lat,
  userId, lastName, firstName, gender, registration
FROM {raw_events} WHERE event_type = 'view'
"""

PAGE_RAW_SQL = """
SELECT ts, page, auth, method, status, level, city, state, userAgent, lon, lat,
  userId, lastName, firstName, gender, registration, artist, song, duration
FROM {raw_events} WHERE event_type IN ('click', 'purchase')
"""

AUTH_RAW_SQL = """
SELECT ts, level, city, state, userAgent, lon, lat, userId, lastName, firstName, gender,
  registration, success
FROM {raw_events} WHERE event_type IN ('signup', 'error')
"""

# Event types that make up each topic.
TOPIC_EVENTS = {
    schemas.LISTEN: ("view",),
    schemas.PAGE_VIEW: ("click", "purchase"),
    schemas.AUTH: ("signup", "error"),
}


def _wire_value(name: str) -> Column:
    """A message field out of the raw events; those have no session and no zip code."""
    if name == "ts":
        return F.unix_millis("ts")
    if name.lower() == "sessionid":
        return F.col("userId").cast("int")
    if name == "itemInSession":
        return (F.col("event_id") % 100).cast("int")
    if name == "zip":
        return (F.col("userId") % 1000 + 10000).cast("int")
    if name in ("song", "artist"):
        return escape_text(name)
    return F.col(name)


class GivenTables:
    """The derived inputs over one folder of source tables, all lazy."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def songs(self) -> DataFrame:
        return self.spark.sql(SONGS_SQL, part=self.table("part"))

    def state_codes(self) -> DataFrame:
        return self.spark.sql(STATE_CODES_SQL, nation=self.table("nation"))

    def raw_events(self, events: DataFrame | None = None) -> DataFrame:
        """Events with their song; ``events`` may be a stream of the event table."""
        source = self.table("events") if events is None else events
        return self.spark.sql(RAW_EVENTS_SQL, events=source, part=self.table("part"))

    def listen_raw(self, events: DataFrame | None = None) -> DataFrame:
        return self.spark.sql(LISTEN_RAW_SQL, raw_events=self.raw_events(events))

    def page_raw(self, events: DataFrame | None = None) -> DataFrame:
        return self.spark.sql(PAGE_RAW_SQL, raw_events=self.raw_events(events))

    def auth_raw(self, events: DataFrame | None = None) -> DataFrame:
        return self.spark.sql(AUTH_RAW_SQL, raw_events=self.raw_events(events))

    def event_stream(self) -> DataFrame:
        """The event table as a file stream."""
        return (self.spark.readStream.schema(self.table("events").schema)
                .option("pathGlobFilter", "events.parquet").parquet(self.sf_dir))

    def envelope(self, topic: str, events: DataFrame | None = None, keep: str | None = None) -> DataFrame:
        """Messages of ``topic`` as a broker would hand them out: ``topic`` and binary ``value``.

        ``keep`` may name one more column of the raw events, as SQL.
        """
        raw = self.raw_events(events).where(F.col("event_type").isin(*TOPIC_EVENTS[topic]))
        fields = [_wire_value(f.name).alias(f.name) for f in schemas.WIRE[topic].fields]
        return raw.select(F.lit(topic).alias("topic"), F.to_json(F.struct(*fields)).cast("binary").alias("value"),
                          *([F.expr(keep)] if keep else []))
