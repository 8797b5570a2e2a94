"""Queries of sources, sinks and load jobs: each writes the given data and reads it back."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunemill import schemas
from tunemill.operators import dims, staging
from tunemill.operators import sequences as seq
from tunemill.plans import slots
from tunemill.plans.songs import load_songs
from tunemill.functions.time import five_minute_interval
from tunemill.registry.base import query, stored_once
from tunemill.registry.star import staged, star_of
from tunemill.session import scratch_path, written
from tunemill.sources import files, kafka, tables
from tunemill.sources.given_tables import GivenTables
from tunemill.streaming.ingest import flatten, ingest, parse_json, payload
from tunemill.streaming.jobs import finish
from tunemill.streaming.sinks import lake_sink


def listen_lake(g: GivenTables) -> str:
    """The lake folder of the listen events, landed by the ingest stream."""
    def build() -> str:
        path = scratch_path(g.spark, "lake")
        rows = ingest(g.envelope(schemas.LISTEN, g.event_stream()), schemas.LISTEN)
        finish([lake_sink(rows, f"{path}/{schemas.LISTEN}", f"{path}/checkpoint",
                          "available").start()])
        return path

    return stored_once(g, "lake", build)


def listen_staging(g: GivenTables) -> str:
    """The staging table of the listen events: made empty, then appended to."""
    def build() -> str:
        path = scratch_path(g.spark, "staging")
        tables.ensure_table(g.spark, path, schemas.LISTEN)
        tables.append_staging(staged(g), path, schemas.LISTEN)
        return path

    return stored_once(g, "staging", build)


def last_slot(g: GivenTables) -> datetime:
    """Slot of the newest listen event: one value to the driver, as a scheduler passes it."""
    text = g.listen_raw().agg(five_minute_interval(F.max("ts"))).first()[0]
    return datetime.strptime(text, "%Y-%m-%d %H-%M")


LAST_SLOT = "(SELECT time_bucket(INTERVAL '5 minutes', MAX(ts)) FROM listen_raw)"
IN_LAST_SLOT = f"time_bucket(INTERVAL '5 minutes', ts) = {LAST_SLOT}"


@query("payload", "SELECT props AS value FROM events")
def _(g):
    return payload(g.table("events").select(F.col("props").cast("binary").alias("value")))


@query("parse_json", "SELECT CAST(regexp_extract(props, '[0-9]+', 0) AS INT) AS k FROM events")
def _(g):
    messages = g.table("events").select(F.col("props").cast("binary").alias("value"))
    schema = schemas._struct("k int")
    return messages.transform(payload).transform(parse_json, schema).transform(flatten)


@query("flatten", """
SELECT CAST(regexp_extract(props, '[0-9]+', 0) AS INT) AS k, event_type AS kind FROM events""")
def _(g):
    """Fields of a parsed message as columns of their own."""
    fields = F.struct(F.from_json("props", "k int").k.alias("k"),
                      F.col("event_type").alias("kind"))
    return g.table("events").select(fields.alias("data")).transform(flatten)


@query("ingest", """
SELECT CASE event_type WHEN 'view' THEN 'listen_events' WHEN 'click' THEN 'page_view_events'
    WHEN 'purchase' THEN 'page_view_events' ELSE 'auth_events' END AS topic, userId,
  date_trunc('millisecond', ts) AS ts,
  strftime(time_bucket(INTERVAL '5 minutes', ts), '%Y-%m-%d %H-%M') AS five_minute_interval
FROM raw_events""")
def _(g):
    """All three topics through the same steps."""
    parts = [ingest(g.envelope(t), t).select(
        F.lit(t).alias("topic"), F.col("userId").cast("bigint").alias("userId"), "ts",
        "five_minute_interval") for t in schemas.TOPICS]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


_LAKE_TAIL = """CAST(year(ts) AS INT) AS year, CAST(month(ts) AS INT) AS month,
  CAST(day(ts) AS INT) AS day, CAST(hour(ts) AS INT) AS hour,
  strftime(time_bucket(INTERVAL '5 minutes', ts), '%Y-%m-%d %H-%M') AS five_minute_interval"""
_LAKE_EVENT = """userAgent, lon, lat, lastName, firstName, gender, registration, level, city, state,
  CAST(event_id % 100 AS INT) AS itemInSession, CAST(userId % 1000 + 10000 AS INT) AS zip,
  date_trunc('millisecond', ts) AS ts"""


@query("ingest_listen_events", f"""
SELECT trim(artist, chr(34)) AS artist, song, duration, CAST(userId AS INT) AS sessionid, auth,
  userId, {_LAKE_EVENT}, {_LAKE_TAIL} FROM raw_events WHERE event_type = 'view'""")
def _(g):
    return ingest(g.envelope(schemas.LISTEN), schemas.LISTEN)


@query("ingest_page_view_events", f"""
SELECT trim(artist, chr(34)) AS artist, song, duration, CAST(userId AS INT) AS sessionId, auth,
  CAST(userId AS INT) AS userId, page, method, status, {_LAKE_EVENT}, {_LAKE_TAIL}
FROM raw_events WHERE event_type IN ('click', 'purchase')""")
def _(g):
    return ingest(g.envelope(schemas.PAGE_VIEW), schemas.PAGE_VIEW)


@query("ingest_auth_events", f"""
SELECT CAST(userId AS INT) AS sessionId, CAST(userId AS INT) AS userId, success,
  {_LAKE_EVENT}, {_LAKE_TAIL} FROM raw_events WHERE event_type IN ('signup', 'error')""")
def _(g):
    return ingest(g.envelope(schemas.AUTH), schemas.AUTH)


@query("to_kafka_records", """
SELECT event_id, userId, level, city, artist, song FROM raw_events""")
def _(g):
    """Rows to keyed JSON messages and back."""
    rows = g.raw_events().select("event_id", "userId", "level", "city", "artist", "song")
    sent = kafka.to_kafka_records(rows, ["userId"], rows.columns)
    key = F.from_json("key", "userId bigint").userId
    value = F.from_json("value", rows.schema)
    return sent.select(value.alias("v"), key.alias("key")).select(
        "v.event_id", F.col("key").alias("userId"), "v.level", "v.city", "v.artist", "v.song")


@query("ride_projection", """
SELECT CAST(l_suppkey AS VARCHAR) AS vendorId, CAST(l_quantity AS INT) AS passenger_count,
  round(CAST(CAST(l_extendedprice AS FLOAT) AS DOUBLE), 2) AS trip_distance,
  CAST(l_partkey AS INT) AS pickup_location,
  CAST(l_orderkey AS INT) AS dropoff_location, CAST(l_linenumber AS INT) AS payment_type,
  round(CAST(CAST(l_discount AS FLOAT) AS DOUBLE), 2) AS total_amount FROM lineitem""")
def _(g):
    """Order lines dressed as ride rows, projected, sent as messages and parsed as rides."""
    names = {"VendorID": "l_suppkey", "passenger_count": "l_quantity",
             "trip_distance": "l_extendedprice", "PULocationID": "l_partkey",
             "DOLocationID": "l_orderkey", "payment_type": "l_linenumber",
             "total_amount": "l_discount"}
    whole = ("passenger_count",)
    rides = g.table("lineitem").select(*[
        (F.col(c).cast("int") if name in whole else F.col(c)).cast("string").alias(name)
        for name, c in names.items()])
    sent = kafka.to_kafka_records(staging.ride_projection(rides), ["vendorId"])
    got = sent.transform(payload).transform(parse_json, schemas.RIDE).transform(flatten)
    return got.drop("pickup_datetime").withColumns({
        c: F.round(F.col(c).cast("double"), 2) for c in ("trip_distance", "total_amount")})


@query("csv_scan", "SELECT * FROM songs")
def _(g):
    path = scratch_path(g.spark, "songs") + ".csv"
    _write_csv(g.songs(), path)
    return files.csv_scan(g.spark, path, schemas.SONGS)


@query("csv_to_parquet", "SELECT * FROM state_codes")
def _(g):
    path = scratch_path(g.spark, "states")
    _write_csv(g.state_codes(), f"{path}.csv")
    files.csv_to_parquet(g.spark, f"{path}.csv", f"{path}.parquet", schemas.STATE_CODES)
    return g.spark.read.parquet(f"{path}.parquet")


@query("load_songs", "SELECT * FROM songs")
def _(g):
    path = scratch_path(g.spark, "songs")
    _write_csv(g.songs(), f"{path}.csv")
    return load_songs(g.spark, f"{path}.csv", f"{path}.parquet")


def _write_csv(df: DataFrame, path: str) -> None:
    columns = [c for c in schemas.SONGS.names if c in df.columns] or df.columns
    df.select(*columns).write.option("header", True).option("escape", '"').csv(path)


@query("load_seed", """
SELECT l.userId, l.state, s.stateName FROM (SELECT DISTINCT userId, state FROM stg_listen) l
LEFT JOIN state_codes s ON l.state = s.stateCode""")
def _(g):
    """A seed file in the shape of the shipped one, read and looked up."""
    path = scratch_path(g.spark, "states") + ".csv"
    _write_csv(g.state_codes(), path)
    seed = files.load_seed(g.spark, path)
    users = staged(g).select("userId", "state").distinct()
    return users.join(seed, users["state"] == seed["stateCode"], "left").select(
        "userId", "state", "stateName")


_SLICE = f"""
SELECT trim(artist, chr(34)) AS artist, song, userId, level, date_trunc('millisecond', ts) AS ts
FROM raw_events WHERE event_type = 'view' AND {IN_LAST_SLOT}"""


@query("lake_slice", _SLICE)
def _(g):
    rows = files.lake_slice(g.spark, f"{listen_lake(g)}/{schemas.LISTEN}", schemas.LISTEN,
                            last_slot(g))
    return rows.select("artist", "song", "userId", "level", "ts")


@query("lake_scan", """
SELECT CAST(day(ts) AS INT) AS day, CAST(hour(ts) AS INT) AS hour, count(*) AS n
FROM listen_raw GROUP BY ALL""")
def _(g):
    rows = files.lake_scan(g.spark, f"{listen_lake(g)}/{schemas.LISTEN}", schemas.LISTEN)
    return rows.groupBy("day", "hour").agg(F.count(F.lit(1)).alias("n"))


@query("lake_sink", """
SELECT strftime(time_bucket(INTERVAL '5 minutes', ts), '%Y-%m-%d %H-%M') AS slot, count(*) AS n,
  count(DISTINCT userId) AS users FROM listen_raw GROUP BY ALL""")
def _(g):
    rows = files.lake_scan(g.spark, f"{listen_lake(g)}/{schemas.LISTEN}", schemas.LISTEN)
    return rows.groupBy(F.col("five_minute_interval").alias("slot")).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("userId").alias("users"))


@query("append_staging", "SELECT * FROM stg_listen")
def _(g):
    return files.staging_scan(g.spark, listen_staging(g), schemas.LISTEN)


@query("ensure_table", "SELECT * FROM stg_listen")
def _(g):
    """Making a table that is there already keeps its rows."""
    path = listen_staging(g)
    tables.ensure_table(g.spark, path, schemas.LISTEN)
    return files.staging_scan(g.spark, path, schemas.LISTEN)


@query("replace_slot", "SELECT * FROM stg_listen")
def _(g):
    """Loading a slot again in this mode leaves the table as it was."""
    path = listen_staging(g)
    again = files.staging_scan(g.spark, path, schemas.LISTEN, start=last_slot(g))
    tables.append_staging(written(again, "slot"), path, schemas.LISTEN, "replace_slot")
    return files.staging_scan(g.spark, path, schemas.LISTEN)


@query("staging_scan", "SELECT * FROM stg_listen")
def _(g):
    """The whole staging table."""
    return files.staging_scan(g.spark, listen_staging(g), schemas.LISTEN)


@query("staging_range", """
SELECT * FROM stg_listen WHERE ts >= (SELECT date_trunc('day', MAX(ts)) FROM stg_listen)""")
def _(g):
    """The last day of the staging table, read by its hour partitions."""
    return files.staging_scan(g.spark, listen_staging(g), schemas.LISTEN,
                              start=last_slot(g).replace(hour=0, minute=0))


@query("drop_slice", """
SELECT 'during' AS moment, count(*) AS n FROM stg_listen""")
def _(g):
    """A named slice is there until it is dropped; the rows of a plan made before stay."""
    name = "slice_" + scratch_path(g.spark, "v").rsplit("-", 1)[1]
    tables.register_view(staged(g), name)
    counted = g.spark.table(name).agg(F.count(F.lit(1)).alias("n"))
    if not tables.drop_slice(g.spark, name) or g.spark.catalog.tableExists(name):
        raise RuntimeError("the slice is still there")
    return counted.select(F.lit("during").alias("moment"), "n")


@query("materialize", """
SELECT strftime(ts, '%Y-%m-%d %H') AS ts_hour, count(*) AS n FROM fact_streams GROUP BY ALL""")
def _(g):
    """Rows per hour partition of the stored fact table."""
    fact = star_of(g).fact
    return fact.groupBy(tables.ts_hour(F.col("ts")).alias("ts_hour")).agg(
        F.count(F.lit(1)).alias("n"))


@query("register_view", """
SELECT level, count(*) AS n FROM stg_listen GROUP BY level""")
def _(g):
    tables.register_view(staged(g), "listen_events_view")
    return g.spark.sql("SELECT level, count(*) AS n FROM listen_events_view GROUP BY level")


@query("save_vocab", "SELECT * FROM vocab")
def _(g):
    path = scratch_path(g.spark, "vocab")
    files.save_vocab(seq.song_vocabulary(staged(g)), path)
    return files.load_vocab(g.spark, path)


@query("load_slot", f"""
SELECT userId, trim(artist, chr(34)) AS artist, song, date_trunc('millisecond', ts) AS ts, level
FROM stg_listen WHERE {IN_LAST_SLOT}""")
def _(g):
    """One slot from lake to staging, loaded twice to the same end."""
    base = scratch_path(g.spark, "staging")
    for _run in range(2):
        slots.load_slot(g.spark, listen_lake(g), base, last_slot(g), (schemas.LISTEN,))
    return files.staging_scan(g.spark, f"{base}/{schemas.LISTEN}", schemas.LISTEN).select(
        "userId", "artist", "song", "ts", "level")


@query("missing_slots", """
SELECT DISTINCT strftime(time_bucket(INTERVAL '5 minutes', ts - INTERVAL 5 MINUTES),
  '%Y-%m-%d %H-%M') AS slot FROM raw_events
EXCEPT SELECT slot FROM slots""")
def _(g):
    """Slots that loads at the time of every event would read and that have no listen rows."""
    loaded = staged(g).select(five_minute_interval(F.col("ts")).alias("slot"))
    return slots.missing_slots(g.raw_events(), loaded)


@query("calendar_of_orders", """
SELECT CAST(epoch(d) AS BIGINT) AS dateKey, CAST(strftime(d, '%U') AS INT) AS weekOfYear,
  dayofweek(d) + 1 IN (6, 7) AS weekendFlag, count(*) AS orders
FROM (SELECT CAST(o_orderdate AS TIMESTAMP) AS d FROM orders) GROUP BY ALL""")
def _(g):
    """Calendar attributes joined to the orders of several years."""
    orders = g.table("orders").select(F.col("o_orderdate").cast("timestamp").alias("ts"))
    hours = dims.dim_datetime_of(orders)
    return (orders.join(hours, orders["ts"] == hours["date"])
            .groupBy("dateKey", "weekOfYear", "weekendFlag")
            .agg(F.count(F.lit(1)).alias("orders")))


@query("dim_datetime_fixed", """
SELECT d.year, d.month, count(*) AS hours, count(o.o_orderkey) AS orders FROM (
  SELECT d, CAST(year(d) AS INT) AS year, CAST(month(d) AS INT) AS month FROM (SELECT unnest(generate_series(
    TIMESTAMP '1994-03-01 00:00:00', TIMESTAMP '1997-02-28 23:00:00', INTERVAL 1 HOUR)) AS d)) d
LEFT JOIN orders o ON CAST(o.o_orderdate AS TIMESTAMP) = d.d GROUP BY ALL""")
def _(g):
    """Orders by month of a calendar with a fixed range, months without any included."""
    hours = dims.dim_datetime(g.spark, "1994-03-01 00:00:00", "1997-02-28 23:00:00")
    orders = g.table("orders").select("o_orderkey", F.col("o_orderdate").cast("timestamp").alias("_at"))
    return (hours.join(orders, hours["date"] == orders["_at"], "left").groupBy("year", "month")
            .agg(F.count(F.lit(1)).alias("hours"), F.count("o_orderkey").alias("orders")))
