"""Queries of the scalar functions, each over a whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from tunemill.functions import time as ft
from tunemill.functions.arrays import last_n, pad_sequence, prefix
from tunemill.functions.keys import surrogate_key
from tunemill.functions.text import clean_name, decode_text, escape_text
from tunemill.operators.sequences import bounded_sequences, coded_sequences, song_vocabulary
from tunemill.registry.base import query
from tunemill.registry.star import staged



@query("epoch_ms_to_ts", """
SELECT event_id, date_trunc('millisecond', ts) AS ts FROM raw_events""")
def _(g):
    ms = g.raw_events().select("event_id", F.unix_millis("ts").alias("ms"))
    return ms.select("event_id", ft.epoch_ms_to_ts(F.col("ms")).alias("ts"))


@query("time_parts", """
SELECT event_id, CAST(year(ts) AS INT) AS year, CAST(month(ts) AS INT) AS month,
  CAST(day(ts) AS INT) AS day, CAST(hour(ts) AS INT) AS hour FROM raw_events""")
def _(g):
    return ft.time_parts(g.raw_events().select("event_id", "ts")).drop("ts")


@query("five_minute_interval", """
SELECT event_id, concat(strftime(ts, '%Y-%m-%d %H-'),
  lpad(CAST(CAST(floor(minute(ts) / 5) AS INT) * 5 AS VARCHAR), 2, '0')) AS five_minute_interval
FROM raw_events""")
def _(g):
    return ft.with_slot(g.raw_events().select("event_id", "ts")).drop("ts")


@query("slot_for", """
SELECT event_id, strftime(time_bucket(INTERVAL '5 minutes', ts - INTERVAL 5 MINUTES),
  '%Y-%m-%d %H-%M') AS slot FROM raw_events""")
def _(g):
    return g.raw_events().select("event_id", ft.slot_for(F.col("ts")).alias("slot"))


@query("fix_encoding", """
SELECT event_id, trim(artist, chr(34)) AS artist, trim(song, chr(34)) AS song FROM raw_events""")
def _(g):
    sent = g.raw_events().select("event_id", escape_text("artist").alias("artist"),
                                 escape_text("song").alias("song"))
    return sent.select("event_id", decode_text("artist").alias("artist"),
                       decode_text("song").alias("song"))


@query("decode_text", """
SELECT doc_id, md5(trim(text, chr(34))) AS digest, length(trim(text, chr(34))) AS chars
FROM documents""")
def _(g):
    """Whole documents in four languages, escaped as a broker sends them and decoded again."""
    sent = g.table("documents").select("doc_id", escape_text("text").alias("sent"))
    got = sent.select("doc_id", decode_text("sent").alias("text"))
    return got.select("doc_id", F.md5("text").alias("digest"),
                      F.length("text").cast("bigint").alias("chars"))


@query("surrogate_key", """
SELECT event_id, md5(concat_ws('-', CAST(userId AS VARCHAR), COALESCE(artist, ''),
  COALESCE(CAST(lat AS VARCHAR), ''))) AS k FROM raw_events""")
def _(g):
    return g.raw_events().select("event_id", surrogate_key("userId", "artist", "lat").alias("k"))


@query("fn_coalesce", """
SELECT event_id, COALESCE(auth, 'NA') AS auth, COALESCE(lat, 0.0) AS lat,
  COALESCE(registration, 9999999999999) AS registration FROM raw_events""")
def _(g):
    return g.raw_events().select(
        "event_id", F.coalesce("auth", F.lit("NA")).alias("auth"),
        F.coalesce("lat", F.lit(0.0)).alias("lat"),
        F.coalesce("registration", F.lit(9999999999999)).alias("registration"))


@query("fn_clean_name", """
SELECT song_id, replace(replace(artist_name, chr(34), ''), chr(92), '') AS name FROM songs""")
def _(g):
    return g.songs().select("song_id", clean_name("artist_name").alias("name"))


@query("fn_cast", """
SELECT event_id, CAST(ts AS DATE) AS d, CAST(status AS BIGINT) AS b, CAST(userId AS VARCHAR) AS s,
  CAST(CAST(lon AS DECIMAL(38,9)) AS DOUBLE) AS n,
  CAST(CAST(ts AS VARCHAR) AS TIMESTAMP) AS t FROM raw_events""")
def _(g):
    return g.raw_events().select(
        "event_id", F.col("ts").cast("date").alias("d"), F.col("status").cast("bigint").alias("b"),
        F.col("userId").cast("string").alias("s"),
        F.col("lon").cast("decimal(38,9)").cast("double").alias("n"),
        F.col("ts").cast("string").cast("timestamp").alias("t"))


@query("fn_case_when", """
SELECT event_id, CASE WHEN level = 'paid' THEN 1 ELSE 0 END AS paid FROM raw_events""")
def _(g):
    return g.raw_events().select(
        "event_id", F.when(F.col("level") == "paid", 1).otherwise(0).alias("paid"))


@query("fn_in", """
SELECT event_id, dayofweek(ts) + 1 IN (6, 7) AS weekend FROM raw_events""")
def _(g):
    return g.raw_events().select("event_id", F.dayofweek("ts").isin(6, 7).alias("weekend"))


@query("fn_day_of_week", """
SELECT event_id, CAST(dayofweek(ts) + 1 AS INT) AS dow FROM raw_events""")
def _(g):
    return g.raw_events().select("event_id", F.dayofweek("ts").alias("dow"))


@query("fn_date_parts", """
SELECT event_id, CAST(day(ts) AS INT) AS d, CAST(month(ts) AS INT) AS m,
  CAST(year(ts) AS INT) AS y FROM raw_events""")
def _(g):
    return g.raw_events().select("event_id", F.dayofmonth("ts").alias("d"),
                                 F.month("ts").alias("m"), F.year("ts").alias("y"))


@query("fn_week", """
SELECT o_orderkey, CAST(strftime(CAST(o_orderdate AS DATE), '%U') AS INT) AS week FROM orders""")
def _(g):
    """Over the order dates, which span several years."""
    return g.table("orders").select(
        "o_orderkey", ft.week_of_year(F.col("o_orderdate").cast("date")).alias("week"))


@query("fn_unix_seconds", """
SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS s FROM raw_events""")
def _(g):
    return g.raw_events().select("event_id", F.unix_seconds("ts").alias("s"))


@query("fn_date_trunc", "SELECT event_id, date_trunc('hour', ts) AS h FROM raw_events")
def _(g):
    return g.raw_events().select("event_id", F.date_trunc("hour", "ts").alias("h"))


@query("fn_time_parts", """
SELECT event_id, CAST(hour(ts) AS INT) AS h, CAST(minute(ts) AS INT) AS m FROM raw_events""")
def _(g):
    return g.raw_events().select("event_id", F.hour("ts").alias("h"), F.minute("ts").alias("m"))


@query("fn_format", """
SELECT event_id, concat(strftime(ts, '%Y-%m-%d %H'), '|', lpad(CAST(minute(ts) AS VARCHAR), 2, '0'))
  AS label, CAST(floor(duration) AS BIGINT) AS whole FROM raw_events""")
def _(g):
    return g.raw_events().select(
        "event_id", F.concat(F.date_format("ts", "yyyy-MM-dd HH"), F.lit("|"),
                             F.lpad(F.minute("ts").cast("string"), 2, "0")).alias("label"),
        F.floor("duration").alias("whole"))


@query("fn_from_json", """
SELECT event_id, CAST(regexp_extract(props, '[0-9]+', 0) AS INT) AS k FROM events""")
def _(g):
    return g.table("events").select("event_id", F.from_json("props", "k int").k.alias("k"))


@query("fn_to_json", """
SELECT event_id, concat('{"userId":', CAST(userId AS VARCHAR), ',"level":"', level, '"}') AS j
FROM raw_events""")
def _(g):
    return g.raw_events().select("event_id", F.to_json(F.struct("userId", "level")).alias("j"))


@query("fn_to_timestamp", "SELECT event_id, ts AS time FROM raw_events")
def _(g):
    text = g.raw_events().select("event_id", F.col("ts").cast("string").alias("ts"))
    return text.select("event_id", F.to_timestamp("ts").alias("time"))


@query("fn_arrays", """
SELECT userId, n, array_to_string(list_slice(names, 1, 3), ',') AS head, names[n] AS last,
  array_to_string(list_slice(names, greatest(n - 2, 1), n), ',') AS tail,
  array_to_string(list_concat(items, list_resize([]::BIGINT[], 20 - n, 0)), ',') AS padded FROM coded""")
def _(g):
    events = staged(g)
    named = bounded_sequences(events)
    coded = coded_sequences(events, song_vocabulary(events)).select(
        "userId", F.col("items").alias("codes"))
    return named.join(coded, "userId").select(
        "userId", F.size("items").alias("n"), F.array_join(prefix(F.col("items"), 3), ",").alias("head"),
        F.element_at("items", -1).alias("last"),
        F.array_join(last_n(F.col("items"), 3), ",").alias("tail"),
        F.array_join(pad_sequence(F.col("codes"), 20).cast("array<string>"), ",").alias("padded"))


@query("fn_divide", """
SELECT event_id, CAST(epoch_ms(date_trunc('millisecond', ts)) AS DOUBLE) / 1000 AS seconds FROM raw_events""")
def _(g):
    return g.raw_events().select("event_id", (F.unix_millis("ts") / 1000).alias("seconds"))


@query("fn_window", """
SELECT event_id, time_bucket(INTERVAL '5 minutes', ts) AS s,
  time_bucket(INTERVAL '5 minutes', ts) + INTERVAL 5 MINUTES AS e FROM raw_events""")
def _(g):
    w = F.window("ts", "5 minutes")
    return g.raw_events().select("event_id", w.alias("w")).select(
        "event_id", F.col("w.start").alias("s"), F.col("w.end").alias("e"))


@query("fn_sequence_explode", """
SELECT event_id, unnest(generate_series(date_trunc('hour', ts), date_trunc('hour', ts)
  + INTERVAL 2 HOURS, INTERVAL 1 HOUR)) AS hour FROM raw_events""")
def _(g):
    first = F.date_trunc("hour", "ts")
    hours = F.sequence(first, first + F.expr("INTERVAL 2 HOURS"), F.expr("INTERVAL 1 HOUR"))
    return g.raw_events().select("event_id", F.explode(hours).alias("hour"))
