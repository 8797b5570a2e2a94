"""Queries of the event-time aggregates, in batch and as finite streams."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunemill import schemas
from tunemill.operators import aggregates as agg
from tunemill.operators import staging
from tunemill.registry.base import query
from tunemill.session import scratch_path
from tunemill.sources import files
from tunemill.streaming import jobs, keyed, sinks
from tunemill.streaming.ingest import ingest

_BUCKET = "time_bucket(INTERVAL '5 minutes', ts)"
_BOUNDS = f"{_BUCKET} AS \"start\", {_BUCKET} + INTERVAL 5 MINUTES AS \"end\""

_TRENDS = f"SELECT {_BOUNDS}, song, count(*) AS \"count\" FROM {{}} GROUP BY ALL"
_RATES = f"""SELECT {_BOUNDS},
  round(CAST(count(success) AS DOUBLE) / count(*), 9) AS success_rate,
  round(avg(CASE WHEN success THEN CAST(1 AS DOUBLE) WHEN NOT success THEN 0 END), 9) AS true_rate
FROM {{}} GROUP BY ALL"""
# A window is written once its end is not after the newest event less the delay.
_CLOSED = """ SELECT * FROM ({}) WHERE "end" <=
  (SELECT date_trunc('millisecond', MAX(ts)) - INTERVAL 10 MINUTES FROM {})"""


def rounded(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 9) for c in cols})


# The batch forms take the ingested rows, as the streams do.
@query("song_trends", _TRENDS.format("listen_raw"))
def _(g):
    return agg.song_trends(g.listen_raw())


@query("user_engagement", """
SELECT userId, round(avg(duration), 6) AS avg_session_duration FROM listen_raw GROUP BY userId""")
def _(g):
    return agg.user_engagement(g.listen_raw()).withColumn(
        "avg_session_duration", F.round("avg_session_duration", 6))


@query("auth_success_rate", _RATES.format("auth_raw"))
def _(g):
    return rounded(agg.auth_success_rate(g.auth_raw()), "success_rate", "true_rate")


@query("window_bounds", f"SELECT {_BOUNDS}, count(*) AS n FROM raw_events GROUP BY ALL")
def _(g):
    per_window = g.raw_events().groupBy(F.window("ts", "5 minutes")).agg(
        F.count(F.lit(1)).alias("n"))
    return agg.window_bounds(per_window)


def _listen_stream(g) -> DataFrame:
    return ingest(g.envelope(schemas.LISTEN, g.event_stream()), schemas.LISTEN)


def _auth_stream(g) -> DataFrame:
    return ingest(g.envelope(schemas.AUTH, g.event_stream()), schemas.AUTH)


def _run(g, df: DataFrame, mode: str) -> DataFrame:
    """Drive a stream over all its input and return the log of its table."""
    path = scratch_path(g.spark, "live")
    writer = sinks.table_sink(df, f"{path}/table", f"{path}/checkpoint", mode, "available")
    jobs.finish([writer.start()])
    return sinks.read_log(g.spark, f"{path}/table", df)


@query("song_trends_stream", _CLOSED.format(_TRENDS.format("listen_raw"), "listen_raw"))
def _(g):
    return _run(g, agg.song_trends(_listen_stream(g)), "append").drop(sinks.BATCH)


@query("auth_success_rate_stream", _CLOSED.format(_RATES.format("auth_raw"), "auth_raw"))
def _(g):
    log = _run(g, agg.auth_success_rate(_auth_stream(g)), "append").drop(sinks.BATCH)
    return rounded(log, "success_rate", "true_rate")


@query("user_engagement_stream", """
SELECT userId, round(avg(duration), 6) AS avg_session_duration FROM listen_raw GROUP BY userId""")
def _(g):
    log = _run(g, agg.user_engagement(_listen_stream(g)), "update")
    return sinks.latest_rows(log, "userId").withColumn(
        "avg_session_duration", F.round("avg_session_duration", 6))


@query("drop_duplicate_events_stream", """
SELECT userId, date_trunc('millisecond', ts) AS ts, level FROM auth_raw""")
def _(g):
    """Two copies of every message in one stream, one of each in the table."""
    once = _auth_stream(g)
    twice = once.unionByName(_auth_stream(g))
    log = _run(g, staging.drop_duplicate_events_stream(twice), "append")
    return log.select(F.col("userId").cast("bigint"), "ts", "level")


@query("table_sink", """
SELECT userId, song, date_trunc('millisecond', ts) AS ts FROM listen_raw""")
def _(g):
    return _run(g, _listen_stream(g).select("userId", "song", "ts"), "append").drop(sinks.BATCH)


@query("run_ingest", """
SELECT 'listen_events' AS topic, userId, date_trunc('millisecond', ts) AS ts FROM listen_raw
UNION ALL SELECT 'page_view_events', userId, date_trunc('millisecond', ts) FROM page_raw
UNION ALL SELECT 'auth_events', userId, date_trunc('millisecond', ts) FROM auth_raw""")
def _(g):
    """Streams of the three topics, running at once in one session."""
    base = scratch_path(g.spark, "live")
    rows = {t: ingest(g.envelope(t, g.event_stream()), t).select(
        F.lit(t).alias("topic"), F.col("userId").cast("bigint").alias("userId"), "ts")
        for t in schemas.TOPICS}
    writers = [sinks.table_sink(df, f"{base}/{t}", f"{base}/checkpoint/{t}", "append", "available")
               for t, df in rows.items()]
    jobs.finish(jobs.run_ingest(g.spark, writers, wait=False))
    logs = [sinks.read_log(g.spark, f"{base}/{t}", df).drop(sinks.BATCH)
            for t, df in rows.items()]
    return logs[0].unionByName(logs[1]).unionByName(logs[2])


@query("table_sink_replace", """
SELECT userId, round(avg(duration), 6) AS avg_session_duration FROM listen_raw GROUP BY userId""")
def _(g):
    """User averages in the keyed table, fed one file of events at a time and replayed by a second checkpoint."""
    path = scratch_path(g.spark, "keyed")
    # The messages are made once, so no batch looks up the songs again; ids, not rows, decide where one goes.
    messages = g.envelope(schemas.LISTEN, keep="event_id % 3 AS share")
    messages.write.partitionBy("share").parquet(f"{path}/in")
    stream = (g.spark.readStream.schema(messages.drop("share").schema).option("maxFilesPerTrigger", 8)
              .parquet(f"{path}/in/*"))
    df = agg.user_engagement(ingest(stream, schemas.LISTEN))
    for run in ("first", "second"):
        jobs.finish([keyed.keyed_table_sink(df, f"{path}/table", f"{path}/{run}", ("userId",), "available").start()])
    keyed.compact(g.spark, f"{path}/table")
    return keyed.read_state(g.spark, f"{path}/table", df).withColumn(
        "avg_session_duration", F.round("avg_session_duration", 6))


_TORN = "event_id % 500 = 7"


def _sides(topic: str, types: str) -> str:
    rows = f"FROM raw_events WHERE event_type IN ({types})"
    return (f"SELECT '{topic}' AS topic, 'lake' AS side, count(*) AS n, CAST(sum(epoch_ms(date_trunc('millisecond', ts))) AS DECIMAL(38, 0)) AS times "
            f"{rows} AND NOT {_TORN} UNION ALL SELECT '{topic}', 'quarantine', count(*), NULL {rows} AND {_TORN}")


@query("ingest_all_topics", " UNION ALL ".join((
    _sides("listen_events", "'view'"), _sides("page_view_events", "'click', 'purchase'"),
    _sides("auth_events", "'signup', 'error'"))))
def _(g):
    """All messages of the three topics, some torn off in the middle, landed at once; rows on both sides."""
    base = scratch_path(g.spark, "landing")
    torn = F.expr(_TORN.replace("event_id", "_id"))
    sources = {}
    for topic in schemas.TOPICS:
        messages = g.envelope(topic, g.event_stream(), keep="event_id AS _id")
        sources[topic] = messages.withColumn(
            "value", F.when(torn, F.expr("substring(value, 1, 9)")).otherwise(F.col("value")))
    jobs.finish(jobs.run_ingest(g.spark, jobs.ingest_all_topics(sources, base, "available"), wait=False))
    sides = []
    for topic in schemas.TOPICS:
        lake = files.lake_scan(g.spark, f"{base}/{topic}", topic)
        sides += [(topic, "lake", lake, F.sum(F.unix_millis("ts"))),
                  (topic, "quarantine", sinks.read_quarantine(g.spark, f"{base}/quarantine/{topic}"), F.lit(None))]
    counts = [df.agg(F.count(F.lit(1)).alias("n"), times.cast("decimal(38, 0)").alias("times")).select(
        F.lit(topic).alias("topic"), F.lit(side).alias("side"), "n", "times") for topic, side, df, times in sides]
    return reduce(DataFrame.unionByName, counts)


@query("realtime_aggregates", f"""
SELECT 'real_listen' AS name, count(*) AS n FROM (
  {_CLOSED.format(_TRENDS.format("listen_raw"), "listen_raw")})
UNION ALL SELECT 'real_user', count(DISTINCT userId) FROM listen_raw
UNION ALL SELECT 'real_auth', count(*) FROM (
  {_CLOSED.format(_RATES.format("auth_raw"), "auth_raw")})""")
def _(g):
    """The three live tables of one session; rows in each at the end of the input."""
    base = scratch_path(g.spark, "live")
    listen, auth = _listen_stream(g), _auth_stream(g)
    writers = jobs.realtime_aggregates(listen, auth, base, "available")
    jobs.finish(jobs.run_ingest(g.spark, writers, wait=False))
    tables = {
        "real_listen": sinks.read_log(g.spark, f"{base}/real_listen", agg.song_trends(listen)),
        "real_user": keyed.read_state(g.spark, f"{base}/real_user", agg.user_engagement(listen)),
        "real_auth": sinks.read_log(g.spark, f"{base}/real_auth", agg.auth_success_rate(auth)),
    }
    counts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n")
              for name, df in tables.items()]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])
