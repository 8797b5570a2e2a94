"""Finite streams: stream equals batch, late and unreadable rows, restarts, several queries."""

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL, plan_of
from tunemill import schemas
from tunemill.operators import aggregates as agg
from tunemill.session import scratch_path
from tunemill.sources import files
from tunemill.streaming import ingest as ing
from tunemill.streaming import jobs, keyed, sinks

START = datetime(2024, 1, 1)


def listen(minute, song="s", user=1, **more):
    ts = int((START + timedelta(minutes=minute) - datetime(1970, 1, 1)).total_seconds() * 1000)
    return json.dumps({"song": song, "artist": "a", "ts": ts, "userId": user,
                       "duration": 10.0, **more})


def put(spark, path, messages):
    """One more input file of messages; ``value`` holds the text."""
    spark.createDataFrame([(m,) for m in messages], "value string") \
        .coalesce(1).write.mode("append").text(path)


def source(spark, path):
    return spark.readStream.schema("value string").text(path)


def run(df, path, mode):
    writer = sinks.table_sink(df, f"{path}/table", f"{path}/checkpoint", mode, "available")
    jobs.finish([writer.start()])
    return sinks.read_log(df.sparkSession, f"{path}/table", df)


def test_ingest_fields(spark):
    df = spark.createDataFrame([
        (listen(7.5, song="Bj\\303\\266rk", artist='"x"', zip=5, sessionid=3, sessionId=9),),
        ("no json",), ("{}",), (None,)], "value string")
    rows = ing.ingest(df, schemas.LISTEN).collect()
    assert rows[0].song == "Björk" and rows[0].artist == "x" and rows[0].sessionid == 3
    assert rows[0].ts == START + timedelta(minutes=7.5)
    assert (rows[0].year, rows[0].month, rows[0].day, rows[0].hour) == (2024, 1, 1, 0)
    assert rows[0].five_minute_interval == "2024-01-01 00-05"
    assert all(v is None for r in rows[1:] for v in r) and len(rows) == 4
    assert ing.ingest(df, schemas.LISTEN).columns == schemas.lake_schema(schemas.LISTEN).names


def test_auth_text_is_left_alone(spark):
    df = spark.createDataFrame([(json.dumps({"city": '"c\\\\303"', "ts": 0}),)], "value string")
    assert ing.ingest(df, schemas.AUTH).first().city == '"c\\\\303"'


def test_corrupt_messages_go_aside(spark):
    df = spark.createDataFrame([(listen(1),), ("no json",), ('{"ts": "x"}',)], "value string")
    bad = {r.value for r in ing.corrupt_messages(df, schemas.LISTEN).collect()}
    assert bad == {"no json", '{"ts": "x"}'}


def test_ingest_stays_in_the_jvm(spark):
    df = spark.createDataFrame([(listen(1),)], "value string")
    plan = plan_of(ing.ingest(df, schemas.LISTEN))
    assert "EvalPython" not in plan and "Exchange" not in plan


def test_windows_close_with_the_watermark(spark):
    path = scratch_path(spark, "ordered")
    put(spark, f"{path}/in", [listen(m) for m in range(20)])
    trends = agg.song_trends(ing.ingest(source(spark, f"{path}/in"), schemas.LISTEN))
    rows = run(trends, path, "append").collect()
    assert [(r.start, r.end, r["count"]) for r in rows] == [
        (START, START + timedelta(minutes=5), 5)]


def test_late_rows_are_dropped_and_no_row_counts_twice(spark):
    path = scratch_path(spark, "late")
    put(spark, f"{path}/in", [listen(m) for m in range(40)])
    trends = agg.song_trends(ing.ingest(source(spark, f"{path}/in"), schemas.LISTEN))
    run(trends, path, "append")
    # 30 minutes behind the newest row: too late. 5 minutes behind: in time.
    put(spark, f"{path}/in", [listen(9), listen(34.5)])
    run(trends, path, "append")
    put(spark, f"{path}/in", [listen(120, "end")])
    log = run(trends, path, "append").where("song = 's'")
    got = {r.start: r["count"] for r in log.collect()}
    want = {START + timedelta(minutes=5 * i): 5 for i in range(8)}
    want[START + timedelta(minutes=30)] = 6
    assert got == want and log.count() == 8


def test_update_log_gives_the_latest_state(spark):
    path = scratch_path(spark, "update")
    put(spark, f"{path}/in", [listen(1, user=1, duration=10.0), listen(2, user=2, duration=4.0)])
    users = agg.user_engagement(ing.ingest(source(spark, f"{path}/in"), schemas.LISTEN))
    run(users, path, "update")
    put(spark, f"{path}/in", [listen(3, user=1, duration=20.0)])
    log = run(users, path, "update")
    assert log.count() == 3
    got = {r.userId: r.avg_session_duration for r in sinks.latest_rows(log, "userId").collect()}
    assert got == {1: 15.0, 2: 4.0}


def test_success_rates(spark):
    path = scratch_path(spark, "auth")
    rows = [(0, True), (1, False), (2, None), (3, True)]
    put(spark, f"{path}/in", [
        json.dumps({"ts": 1704067200000 + 60000 * m, **({} if s is None else {"success": s})})
        for m, s in rows + [(30, True)]])
    rates = agg.auth_success_rate(ing.ingest(source(spark, f"{path}/in"), schemas.AUTH))
    first = run(rates, path, "append").orderBy("start").first()
    assert first.success_rate == 0.75 and first.true_rate == pytest.approx(2 / 3)


def test_a_repeated_batch_is_stored_once(spark):
    path = scratch_path(spark, "again")
    put(spark, f"{path}/in", [listen(1, user=u) for u in range(5)])
    df = ing.ingest(source(spark, f"{path}/in"), schemas.LISTEN).select("userId")
    run(df, path, "append")
    # A lost checkpoint replays the same batch under the same number.
    writer = sinks.table_sink(df, f"{path}/table", f"{path}/checkpoint2", "append", "available")
    jobs.finish([writer.start()])
    assert sinks.read_log(spark, f"{path}/table", df).count() == 5


def test_three_topics_at_once(spark, given):
    """All messages of the given events land, each once, also when the job runs a second time."""
    base = scratch_path(spark, "topics")
    sources = {}
    for topic in schemas.TOPICS:
        given.envelope(topic).select(F.col("value").cast("string")).write.text(f"{base}/in/{topic}")
        sources[topic] = source(spark, f"{base}/in/{topic}")
    for _ in range(2):
        running = jobs.run_ingest(spark, jobs.ingest_all_topics(sources, f"{base}/lake", "available"))
        jobs.finish(running)
        assert len({q.id for q in running}) == 3
    for topic in schemas.TOPICS:
        landed = files.lake_scan(spark, f"{base}/lake/{topic}", topic)
        batch = ing.ingest(spark.read.text(f"{base}/in/{topic}"), topic)
        assert landed.exceptAll(batch).count() == 0 and landed.count() == batch.count() > 150
        assert sinks.read_quarantine(spark, f"{base}/lake/quarantine/{topic}").count() == 0


def test_only_a_large_slot_is_dealt_to_several_tasks(spark):
    """Of 3,000 rows 2,001 are in one slot: that one gets three shares of 1,000 rows, the others one each."""
    rows = spark.range(3000).select(F.when(F.col("id") < 2001, 0).otherwise(F.col("id") % 9 + 1).cast("int").alias("hour"),
                                    *[F.lit(1).alias(c) for c in ("year", "month", "day")],
                                    F.lit("slot").alias("five_minute_interval"), "id")
    dealt = sinks.spread_slots(rows, 64, 1000)
    assert dealt.columns == rows.columns and dealt.exceptAll(rows).count() == 0 and dealt.count() == 3000
    tasks = {r.hour: r.n for r in dealt.withColumn("_p", F.spark_partition_id()).groupBy("hour").agg(
        F.count_distinct("_p").alias("n")).collect()}
    assert 1 < tasks.pop(0) <= 3 and set(tasks) == set(range(1, 10)) and set(tasks.values()) == {1}


def test_a_large_batch_lands_one_file_a_slot(spark, monkeypatch):
    """60 rows in twelve slots, with a bound of 20 rows a task that no slot passes."""
    monkeypatch.setattr(sinks, "TASK_ROWS", 20)
    path = scratch_path(spark, "files")
    put(spark, f"{path}/in", [listen(m, user=m) for m in range(60)])
    df = ing.ingest_checked(source(spark, f"{path}/in"), schemas.LISTEN)
    jobs.finish([sinks.checked_lake_sink(df, f"{path}/lake", f"{path}/bad", f"{path}/c", "available").start()])
    landed = files.lake_scan(spark, f"{path}/lake", schemas.LISTEN)
    assert landed.count() == 60 and len(landed.inputFiles()) == 12


def landed_of(spark, path):
    rows = files.lake_scan(spark, f"{path}/lake", schemas.LISTEN)
    bad = sinks.read_quarantine(spark, f"{path}/bad")
    return sorted(r.userId for r in rows.collect()), sorted(r.value for r in bad.collect())


def test_unreadable_messages_go_to_the_quarantine(spark):
    path = scratch_path(spark, "sides")
    bad = ["{torn", "", '{"song": "no time"}', '{"ts": "not a number", "userId": 3}', "[1, 2]"]
    put(spark, f"{path}/in", [listen(1, user=1), *bad, listen(2, user=2)])
    df = ing.ingest_checked(source(spark, f"{path}/in"), schemas.LISTEN)

    def go(checkpoint):
        jobs.finish([sinks.checked_lake_sink(df, f"{path}/lake", f"{path}/bad", f"{path}/{checkpoint}", "available").start()])

    go("a")
    assert landed_of(spark, path) == ([1, 2], sorted(bad))
    put(spark, f"{path}/in", [listen(3, user=3), "{more"])
    go("a")
    assert landed_of(spark, path) == ([1, 2, 3], sorted([*bad, "{more"]))
    slot = files.lake_slice(spark, f"{path}/lake", schemas.LISTEN, datetime(2024, 1, 1, 0, 0))
    assert "landed" not in slot.columns and slot.count() == 3
    go("b")  # a new checkpoint reads all again and keeps what was landed before
    assert landed_of(spark, path)[0] == [1, 1, 2, 2, 3, 3]


@pytest.mark.parametrize("lost", ["commits", "landed"])
def test_a_batch_that_runs_again_lands_once(spark, lost):
    """A run that was lost before the batch's end was noted, and one lost before it was marked as landed."""
    path = scratch_path(spark, "lost")
    put(spark, f"{path}/in", [listen(1, user=1), "{torn"])
    df = ing.ingest_checked(source(spark, f"{path}/in"), schemas.LISTEN)

    def go():
        jobs.finish([sinks.checked_lake_sink(df, f"{path}/lake", f"{path}/bad", f"{path}/c", "available").start()])

    go()
    assert landed_of(spark, path) == ([1], ["{torn"])
    at = spark._jvm.org.apache.hadoop.fs.Path
    fs = at(path).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.delete(at(f"{path}/c/commits"), True)
    if lost == "landed":
        (mark,) = fs.listStatus(at(f"{path}/c/landed"))
        fs.rename(at(f"{path}/c/landed"), at(f"{path}/c/held"))  # what it held is there, the mark isn't
        assert mark.getPath().getName().endswith("-0")
    go()
    assert landed_of(spark, path) == ([1], ["{torn"])


def state_of(spark, path, df):
    return {r.userId: r.avg_session_duration for r in keyed.read_state(spark, path, df).collect()}


def test_keyed_table_over_batches_replays_and_checkpoints(spark):
    path = scratch_path(spark, "keyed")
    put(spark, f"{path}/in", [listen(1, user=u, duration=float(u)) for u in range(40)])
    users = agg.user_engagement(ing.ingest(source(spark, f"{path}/in"), schemas.LISTEN))

    def go(checkpoint):
        jobs.finish([keyed.keyed_table_sink(users, f"{path}/t", f"{path}/{checkpoint}", ("userId",), "available").start()])

    assert state_of(spark, f"{path}/t", users) == {}
    go("a")
    assert state_of(spark, f"{path}/t", users) == {u: float(u) for u in range(40)}
    before = keyed.manifest(spark, f"{path}/t")
    put(spark, f"{path}/in", [listen(2, user=3, duration=5.0)])
    go("a")
    after = keyed.manifest(spark, f"{path}/t")
    want = {u: float(u) for u in range(40)} | {3: 4.0}
    assert state_of(spark, f"{path}/t", users) == want
    assert sum(after["buckets"][b] != f for b, f in before["buckets"].items()) == 1  # one bucket was touched
    go("b")  # a new checkpoint starts at batch 0 again
    assert state_of(spark, f"{path}/t", users) == want
    assert len(keyed.manifest(spark, f"{path}/t")["applied"]) == 2
    assert keyed.compact(spark, f"{path}/t", keep=1) >= 1
    assert state_of(spark, f"{path}/t", users) == want
    assert keyed.compact(spark, f"{path}/t", keep=1) == 0


def test_an_applied_batch_and_a_torn_manifest_change_nothing(spark):
    path = scratch_path(spark, "torn")
    first = spark.createDataFrame([(1, "a"), (None, "n"), (2, "b")], "k long, v string")
    second = spark.createDataFrame([(1, "x"), (None, "m")], "k long, v string")
    assert keyed.upsert(first, path, ("k",), "q", 0)
    assert keyed.upsert(second, path, ("k",), "q", 1)
    assert not keyed.upsert(first, path, ("k",), "q", 1) and not keyed.upsert(first, path, ("k",), "q", 0)
    want = {(1, "x"), (None, "m"), (2, "b")}
    assert {tuple(r) for r in keyed.read_state(spark, path, first).collect()} == want
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_manifests/{3:012d}.json")
    out = at.getFileSystem(spark._jsc.hadoopConfiguration()).create(at, False)
    out.write(bytearray(b'{"buckets": {"1"'))  # its writer was lost
    out.close()
    assert {tuple(r) for r in keyed.read_state(spark, path, first).collect()} == want
    assert keyed.upsert(spark.createDataFrame([(2, "c")], "k long, v string"), path, ("k",), "q", 2)
    assert {tuple(r) for r in keyed.read_state(spark, path, first).collect()} == {(1, "x"), (None, "m"), (2, "c")}


def test_the_keyed_query_looks_up_songs_once(spark, monkeypatch):
    """Its stream reads messages, so no batch joins the songs, and none sends them to the driver."""
    from tunemill.registry import QUERIES
    from tunemill.registry import streams
    seen = []
    sink = keyed.keyed_table_sink
    monkeypatch.setattr(streams.keyed, "keyed_table_sink", lambda df, *a: (seen.append(df), sink(df, *a))[1])
    assert QUERIES["table_sink_replace"](spark, SMALL).count() > 0
    plans = [df._jdf.queryExecution().logical().toString() for df in seen]
    assert len(plans) == 2 and all("Aggregate" in p and "Join" not in p and "p_partkey" not in p for p in plans)


def test_memory_and_console_sinks(spark, capsys):
    path = scratch_path(spark, "mem")
    put(spark, f"{path}/in", [listen(1), listen(2)])
    df = ing.ingest(source(spark, f"{path}/in"), schemas.LISTEN).select("song")
    jobs.finish([sinks.triggered(sinks.memory_sink(df, "seen"), "available").start()])
    assert spark.table("seen").count() == 2
    jobs.finish([sinks.triggered(sinks.console_sink(df), "available").start()])


def test_stream_of_the_given_events(spark, given):
    stream = given.event_stream()
    assert stream.isStreaming
    path = scratch_path(spark, "given")
    log = run(stream.select("event_id"), path, "append")
    assert log.count() == spark.read.parquet(f"{SMALL}/events.parquet").count()
