"""Readers, writers, slots: options, pruning, reruns, missing input."""

import json
from datetime import datetime

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tests.conftest import plan_of
from tunemill import schemas
from tunemill.functions import time as ft
from tunemill.operators import dims, staging
from tunemill.plans import slots
from tunemill.plans.star import build_star, refresh_fact
from tunemill.session import scratch_path, shared_dir
from tunemill.sources import files, kafka, tables
from tunemill.streaming.ingest import ingest


def test_bootstrap_servers():
    assert kafka.bootstrap_servers("h", 9092) == "h:9092"
    assert kafka.bootstrap_servers("h", ["1"]) == "h:1"
    assert kafka.bootstrap_servers("h", ["1", "2", 3, 4]) == "h:1,h:2,h:3,h:4"
    with pytest.raises(ValueError):
        kafka.bootstrap_servers("h", [])


def test_kafka_options():
    stream = kafka.kafka_options("h:1", "t", "g", "latest")
    assert stream == {"kafka.bootstrap.servers": "h:1", "subscribe": "t",
                      "startingOffsets": "latest", "failOnDataLoss": "false",
                      "kafka.group.id": "g"}
    batch = kafka.kafka_options("h:1", "t", streaming=False)
    assert batch == {"kafka.bootstrap.servers": "h:1", "subscribe": "t",
                     "startingOffsets": "earliest"}


def test_seed(spark):
    seed = files.load_seed(spark)
    assert seed.count() == 57 and seed.columns == ["stateCode", "stateName"]
    assert seed.where("stateCode = 'DC '").count() == 1
    trimmed = files.load_seed(spark, trim_seed=True)
    assert trimmed.where("stateCode = 'DC'").first().stateName == "Washington DC"


def test_seed_join(spark):
    events = spark.createDataFrame([("CA",), ("DC",), ("XX",), (None,)], "state string")
    got = {r.state: (r.stateCode, r.stateName)
           for r in dims.join_state_names(events, files.load_seed(spark)).collect()}
    assert got == {"CA": ("CA", "California"), "DC": ("NA", "NA"), "XX": ("NA", "NA"),
                   None: ("NA", "NA")}
    plan = plan_of(dims.join_state_names(events, files.load_seed(spark)))
    assert "BroadcastHashJoin" in plan


def test_csv_with_byte_order_mark(spark):
    path = scratch_path(spark, "bom")
    spark.createDataFrame([("﻿stateCode,stateName",), ("AA,Some place",)], "v string") \
        .coalesce(1).write.text(path)
    rows = files.csv_scan(spark, path, schemas.STATE_CODES).collect()
    assert [tuple(r) for r in rows] == [("AA", "Some place")]


def test_csv_to_parquet_wants_csv(spark):
    with pytest.raises(ValueError):
        files.csv_to_parquet(spark, "songs.json", "out")


def lake_of(spark, given, topic):
    base = scratch_path(spark, "lake")
    ingest(given.envelope(topic), topic).write.partitionBy(*schemas.LAKE_PARTS).parquet(base)
    return base


@pytest.fixture(scope="module")
def auth_lake(spark, given):
    return lake_of(spark, given, schemas.AUTH)


def test_slices_cover_the_lake(spark, given, auth_lake):
    all_rows = files.lake_scan(spark, auth_lake, schemas.AUTH)
    some = [r.s for r in all_rows.select(F.col("five_minute_interval").alias("s"))
            .distinct().orderBy("s").limit(5).collect()]
    for label in some:
        rows = files.lake_slice(spark, auth_lake, schemas.AUTH,
                                datetime.strptime(label, "%Y-%m-%d %H-%M"))
        want = all_rows.where(F.col("five_minute_interval") == label)
        assert rows.count() == want.count() > 0
        assert rows.columns == schemas.WIRE[schemas.AUTH].names


def test_slice_without_files(spark, auth_lake):
    rows = files.lake_slice(spark, auth_lake, schemas.AUTH, datetime(1999, 1, 1))
    assert rows.count() == 0 and rows.columns == schemas.WIRE[schemas.AUTH].names


def test_lake_scan_prunes(spark, auth_lake):
    rows = files.lake_scan(spark, auth_lake, schemas.AUTH).where("day = 2 AND hour = 3")
    plan = plan_of(rows.select("userId"))
    part = plan[plan.index("PartitionFilters"):]
    assert "day" in part.split("]")[0] and "hour" in part.split("]")[0]
    assert "ReadSchema: struct<userId:int>" in plan


def test_staging_scan_prunes(spark, given):
    path = scratch_path(spark, "staging")
    topic = schemas.AUTH
    rows = staging.stg_auth_events(given.auth_raw()).where("day(ts) <= 3")
    tables.append_staging(rows, path, topic)
    got = files.staging_scan(spark, path, topic, datetime(2024, 1, 2), datetime(2024, 1, 2, 6, 30))
    want = rows.where("ts >= '2024-01-02' AND ts < '2024-01-02 06:30:00'")
    assert got.exceptAll(want).count() == 0 and got.count() == want.count() > 0
    plan = plan_of(got)
    assert "ts_hour" in plan[plan.index("PartitionFilters"):].split("PushedFilters")[0]


def test_appends_double_and_replacements_do_not(spark, given):
    topic = schemas.AUTH
    rows = staging.stg_auth_events(given.auth_raw()).where("day(ts) = 1")
    n = rows.count()
    for mode, want in (("append", 2 * n), ("replace_slot", n)):
        path = scratch_path(spark, "staging")
        for _ in range(2):
            tables.append_staging(rows, path, topic, mode)
        assert files.staging_scan(spark, path, topic).count() == want
    with pytest.raises(ValueError):
        tables.append_staging(rows, path, topic, "merge")


def test_slots_one_by_one_equal_the_range(spark, given, auth_lake):
    lake_rows = files.lake_scan(spark, auth_lake, schemas.AUTH).where("day = 1 AND hour < 2")
    one, many = scratch_path(spark, "one"), scratch_path(spark, "many")
    for hour in range(2):
        for minute in range(0, 60, 5):
            run = datetime(2024, 1, 1, hour, minute)
            parts = files.lake_slice(spark, auth_lake, schemas.AUTH, run)
            tables.append_staging(staging.stage(parts, schemas.AUTH), one, schemas.AUTH,
                                  "replace_slot")
    slots.load_range(lake_rows.drop(*schemas.LAKE_PARTS), many, schemas.AUTH)
    a = files.staging_scan(spark, one, schemas.AUTH)
    b = files.staging_scan(spark, f"{many}/{schemas.AUTH}", schemas.AUTH)
    assert a.count() == b.count() > 0 and a.exceptAll(b).count() == 0


def test_load_slot_of_three_topics(spark, given):
    lake, target = scratch_path(spark, "lake"), scratch_path(spark, "staging")
    for topic in schemas.TOPICS:
        rows = ingest(given.envelope(topic), topic).where("day = 1")
        rows.write.partitionBy(*schemas.LAKE_PARTS).parquet(f"{lake}/{topic}")
    label = files.lake_scan(spark, f"{lake}/{schemas.LISTEN}", schemas.LISTEN) \
        .agg(F.min("five_minute_interval")).first()[0]
    slot = datetime.strptime(label, "%Y-%m-%d %H-%M")
    for _ in range(2):
        slots.load_slot(spark, lake, target, slot)
    for topic in schemas.TOPICS:
        want = files.lake_slice(spark, f"{lake}/{topic}", topic, slot).count()
        assert files.staging_scan(spark, f"{target}/{topic}", topic).count() == want
    assert not [t for t in spark.catalog.listTables() if t.name.startswith(schemas.LISTEN + "_0")]


@pytest.mark.parametrize("run,slot", [
    ((2024, 3, 1, 10, 7), (2024, 3, 1, 10, 0)), ((2024, 3, 1, 10, 4), (2024, 3, 1, 9, 55)),
    ((2024, 3, 1, 0, 0), (2024, 2, 29, 23, 55)), ((2024, 1, 1, 0, 3), (2023, 12, 31, 23, 55))])
def test_slot_for(spark, run, slot):
    assert slots.slot_for(datetime(*run)) == datetime(*slot)
    text = datetime(*run).strftime("%Y-%m-%d %H:%M:%S")
    label = spark.range(1).select(ft.slot_for(F.lit(text).cast("timestamp"))).first()[0]
    assert label == datetime(*slot).strftime("%Y-%m-%d %H-%M")


def test_compaction_keeps_rows_in_fewer_files(spark, auth_lake):
    out = scratch_path(spark, "compact")
    tables.compact_slots(spark, auth_lake, out, schemas.AUTH)
    a = files.lake_scan(spark, auth_lake, schemas.AUTH)
    b = files.lake_scan(spark, out, schemas.AUTH)
    assert a.exceptAll(b).count() == 0 and a.count() == b.count()
    assert len(b.inputFiles()) <= len(a.inputFiles())


def test_star_options(spark, given):
    events = staging.stg_listen_events(given.listen_raw())
    star = build_star(spark, events, given.songs(), given.state_codes(),
                      scratch_path(spark, "star"), special_ids=(0,), dedupe_dims=True,
                      calendar=("2024-01-01", "2024-01-10"))
    assert star.datetime.count() == 9 * 24 + 1
    assert star.fact.columns[-1] == "ts"
    assert star.fact.select("ts").distinct().count() == events.count()
    # Only the anonymous user, with an open-ended row per level, matches twice.
    twice = star.fact.groupBy("ts").count().where("count > 1")
    assert twice.join(events, "ts").where("userId <> 0").count() == 0
    late = star.fact.where("ts >= '2024-01-10 01:00:00'")
    assert late.count() > 0 and late.where("dateKey IS NOT NULL").count() == 0
    assert star.wide.where("timestamp >= '2024-01-10 01:00:00'").count() == 0
    assert len(star.wide.columns) == 25


def test_refresh_equals_a_rebuild(spark, given):
    events = staging.stg_listen_events(given.listen_raw())
    base = scratch_path(spark, "star")
    old = events.where("ts < '2024-01-20 13:00:00'")
    build_star(spark, old, given.songs(), given.state_codes(), base)
    whole = build_star(spark, events, given.songs(), given.state_codes(),
                       scratch_path(spark, "star"))
    untouched = {f for f in spark.read.parquet(f"{base}/fact_streams")
                 .where("ts < '2024-01-20'").inputFiles() if "2024-01-19" in f}
    refresh_fact(whole, events, base, F.lit("2024-01-20 12:57:00").cast("timestamp"))
    got = spark.read.parquet(f"{base}/fact_streams").select(*whole.fact.columns)
    # Days before the refreshed one keep the keys they had; user rows grow at the end only.
    late = "ts >= '2024-01-20'"
    assert got.where(late).exceptAll(whole.fact.where(late)).count() == 0
    assert got.count() == whole.fact.count()
    assert untouched and untouched <= set(got.inputFiles())


def test_calendar_of_the_default_range(spark):
    rows = dims.dim_datetime(spark)
    assert rows.count() == 37273
    assert rows.where("weekendFlag").select("dayOfWeek").distinct().count() == 2
    first = rows.orderBy("date").first()
    assert (first.dayOfWeek, first.weekOfYear, first.dateKey) == (2, 39, 1538352000)


def test_staging_defaults(spark):
    empty = spark.createDataFrame([], schemas.lake_schema(schemas.LISTEN))
    row = empty.select(*[F.max(c).alias(c) for c in empty.columns])
    got = staging.stg_listen_events(row).first().asDict()
    assert got.pop("ts") is None
    assert got["duration"] == -1.0 and got["userId"] == 0 and got["lon"] == 0.0
    assert got["registration"] == 9999999999999 and got["artist"] == "NA"
    assert staging.stg_listen_events(empty).count() == 0


def test_shared_dir_follows_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_kafka_options_for_loss_and_rate():
    options = kafka.kafka_options("h:1", "t", fail_on_data_loss=True, max_per_trigger=1000, min_partitions=16)
    assert options["failOnDataLoss"] == "true"
    assert options["maxOffsetsPerTrigger"] == "1000" and options["minPartitions"] == "16"
    assert "maxOffsetsPerTrigger" not in kafka.kafka_options("h:1", "t", streaming=False, max_per_trigger=5)


def test_slice_of_a_lake_that_is_not_there(spark):
    with pytest.raises(AnalysisException):
        files.lake_slice(spark, scratch_path(spark, "none"), schemas.AUTH, datetime(2020, 1, 1)).count()


def test_load_ledger_of_missing_empty_repeated_and_emptied_slots(spark):
    from tunemill.plans import slots
    from tunemill.session import scratch_path
    from tunemill.streaming.ingest import ingest

    base = scratch_path(spark, "ledger")
    at = lambda hour, minute: 1704067200000 + 3_600_000 * hour + 60_000 * minute

    def land(times, mode):
        for topic in schemas.TOPICS:
            rows = spark.createDataFrame([(json.dumps({"ts": t, "userId": 5}),) for t in times], "value string")
            (ingest(rows, topic).write.mode(mode).partitionBy(*schemas.LAKE_PARTS).parquet(f"{base}/lake/{topic}"))

    def load(*names):
        wanted = spark.createDataFrame([(n,) for n in names], "slot string")
        slots.load_slots(spark, f"{base}/lake", f"{base}/staging", f"{base}/ledger", wanted)

    def ledger(topic=schemas.AUTH):
        rows = slots.read_ledger(spark, f"{base}/ledger").where(F.col("topic") == topic).collect()
        return {r.slot[11:]: (r.state, r.n, r.loads) for r in rows}

    def staged(topic=schemas.AUTH):
        return sorted(str(r.ts)[11:16] for r in files.staging_scan(spark, f"{base}/staging/{topic}", topic).collect())

    day = "2024-01-01 "
    assert slots.read_ledger(spark, f"{base}/ledger").count() == 0
    land([at(0, 1), at(0, 2), at(1, 7)], "overwrite")
    load(day + "00-00", day + "00-05")
    assert ledger() == {"00-00": ("loaded", 2, 1), "00-05": ("empty", 0, 1)} and staged() == ["00:01", "00:02"]
    wanted = spark.createDataFrame([(day + "00-00",), (day + "01-05",), (day + "01-05",)], "slot string")
    pending = slots.pending_slots(wanted, slots.read_ledger(spark, f"{base}/ledger"))
    assert sorted(map(tuple, pending.collect())) == sorted((t, day + "01-05") for t in schemas.TOPICS)
    load(day + "01-05", day + "00-00")
    assert ledger() == {"00-00": ("loaded", 2, 2), "00-05": ("empty", 0, 1), "01-05": ("loaded", 1, 1)}
    assert staged() == ["00:01", "00:02", "01:07"] == staged(schemas.LISTEN)
    land([at(0, 6), at(1, 7)], "overwrite")  # one slot is gone from the lake, one came late
    load(day + "00-00", day + "00-05")
    assert ledger() == {"00-00": ("empty", 0, 3), "00-05": ("loaded", 1, 2), "01-05": ("loaded", 1, 1)}
    assert staged() == ["00:06", "01:07"]


def test_a_large_hour_is_written_by_small_tasks(spark):
    """One hour of about 50 MB, which AQE would leave to one task; the session's own setting is as before."""
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key, None)
    rows = spark.range(0, 180_000, 1, 16).select(
        F.lit(datetime(2024, 1, 1)).alias("ts"), *[F.sha2(F.concat("id", F.lit(f"-{i}")), 256).alias(f"c{i}") for i in range(4)])
    path = scratch_path(spark, "large-hour")
    tables.materialize(rows, path, "ts")
    assert len(spark.read.parquet(path).inputFiles()) > 1 and spark.conf.get(key, None) == before
    back = tables.read_table(spark, path, rows)
    assert back.count() == 180_000 and back.select("c0").distinct().count() == 180_000
    spark.conf.set(key, "4k")
    try:
        with tables.small_tasks(spark):
            assert spark.conf.get(key) == "4096b"  # a session that asks for less gets less
        assert spark.conf.get(key) == "4k"
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)
