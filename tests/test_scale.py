"""Plans under skew and beyond the broadcast limit: what happens to a hot key."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_of
from tunemill.operators import dims, facts
from tunemill.operators import sequences as seq
from tunemill.operators.staging import stg_listen_events
from tunemill.schemas import LISTEN, STAGING
from tunemill.session import written


@pytest.fixture
def skewed(spark):
    """Plays of which one user and one song own 40 percent each."""
    hot = F.col("id") % 10 < 4
    day = F.floor(F.col("id") / 15000)
    rows = spark.range(300_000).select(
        F.when((F.col("id") * 7) % 10 < 4, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 500))
        .alias("song"),
        F.lit("a").alias("artist"),
        F.timestamp_seconds(1704067200 + F.col("id") * 5).alias("ts"),
        F.when(day % 2 == 0, "free").otherwise("paid").alias("level"),
        F.when(hot, 7).otherwise(100 + F.col("id") % 2000).alias("userId"))
    empty = [f for f in STAGING[LISTEN].fields if f.name not in rows.columns]
    return stg_listen_events(rows.select("*", *[F.lit(None).cast(f.dataType).alias(f.name)
                                                for f in empty]))


@pytest.fixture
def small_partitions(spark):
    """Limits scaled down with the data, and no join small enough to broadcast."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def final_plan(df) -> str:
    df.collect()
    return plan_of(df)


def test_interval_join_splits_a_hot_user(spark, skewed, small_partitions):
    users = written(dims.dim_users(skewed), "users")  # stored, as build_star does
    joined = facts.join_user_scd2(facts.with_join_keys(skewed), users)
    counted = joined.groupBy(F.col("userKey").isNull().alias("missing")).count()
    plan = final_plan(counted)
    assert "skew=true" in plan
    assert {r.missing: r["count"] for r in counted.collect()} == {False: 300_000}


def test_encoding_splits_a_hot_song(spark, skewed, small_partitions):
    coded = seq.encode_plays(skewed.select("userId", "ts", "song"), seq.song_vocabulary(skewed))
    counted = coded.groupBy("label").count().agg(F.sum("count").alias("n"))
    plan = final_plan(counted)
    assert "skew=true" in plan and counted.first().n == 300_000


def test_history_of_a_hot_user(skewed):
    """Of the hot user's 120,000 plays a row for each segment and each change of level goes on."""
    from tunemill.operators import scd2
    from tunemill.operators.segments import PART, in_segments
    placed = in_segments(scd2.distinct_user_states(skewed), scd2.USER, "date")
    starts = scd2.run_starts(placed.rows).where("userId = 7").count()
    parts = placed.rows.where("userId = 7").select(PART).distinct().count()
    assert parts <= starts <= parts + 40


def test_hot_user_has_whole_positions(skewed):
    got = seq.play_positions(skewed).where("userId = 7").agg(
        F.count("*").alias("n"), F.max("pos").alias("top"), F.count_distinct("pos").alias("d"))
    assert tuple(got.first()) == (120_000, 119_999, 120_000)


def test_small_dimensions_are_broadcast_by_size_only(spark, given):
    events = stg_listen_events(given.listen_raw())
    plays = facts.with_join_keys(events)
    hours = dims.dim_datetime_of(events)
    assert "BroadcastHashJoin" in plan_of(facts.join_datetime(plays, hours))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(facts.join_datetime(plays, dims.dim_datetime_of(events)))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" in plan and "NestedLoop" not in plan


def test_wide_view_has_no_nested_loop(spark, given):
    events = stg_listen_events(given.listen_raw())
    tables = (dims.dim_users(events), dims.dim_artists(given.songs()),
              dims.dim_songs(given.songs()), dims.dim_location(events, given.state_codes()),
              dims.dim_datetime_of(events))
    wide = facts.wide_streams(facts.fact_streams(events, *tables), *tables)
    plan = plan_of(wide)
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Python" not in plan


def test_staging_reads_only_its_columns(given):
    plan = plan_of(stg_listen_events(given.listen_raw()).select("userId", "ts"))
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string" in plan
    assert "EqualTo(event_type,view)" in plan


def test_calendar_is_made_by_many_tasks_and_ignores_broken_clocks(spark):
    events = spark.range(1).selectExpr("explode(array(timestamp'2024-01-01 10:30:00', timestamp'2024-01-03 00:00:00', "
                                       "timestamp_seconds(1515000000000), timestamp_seconds(-99999999999), NULL)) AS ts")
    hours = dims.dim_datetime_of(events)
    assert hours.agg(F.count("*"), F.min("date").cast("string"), F.max("date").cast("string")).first()[:] == (
        39, "2024-01-01 10:00:00", "2024-01-03 00:00:00")
    keyed = facts.join_datetime(events.withColumn("_hour", F.date_trunc("hour", "ts")), hours)
    assert sorted(r.dateKey is None for r in keyed.select("dateKey").collect()) == [False, False, True, True, True]
    century = dims.dim_datetime(spark, "1950-01-01 00:00:00", "2049-12-31 23:00:00")
    assert century.rdd.getNumPartitions() > 1 and century.count() == 36525 * 24
    assert "Generate" not in plan_of(century)
    assert dims.dim_datetime_of(events.where("false")).count() == 0


def star_parts(given):
    events = written(stg_listen_events(given.listen_raw()), "staged")
    tables = (dims.dim_users(events), dims.dim_artists(given.songs()), dims.dim_songs(given.songs()),
              dims.dim_location(events, given.state_codes()), dims.dim_datetime_of(events))
    return written(facts.fact_streams(events, *tables), "fact"), tables


def test_wide_view_sorts_no_plays_for_users_and_songs(given, small_partitions):
    fact, tables = star_parts(given)
    wide = facts.wide_streams(fact, *tables, small=0)
    plan = plan_of(wide)
    for key in ("userKey", "songKey"):
        assert [j for j in plan.splitlines() if "SortMergeJoin" in j and key in j] == []
        assert len([j for j in plan.splitlines() if "ShuffledHashJoin" in j and key in j]) >= 1
    plain = facts.wide_streams(fact, *tables)
    assert "ShuffledHashJoin" not in plan_of(plain)
    assert wide.exceptAll(plain).isEmpty() and plain.exceptAll(wide).isEmpty() and not plain.isEmpty()


def test_wide_view_of_an_unstored_fact_shuffles_no_multiplied_play(spark, given, monkeypatch):
    """The songs are met last, and neither an exchange nor a file comes after them."""
    from tunemill.registry import star
    from tunemill.registry.base import QUERIES

    stored = []
    monkeypatch.setattr(star, "written", lambda df, name: stored.append(name) or written(df, name))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(QUERIES["wide_streams"](spark, given.sf_dir)).splitlines()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    top = next(i for i, line in enumerate(plan) if "Join" in line)
    assert "_title" in plan[top] and not [line for line in plan[:top] if "Exchange" in line]
    assert stored == ["staged", "dim_users"]


def test_wide_view_of_an_unstored_fact_has_the_rows_of_a_stored_one(given):
    """Also where keys repeat with other attributes, and where plays find nothing."""
    events = written(stg_listen_events(given.listen_raw()), "staged")
    users, artists, songs, places, hours = (
        dims.dim_users(events), dims.dim_artists(given.songs()), dims.dim_songs(given.songs()),
        dims.dim_location(events, given.state_codes()), dims.dim_datetime_of(events))
    tables = (users.unionByName(users.where("userId % 3 = 0").withColumn("gender", F.lit("X"))),
              artists.unionByName(artists.where("latitude > 20").withColumn("latitude", F.lit(None).cast("double"))),
              songs.unionByName(songs.where("year < 1990").withColumns({"title": F.lit("other"), "tempo": F.lit(1.5)})),
              places.unionByName(places.where("city = 'City_3'")),
              hours.unionByName(hours.where("dayOfMonth = 5").withColumn("date", F.lit(None).cast("timestamp")))
              .where("dayOfMonth <> 7"))
    want = facts.wide_streams(written(facts.fact_streams(events, *tables), "fact"), *tables)
    for small in (0, facts.SMALL_ROWS):
        fact = facts.fact_streams(events, *tables, with_attributes=True, small=small)
        got = facts.wide_streams(fact, *tables)
        assert got.schema.names == want.schema.names and got.dtypes == want.dtypes
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
        assert want.count() > want.distinct().count() > 0


def test_listening_of_a_long_fact_is_taken_in_slices(spark, given, monkeypatch):
    from tunemill.registry import star
    from tunemill.registry.base import QUERIES

    sizes = []

    def counted(df, name):
        stored = written(df, name)
        sizes.append((name, stored.agg(F.sum("plays")).first()[0] if name == "listening" else None))
        return stored

    query = QUERIES["wide_projection"]
    want = sorted(map(tuple, query(spark, given.sf_dir).collect()), key=repr)
    monkeypatch.setattr(star, "SLICE_ROWS", 5)
    monkeypatch.setattr(star, "written", counted)
    got = sorted(map(tuple, query(spark, given.sf_dir).collect()), key=repr)
    plays = [n for name, n in sizes if name == "listening"]
    assert got == want and len(plays) > 3
    assert sum(plays) == sum(row[2] for row in want) and max(plays) < sum(plays) / 2


@pytest.mark.parametrize("slices", [1, 2, 7, 50])
def test_listening_in_slices_counts_each_play_and_distinct_song_once(spark, slices):
    """Against the plain counts of the rows: songs that users share, repeated plays, missing keys."""
    from tunemill.registry.star import listening

    rows = [(user, level, song, 1000 * n + user % 7 if user is not None else n)
            for n, (user, level, song) in enumerate(
                (None if i % 11 == 0 else i % 5, None if i % 13 == 0 else ("free", "paid")[i % 2],
                 None if i % 9 == 0 else f"song{i * i % 17}") for i in range(300))]
    wide = spark.createDataFrame(rows, "userId long, level string, songKey string, timestamp long")
    groups = {}
    for user, level, song, at in rows:
        groups.setdefault((user, level), []).append((song, at))
    want = {(*key, len(of), len({song for song, _ in of} - {None}), min(at for _, at in of), max(at for _, at in of))
            for key, of in groups.items()}
    got = listening(wide, slices)
    assert got.columns == ["userId", "level", "plays", "songs", "first_play", "last_play"]
    assert {*map(tuple, got.collect())} == want and got.count() == len(want)
