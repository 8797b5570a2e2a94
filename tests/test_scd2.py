"""User history: bucketed plans against plain windows, and the invariants of the result."""

import random
from datetime import datetime, timedelta

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_of
from tunemill.operators import dims, facts, scd2, segments
from tunemill.operators.segments import PART, in_segments, spanning
from tunemill.operators.staging import stg_listen_events
from tunemill.registry.ctes import CTES
from tunemill.schemas import STAGING

SCHEMA = STAGING["listen_events"]


def random_events(seed, rows, users, hot=None):
    rng = random.Random(seed)
    start = datetime(2024, 1, 1)
    out = []
    for _ in range(rows):
        user = hot if hot is not None and rng.random() < 0.4 else rng.randrange(users)
        # Few distinct times, so that equal times with several levels occur.
        ts = start + timedelta(minutes=20 * rng.randrange(400))
        out.append(dict(
            artist="a", song=f"s{rng.randrange(5)}", duration=1.0, ts=ts, auth="x",
            level=rng.choice(["free", "paid", "NA"]), city="c", state="s", userAgent="u",
            lon=1.0, lat=1.0, userId=user, lastName=f"L{user}", firstName=f"F{user % 3}",
            gender="M", registration=rng.choice([1, 2])))
    return out


def sql_rows(events, name):
    con = duckdb.connect()
    frame = pd.DataFrame(events)  # noqa: F841  (read by DuckDB)
    con.execute("CREATE TABLE stg_listen AS SELECT * FROM frame")
    order = ["user_states", "flagged", "numbered", "runs", "placed_runs", "dated", "history"]
    ctes = ", ".join(f"{n} AS ({CTES[n]})" for n in order)
    result = con.execute(f"WITH {ctes} SELECT * FROM {name}")
    columns = [d[0] for d in result.description]
    return sorted((tuple(r[columns.index(c)] for c in sorted(columns))
                   for r in result.fetchall()), key=repr)


def spark_rows(df):
    return sorted((tuple(r[c] for c in sorted(df.columns)) for r in df.collect()), key=repr)


@pytest.fixture
def many_segments(monkeypatch):
    """Partitions of about a hundred rows, so that users go over their edges."""
    monkeypatch.setattr(segments, "SEGMENT_ROWS", 120)


def check_history(df, events):
    assert spark_rows(scd2.scd2_level_history(df)) == sql_rows(events, "history")
    states = scd2.distinct_user_states(df)
    flagged = scd2.level_change_flag(states)
    assert spark_rows(flagged) == sql_rows(events, "flagged")
    numbered = scd2.level_run_number(flagged)
    assert spark_rows(numbered) == sql_rows(events, "numbered")
    dated = scd2.row_expiration(scd2.level_runs(numbered))
    assert spark_rows(scd2.current_row_flag(dated)) == sql_rows(events, "dated")


@pytest.mark.parametrize("seed", [1, 2])
def test_history_in_one_segment_equals_plain_sql(spark, seed):
    events = random_events(seed, 1500, 12, hot=5)
    check_history(spark.createDataFrame(events, SCHEMA), events)


@pytest.mark.parametrize("seed, users", [(3, 12), (4, 2), (5, 200)])
def test_history_over_many_segments_equals_plain_sql(spark, many_segments, seed, users):
    events = random_events(seed, 1500, users, hot=1)
    check_history(spark.createDataFrame(events, SCHEMA), events)


def test_a_user_who_flips_on_every_row_is_many_segments(spark, many_segments):
    """40 percent of the rows are one user's, whose level changes on each of them."""
    base, start = random_events(1, 1, 1)[0], datetime(2024, 1, 1)
    events = [{**base, "userId": 7 if i % 5 < 2 else 100 + i % 300, "registration": 1,
               "ts": start + timedelta(minutes=i)} for i in range(6000)]
    for e in events:
        e["firstName"] = e["lastName"] = f"u{e['userId']}"
    flip = [e for e in events if e["userId"] == 7]
    for k, e in enumerate(flip):
        e["level"] = ("free", "paid")[k % 2]
    df = spark.createDataFrame(events, SCHEMA)
    rows = scd2.known_users(df).select(*scd2.USER, "registration", "level", F.col("ts").alias("date"))
    placed = in_segments(rows, scd2.USER, "date")
    sizes = [r["count"] for r in placed.rows.where("userId = 7").groupBy(PART).count().collect()]
    assert len(sizes) >= 4 and max(sizes) < 0.4 * 2400
    assert spanning(placed, scd2.USER).select(PART, "userId").distinct().count() <= 2 * placed.parts
    history = scd2.scd2_level_history(df)
    assert spark_rows(history) == sql_rows(events, "history")


def test_run_starts_keep_little(spark):
    """A user who never changes level leaves one row per segment."""
    start = datetime(2024, 1, 1)
    base = random_events(1, 1, 1)[0]
    events = [{**base, "userId": 7, "level": "free", "registration": 1,
               "ts": start + timedelta(seconds=i)} for i in range(7200)]
    df = spark.createDataFrame(events, SCHEMA)
    placed = in_segments(scd2.distinct_user_states(df), scd2.USER, "date")
    assert scd2.run_starts(placed.rows).count() == placed.parts
    assert scd2.scd2_level_history(df).count() == 1


def test_history_of_nothing(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert scd2.scd2_level_history(empty).collect() == []


def test_first_level_na_opens_run_zero(spark):
    base = random_events(1, 1, 1)[0]
    day = datetime(2024, 1, 1)
    events = [{**base, "userId": 3, "level": lv, "registration": 1, "ts": day + timedelta(days=i)}
              for i, lv in enumerate(["NA", "free", "free", "paid"])]
    rows = scd2.scd2_level_history(spark.createDataFrame(events, SCHEMA)) \
        .orderBy("rowActivationDate").collect()
    assert [r.level for r in rows] == ["NA", "free", "paid"]
    assert [r.currentRow for r in rows] == [0, 0, 1]
    assert rows[0].rowExpirationDate == rows[1].rowActivationDate
    assert str(rows[2].rowExpirationDate) == "9999-12-31"


def test_invariants(given):
    history = scd2.scd2_level_history(stg_listen_events(given.listen_raw()))
    rows = history.orderBy("userId", "rowActivationDate", "rowExpirationDate").collect()
    by_user = {}
    for r in rows:
        by_user.setdefault(r.userId, []).append(r)
    for user, runs in by_user.items():
        assert user != 0
        assert sum(r.currentRow for r in runs) == 1
        for a, b in zip(runs, runs[1:]):
            assert a.rowExpirationDate == b.rowActivationDate
            assert a.level != b.level


def test_one_exchange_of_rows_after_they_are_placed(given, many_segments):
    events = stg_listen_events(given.listen_raw())
    plan = plan_of(scd2.scd2_level_history(events))
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert windows and all("_part" in line for line in windows)  # by segment, or over summaries in their order
    assert "rangepartitioning" not in plan  # the rows were placed before, and the runs keep their segments


def test_special_ids(spark):
    events = spark.createDataFrame(random_events(4, 300, 3), SCHEMA)
    both = dims.dim_users(events)
    assert both.where("userId = 1 AND rowExpirationDate = '9999-12-31'").count() > 1
    assert scd2.special_user_rows(events, (0,)).where("userId <> 0").count() == 0


def test_interval_join_skips_empty_intervals(spark):
    day = datetime(2024, 1, 2)
    base = random_events(1, 1, 1)[0]
    events = spark.createDataFrame(
        [{**base, "userId": 3, "level": lv, "registration": 1, "ts": ts} for lv, ts in
         [("free", day), ("paid", day + timedelta(hours=1)), ("free", day + timedelta(hours=2)),
          ("paid", day + timedelta(days=1))]], SCHEMA)
    users = dims.dim_users(events)
    assert users.where("rowActivationDate = rowExpirationDate").count() == 2
    joined = facts.join_user_scd2(facts.with_join_keys(events), users)
    levels = joined.join(users.select("userKey", F.col("level").alias("was")), "userKey")
    # Two rows of that day share a key, so only the count by day is exact.
    assert joined.count() == 4
    assert joined.where("userKey IS NULL").count() == 0
    assert levels.where("to_date(ts) = DATE'2024-01-03'").select("was").distinct().first()[0] == "paid"


def test_interval_join_meets_the_rows_of_one_month(spark):
    """A user of 1,000 rows: comparisons grow with the plays, not with the history."""
    start = datetime(2020, 1, 1)
    users = spark.range(1000).selectExpr(
        "concat('k', id) AS userKey", "7L AS userId", "date_add(DATE'2020-01-01', cast(id AS int)) AS rowActivationDate",
        "CASE WHEN id = 999 THEN DATE'9999-12-31' ELSE date_add(DATE'2020-01-01', cast(id + 1 AS int)) END AS rowExpirationDate")
    plays = spark.createDataFrame([(7 if i % 10 else 8, start + timedelta(hours=3 * i)) for i in range(9000)] + [(7, None)],
                                  "userId long, ts timestamp").withColumn("_day", F.to_date("ts"))
    pieces = facts.history_by_month(users, plays)
    met = plays.join(pieces, (F.col("userId") == F.col("_userId"))
                     & (facts.month_number(F.col("_day")) == F.col("_rowMonth"))).count()
    assert met <= 31 * 9000
    assert pieces.groupBy("userKey").count().agg(F.max("count")).first()[0] <= 12  # the open end stops at the last play
    got = {(r.userId, r.ts): r.userKey for r in facts.join_user_scd2(plays, users).collect()}
    assert len(got) == 9001
    for (user, ts), key in got.items():
        assert key == (None if user == 8 or ts is None else f"k{min(999, (ts - start).days)}")


def test_a_play_in_a_far_year_costs_its_own_user_only(spark):
    users = spark.createDataFrame([("a", 1), ("b", 2)], "userKey string, userId long").selectExpr(
        "*", "DATE'2024-01-01' AS rowActivationDate", "DATE'9999-12-31' AS rowExpirationDate")
    plays = spark.createDataFrame([(1, "2024-01-05"), (2, "2024-02-05"), (2, "9000-01-01")], "userId long, d string").selectExpr(
        "userId", "to_date(d) AS _day")
    sizes = {r.userKey: r["count"] for r in facts.history_by_month(users, plays).groupBy("userKey").count().collect()}
    assert sizes["a"] == 1 and sizes["b"] > 80_000
    assert facts.join_user_scd2(plays, users).where("userKey IS NULL").count() == 0
