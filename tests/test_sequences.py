"""Sequences, numbering, split and model against brute force on small and skewed data."""

import hashlib
import random
from collections import Counter, defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_of
from tunemill.functions.arrays import last_n, pad_sequence
from tunemill.operators import ranking, recommend
from tunemill.operators import sequences as seq
from tunemill.plans.recommendation import recommendation_job

PLAYS = "userId bigint, ts timestamp, song string"


def random_plays(seed, rows=3000, users=120, songs=25, hot_share=0.35):
    """User 0 owns a third of the plays and song s0 a third of the titles."""
    rng = random.Random(seed)
    start = datetime(2024, 1, 1)
    out = []
    for _ in range(rows):
        user = 0 if rng.random() < hot_share else rng.randrange(1, users)
        song = 0 if rng.random() < hot_share else rng.randrange(songs)
        out.append((user, start + timedelta(seconds=rng.randrange(86400 * 5)), f"s{song}"))
    return out


def by_user(plays):
    out = defaultdict(list)
    for user, _ts, song in sorted(plays):
        out[user].append(song)
    return out


@pytest.fixture(scope="module")
def plays():
    return random_plays(7)


@pytest.fixture(scope="module")
def df(spark, plays):
    return spark.createDataFrame(plays, PLAYS).repartition(8)


def test_positions(df, plays):
    got = {(r.userId, r.pos): r.song for r in seq.play_positions(df).collect()}
    want = {(u, i): s for u, songs in by_user(plays).items() for i, s in enumerate(songs)}
    assert got == want


def test_positions_keep_plays_without_a_time(spark):
    rows = [(1, None, "a"), (1, datetime(2024, 1, 1), "b"), (1, datetime(1969, 1, 1), "c")]
    got = seq.play_positions(spark.createDataFrame(rows, PLAYS)).orderBy("pos").collect()
    assert [r.song for r in got] == ["a", "c", "b"]


def test_histories_are_long_rows_of_any_length(spark):
    """One user with 40 percent of all plays, all of them in one hour, is dealt over several tasks."""
    n = 30_000
    rows = spark.range(n).selectExpr("CASE WHEN id % 5 < 2 THEN 1L ELSE 2 + id % 500 END AS userId",
                                     "timestamp_millis(id * 100) AS ts", "concat('s', id) AS song")
    conf = {"spark.sql.adaptive.coalescePartitions.enabled": "false"}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        long = seq.user_sequences(rows)
        placed = ranking.with_global_index(rows, "userId", "ts", "song").select(
            "userId", F.spark_partition_id().alias("p"))
        assert placed.where("userId = 1").select("p").distinct().count() > 1
        got = long.where("userId = 1").orderBy("pos").collect()
        text = plan_of(long)
    finally:
        for k in conf:
            spark.conf.unset(k)
    assert [r.pos for r in got] == list(range(n // 5 * 2))
    assert [r["item"] for r in got] == [f"s{i}" for i in range(n) if i % 5 < 2]
    assert "collect_list" not in text and "Window [row_number" not in text
    assert long.count() == n


def test_whole_sequences_are_one_row_a_user(spark, df, plays):
    """Also for a history of more pieces than ten, the last of them with one play; and one without an id."""
    rows = seq.whole_sequences(seq.user_sequences(df)).collect()
    assert {r.userId: r["items"] for r in rows} == by_user(plays) and len(rows) == len(by_user(plays))
    n = 11 * seq.PIECE + 1
    long = spark.range(n).selectExpr("1L AS userId", "timestamp_millis(id) AS ts", "concat('s', id) AS song")
    few = spark.createDataFrame([(None, datetime(2024, 1, 2), "b"), (None, datetime(2024, 1, 1), "a")], PLAYS)
    got = {r.userId: r["items"] for r in seq.whole_sequences(seq.user_sequences(long.unionByName(few))).collect()}
    assert got == {1: [f"s{i}" for i in range(n)], None: ["a", "b"]}


def test_the_query_of_histories_has_one_row_a_user(spark, given):
    from tunemill.operators.staging import stg_listen_events
    from tunemill.registry import QUERIES
    rows = QUERIES["user_sequences"](spark, given.sf_dir)
    plays = stg_listen_events(given.listen_raw()).orderBy("ts", "song").select("userId", "song").collect()
    want = defaultdict(list)
    for r in plays:
        want[r.userId].append(r.song)
    assert rows.columns == ["userId", "part", "songs"]
    assert sorted(map(tuple, rows.collect())) == sorted((u, 0, ",".join(s)) for u, s in want.items())


@pytest.mark.parametrize("shortest,longest", [(4, 20), (1, 1), (18, 19)])
def test_bounded(df, plays, shortest, longest):
    rows = seq.bounded_sequences(df, shortest=shortest, longest=longest).collect()
    want = {u: s for u, s in by_user(plays).items() if shortest <= len(s) <= longest}
    assert {r.userId: r["items"] for r in rows} == want
    assert all(r.n == len(r["items"]) for r in rows)


def test_limits_apply_before_the_shuffle(df):
    for plan in (plan_of(seq.bounded_sequences(df)), plan_of(seq.last_plays(df, 19))):
        lines = [line for line in plan.splitlines()
                 if "WindowGroupLimit" in line or "Exchange hash" in line]
        assert "Final" in lines[0] and "Exchange" in lines[1] and "Partial" in lines[2]


def test_last_plays(df, plays):
    got = {r.userId: r["items"] for r in seq.last_plays(df, 19).collect()}
    assert got == {u: s[-19:] for u, s in by_user(plays).items()}


def test_global_index(spark):
    rng = random.Random(3)
    values = [(0 if rng.random() < 0.4 else rng.randrange(10), i) for i in range(4000)]
    rng.shuffle(values)
    df = spark.createDataFrame(values, "g int, v int").repartition(8)
    got = ranking.with_global_index(df, "g", "v").collect()
    assert {r.idx: (r.g, r.v) for r in got} == dict(enumerate(sorted(values)))


def test_global_index_of_nothing(spark):
    assert ranking.with_global_index(spark.createDataFrame([], "v int"), "v").count() == 0


def test_vocabulary_and_encoding(df, plays):
    vocab = seq.song_vocabulary(df)
    want = {s: i for i, s in enumerate(sorted({p[2] for p in plays}))}
    assert {r.song: r.label for r in vocab.collect()} == want
    songs = by_user(plays)
    long = {(r.userId, r.pos): r.label for r in seq.encode_sequences(seq.user_sequences(df), vocab).collect()}
    assert long == {(u, i): want[s] for u, names in songs.items() for i, s in enumerate(names)}
    coded = seq.coded_sequences(df, vocab).collect()
    assert {r.userId: (r["items"], r.n) for r in coded} == {
        u: ([want[s] for s in names], len(names)) for u, names in songs.items() if 4 <= len(names) <= 20}


def test_labels_beyond_32_bits(spark):
    vocab = spark.createDataFrame([(2**40 + i, f"s{i}") for i in range(6)], "label long, song string")
    plays = spark.createDataFrame([(1, datetime(2024, 1, 1 + i), f"s{i}") for i in range(6)], PLAYS)
    coded = seq.coded_sequences(plays, vocab)
    assert coded.first()["items"] == [2**40 + i for i in range(6)]
    model = recommend.next_track_model(seq.training_pairs(coded))
    assert recommend.recommend_next(plays, vocab, model).first().song in {f"s{i}" for i in range(6)}


def md5_of(user, seed):
    return hashlib.md5(f"{user}-{seed}".encode()).hexdigest()


def test_split_is_exact_and_repeatable(df):
    coded = seq.bounded_sequences(df)
    first = {r.userId: (r.n, r.is_test) for r in seq.split_by_length(coded, seed=5).collect()}
    again = {r.userId: (r.n, r.is_test)
             for r in seq.split_by_length(coded.repartition(3), seed=5).collect()}
    assert first == again
    strata = defaultdict(list)
    for user, (n, is_test) in first.items():
        strata[n].append((md5_of(user, 5), user, is_test))
    for users in strata.values():
        users.sort()
        assert [u[2] for u in users] == [i < round(0.2 * len(users)) for i in range(len(users))]


def test_sample_takes_its_share(df):
    coded = seq.bounded_sequences(df)
    total = coded.count()
    taken = {r.userId for r in seq.sample_fraction(coded, 0.5, seed=9).collect()}
    users = sorted((md5_of(r.userId, 9), r.userId) for r in coded.collect())
    assert taken == {u for _h, u in users[:int(total * 0.5)]}


def test_pairs(spark):
    rows = [(1, [5, 6, 7]), (2, [1, 2, 3, 4]), (3, list(range(20))), (4, [9])]
    sequences = spark.createDataFrame(rows, "userId bigint, items array<int>")
    pairs = [(r.userId, r.prefix, r.target) for r in seq.training_pairs(sequences).collect()]
    want = [(u, items[:i], items[i]) for u, items in rows for i in range(3, len(items))]
    assert sorted(pairs) == sorted(want)
    held = sorted((r.userId, r.prefix, r.target) for r in seq.holdout_pairs(sequences).collect())
    assert held == [(u, items[:-1], items[-1]) for u, items in rows]


def test_padding(spark):
    df = spark.createDataFrame([([1, 2],), (list(range(19)),), ([],)], "a array<int>")
    plain = [r[0] for r in df.select(pad_sequence(F.col("a"))).collect()]
    assert plain == [[1, 2] + [0] * 17, list(range(19)), [0] * 19]
    shifted = df.select(pad_sequence(F.col("a"), 3, label_offset=1)).first()[0]
    assert shifted == [2, 3, 0]
    assert [r[0] for r in df.select(last_n(F.col("a"), 2)).collect()] == [[1, 2], [17, 18], []]


def brute_model(pairs, orders=(3, 2, 1, 0)):
    counts = defaultdict(Counter)
    for prefix, target in pairs:
        for k in orders:
            if len(prefix) >= k:
                counts[(k, tuple(prefix[len(prefix) - k:]))][target] += 1
    return {key: min(c.items(), key=lambda x: (-x[1], x[0]))[0] for key, c in counts.items()}


def test_model_and_prediction(spark):
    rng = random.Random(11)
    pairs = [([0 if rng.random() < .4 else rng.randrange(4) for _ in range(rng.randrange(0, 6))],
              rng.randrange(4)) for _ in range(800)]
    df = spark.createDataFrame(pairs, "prefix array<int>, target int")
    want = brute_model(pairs)
    model = recommend.next_track_model(df)
    assert {(r.k, tuple(r.context)): r.predicted for r in model.collect()} == want
    asked = [[rng.randrange(6) for _ in range(rng.randrange(0, 6))] for _ in range(200)]
    rows = spark.createDataFrame(list(enumerate(asked)), "id int, prefix array<int>")
    found = recommend.predict(rows, model, "prefix")
    assert found.columns == ["id", "predicted"]
    best = {}
    for r in found.collect():
        prefix = asked[r.id]
        known = (want[(k, tuple(prefix[len(prefix) - k:]))] for k in (3, 2, 1, 0)
                 if len(prefix) >= k and (k, tuple(prefix[len(prefix) - k:])) in want)
        best[r.id] = next(known)
        assert r.predicted == best[r.id]
    assert len(best) == 200
    joins = [line for line in plan_of(recommend.predict(rows, model, "prefix")).splitlines() if "Join" in line]
    assert len(joins) == 1


def test_candidates_are_scored_by_one_lookup(spark):
    rng = random.Random(12)
    pairs = [(i, [rng.randrange(4) for _ in range(rng.randrange(0, 6))], rng.randrange(4)) for i in range(600)]
    df = spark.createDataFrame(pairs, "id int, prefix array<int>, target int")
    train, test = df.where("id % 3 > 0"), df.where("id % 3 = 0")
    chosen = {"one": (1,), "two_one": (2, 1), "three": (3, 2, 1)}
    scores = recommend.candidate_scores(train.drop("id"), test, chosen)
    got = {r.candidate: (r.accuracy, r.pairs) for r in scores.collect()}
    want = brute_model([p[1:] for p in pairs if p[0] % 3])
    for name, ks in chosen.items():
        hits = [next(want[(k, tuple(x[len(x) - k:]))] for k in (*ks, 0)
                     if len(x) >= k and (k, tuple(x[len(x) - k:])) in want) == t
                for i, x, t in pairs if i % 3 == 0]
        assert got[name] == (pytest.approx(sum(hits) / len(hits)), len(hits))


def test_best_candidate_takes_the_first_on_a_tie(spark):
    scores = spark.createDataFrame([("b", .5), ("a", .5), ("c", .1)],
                                   "candidate string, accuracy double")
    assert recommend.best_candidate(scores).first().candidate == "a"


def test_job_for_every_user(df, plays):
    job = recommendation_job(df.unionByName(df))
    rows = {r.userId: r for r in job.next_songs.collect()}
    unique = {(u, t, s) for u, t, s in plays}
    songs = by_user(unique)
    assert set(rows) == set(songs)
    titles = {p[2] for p in plays}
    for user, r in rows.items():
        assert r.n_recent == min(len(songs[user]), 19)
        assert r.cold == (len(songs[user]) < 3) and r.song in titles
    parts = job.sequences.groupBy("userId").agg(F.count_distinct("is_test").alias("c"))
    assert parts.where("c > 1").count() == 0
    assert {r.part: r.pairs for r in job.sizes.collect()}["train"] == job.train.count()


def test_append_history(df, plays, spark):
    new = [(0, datetime(2030, 1, 2), "late"), (0, datetime(2030, 1, 1), "new"), (999, datetime(2030, 1, 1), "first")]
    longer = seq.append_history(seq.user_sequences(df), spark.createDataFrame(new, PLAYS))
    got = {(r.userId, r.pos): r["item"] for r in longer.collect()}
    songs = by_user(plays)
    songs[0] = songs[0] + ["new", "late"]
    songs[999] = ["first"]
    assert got == {(u, i): s for u, names in songs.items() for i, s in enumerate(names)}


def test_arrays_are_not_sorted_for_split_and_sample(df):
    coded = seq.bounded_sequences(df)
    for frame in (seq.split_by_length(coded), seq.sample_fraction(coded)):
        ranges = [line for line in plan_of(frame).splitlines() if "rangepartitioning" in line]
        assert all("items" not in line for line in ranges)
    assert "items" not in seq._drawn(coded, 1, "n").columns


def test_sort_within_user_spreads_a_busy_user(spark):
    # Big enough that the adaptive planner keeps more than one partition.
    df = (spark.range(400_000).select(
        F.lit(1).cast("bigint").alias("userId"),
        F.timestamp_seconds(F.col("id") * 7919 % 400_000).alias("ts"),
        F.md5(F.col("id").cast("string")).alias("song")))
    placed = ranking.sort_within_user(df).select(
        "userId", "ts", F.spark_partition_id().alias("p"),
        F.monotonically_increasing_id().alias("at"))
    assert placed.select("p").distinct().count() > 1
    assert [r.ts for r in placed.orderBy("at").limit(5).collect()] == \
        [r.ts for r in placed.orderBy("ts").limit(5).collect()]


def test_unknown_songs_keep_their_places(spark):
    rows = [(1, i, x) for i, x in enumerate(["a", "b", "x", "c", "a"])] + [(2, 0, "x")]
    df = spark.createDataFrame(rows, "userId bigint, pos bigint, item string")
    vocab = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c")], "label bigint, song string")
    got = {(r.userId, r.pos): r.label for r in seq.encode_sequences(df, vocab).collect()}
    assert got == {(1, 0): 0, (1, 1): 1, (1, 2): None, (1, 3): 2, (1, 4): 0, (2, 0): None}
    arrays = {r.userId: (r["items"], r.n) for r in seq.as_arrays(seq.encode_sequences(df, vocab), "label").collect()}
    assert arrays == {1: ([0, 1, None, 2, 0], 5), 2: ([None], 1)}
