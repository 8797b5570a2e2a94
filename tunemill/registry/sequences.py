"""Queries of sequences, ranking and the recommender."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunemill.operators import aggregates, ranking, recommend
from tunemill.operators import sequences as seq
from tunemill.plans.recommendation import recommendation_job
from tunemill.registry.base import query
from tunemill.registry.star import staged
from tunemill.session import written


def text(name: str):
    return F.array_join(F.col(name).cast("array<string>"), ",")


def numbered(g) -> tuple[DataFrame, DataFrame]:
    """Plays and vocabulary, stored."""
    events = written(staged(g).select("userId", "ts", "song"), "plays")
    return events, written(seq.song_vocabulary(events), "vocabulary")


def coded(g) -> DataFrame:
    return written(seq.coded_sequences(*numbered(g)), "coded")


def split(g) -> DataFrame:
    return seq.split_by_length(coded(g))


def parts_of(sequences: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Training and test pairs of stored sequences."""
    rows = written(seq.split_by_length(sequences), "split")
    kept = seq.sample_fraction(rows.where(~F.col("is_test")).drop("is_test"))
    return seq.training_pairs(kept), seq.training_pairs(rows.where("is_test"))


def parts(g) -> tuple[DataFrame, DataFrame]:
    return parts_of(coded(g))


@query("sort_events", "SELECT * FROM stg_listen ORDER BY userId, ts")
def _(g):
    return ranking.sort_events(staged(g))


@query("sort_within_user", "SELECT * FROM stg_listen ORDER BY userId, ts")
def _(g):
    return ranking.sort_within_user(staged(g))


@query("preview", "SELECT * FROM stg_listen ORDER BY userId, ts, song LIMIT 5")
def _(g):
    return ranking.preview(staged(g), "userId", "ts", "song")


@query("global_index", """
SELECT event_id, row_number() OVER (ORDER BY userId, ts, event_id) - 1 AS idx FROM raw_events""")
def _(g):
    rows = g.raw_events().select("event_id", "userId", "ts")
    return ranking.with_global_index(rows, "userId", "ts", "event_id").select("event_id", "idx")


@query("user_count", "SELECT count(DISTINCT userId) AS users FROM stg_listen")
def _(g):
    return aggregates.user_count(staged(g))


@query("play_positions", """
SELECT userId, row_number() OVER (PARTITION BY userId ORDER BY ts, song) - 1 AS pos, song
FROM stg_listen""")
def _(g):
    return seq.play_positions(staged(g))


@query("user_sequences", """
SELECT userId, CAST(0 AS BIGINT) AS part, string_agg(song, ',' ORDER BY ts, song) AS songs
FROM stg_listen GROUP BY userId""")
def _(g):
    """One whole history a user; the long rows alone are :func:`play_positions`."""
    whole = seq.whole_sequences(seq.user_sequences(staged(g)))
    return whole.select("userId", F.lit(0).cast("bigint").alias("part"), text("items").alias("songs"))


@query("sequence_lengths", "SELECT userId, count(*) AS n FROM stg_listen GROUP BY userId")
def _(g):
    return seq.sequence_lengths(staged(g))


@query("length_histogram", """
SELECT n, count(*) AS users FROM (SELECT userId, count(*) AS n FROM stg_listen GROUP BY userId)
GROUP BY n ORDER BY users DESC, n""")
def _(g):
    return seq.length_histogram(seq.sequence_lengths(staged(g)))


@query("sequence_length_filter", """
SELECT userId, count(*) AS n FROM stg_listen GROUP BY userId HAVING count(*) BETWEEN 4 AND 20""")
def _(g):
    return seq.sequence_length_filter(seq.sequence_lengths(staged(g)))


@query("bounded_sequences", """
SELECT userId, n, array_to_string(names, ',') AS songs FROM coded""")
def _(g):
    return seq.bounded_sequences(staged(g)).select("userId", "n", text("items").alias("songs"))


@query("song_vocabulary", "SELECT * FROM vocab")
def _(g):
    return seq.song_vocabulary(staged(g))


@query("encode_sequences", """
SELECT userId, place - 1 AS pos, label FROM ordered LEFT JOIN vocab USING (song)""")
def _(g):
    """All histories in long form, not only the bounded ones."""
    events, vocab = numbered(g)
    return seq.encode_sequences(seq.user_sequences(events), vocab)


@query("coded_sequences", "SELECT userId, n, array_to_string(items, ',') AS labels FROM coded")
def _(g):
    return coded(g).select("userId", "n", text("items").alias("labels"))


@query("decode_label", """
SELECT userId, ts, label, song FROM stg_listen JOIN vocab USING (song)""")
def _(g):
    plays = staged(g).select("userId", "ts", "song")
    vocab = seq.song_vocabulary(plays)
    labelled = seq.encode_plays(plays, vocab).select("userId", "ts", "label")
    return seq.decode_label(labelled, vocab)


@query("last_n", """
SELECT userId, string_agg(song, ',' ORDER BY ts, song) AS songs FROM (
  SELECT *, row_number() OVER (PARTITION BY userId ORDER BY ts DESC, song DESC) AS rn
  FROM stg_listen) WHERE rn <= 19 GROUP BY userId""")
def _(g):
    return seq.last_plays(staged(g), 19).select("userId", text("items").alias("songs"))


@query("training_pairs", """
SELECT userId, pos, array_to_string(list_slice(items, 1, pos), ',') AS prefix,
  items[pos + 1] AS target
FROM (SELECT userId, items, CAST(unnest(range(3, n)) AS INT) AS pos FROM coded)""")
def _(g):
    return seq.training_pairs(coded(g)).withColumn("prefix", text("prefix"))


@query("holdout_pairs", """
SELECT userId, array_to_string(list_slice(items, 1, n - 1), ',') AS prefix, items[n] AS target
FROM coded""")
def _(g):
    return seq.holdout_pairs(coded(g)).withColumn("prefix", text("prefix"))


@query("pad_sequence", """
SELECT userId, pos, array_to_string(list_concat(list_slice(items, 1, pos),
  list_resize([]::BIGINT[], 19 - pos, 0)), ',') AS prefix, items[pos + 1] AS target
FROM (SELECT userId, items, CAST(unnest(range(3, n)) AS INT) AS pos FROM coded)""")
def _(g):
    return seq.padded(seq.training_pairs(coded(g))).withColumn("prefix", text("prefix"))


@query("split_by_length", "SELECT userId, n, is_test FROM split")
def _(g):
    return seq.split_by_length(coded(g)).select("userId", "n", "is_test")


@query("sample_fraction", "SELECT userId, n FROM kept")
def _(g):
    rows = split(g).where(~F.col("is_test")).drop("is_test")
    return seq.sample_fraction(rows).select("userId", "n")


@query("dataset_sizes", """
SELECT 'train' AS part, count(*) AS pairs FROM train_pairs
UNION ALL SELECT 'test', count(*) FROM test_pairs""")
def _(g):
    return seq.dataset_sizes(*parts(g))


@query("transition_counts", """
SELECT k, array_to_string(context, ',') AS context, target, n FROM transitions""")
def _(g):
    return recommend.transition_counts(parts(g)[0]).withColumn("context", text("context"))


@query("next_track_model", """
SELECT k, array_to_string(context, ',') AS context, predicted, support FROM model""")
def _(g):
    return recommend.next_track_model(parts(g)[0]).withColumn("context", text("context"))


@query("top1_next", """
SELECT userId, song, plays FROM (
  SELECT userId, song, count(*) AS plays, row_number() OVER (PARTITION BY userId
    ORDER BY count(*) DESC, label) AS rn
  FROM stg_listen JOIN vocab USING (song) GROUP BY userId, song, label) WHERE rn = 1""")
def _(g):
    """Favourite song of each user, the first in byte order on a tie."""
    plays = staged(g)
    vocab = seq.song_vocabulary(plays)
    scores = (seq.encode_plays(plays.select("userId", "song"), vocab)
              .groupBy("userId", "label").agg(F.count(F.lit(1)).alias("plays")))
    best = recommend.top1_next(scores, ("userId",), "label", "plays").drop("support")
    named = seq.decode_label(best, vocab, "predicted")
    return named.join(scores, (named["userId"] == scores["userId"])
                      & (named["predicted"] == scores["label"])).select(
        named["userId"], "song", "plays")


@query("predict", "SELECT userId, pos, target, predicted FROM predictions")
def _(g):
    train, test = parts(g)
    model = written(recommend.next_track_model(train), "model")
    return recommend.predict(test, model, "prefix")


@query("evaluate_model", """
SELECT round(avg(CASE WHEN predicted = target THEN CAST(1 AS DOUBLE) ELSE 0 END), 9) AS accuracy,
  count(*) AS pairs FROM predictions""")
def _(g):
    train, test = parts(g)
    model = written(recommend.next_track_model(train), "model")
    return recommend.evaluate_model(model, test).withColumn("accuracy", F.round("accuracy", 9))


@query("accuracy", """
SELECT round(avg(CASE WHEN level = 'paid' THEN CAST(1 AS DOUBLE) ELSE 0 END), 9) AS accuracy,
  count(*) AS pairs FROM stg_listen""")
def _(g):
    """Guessing that every play is by a paying user."""
    guesses = staged(g).select(F.lit("paid").alias("predicted"), F.col("level").alias("target"))
    return recommend.accuracy(guesses).withColumn("accuracy", F.round("accuracy", 9))


@query("best_candidate", """
SELECT candidate, round(accuracy, 9) AS accuracy, pairs FROM (
  SELECT 'orders_1' AS candidate, avg(CASE WHEN predicted1 = target THEN CAST(1 AS DOUBLE) ELSE 0 END)
    AS accuracy, count(*) AS pairs FROM predictions
  UNION ALL SELECT 'orders_21', avg(CASE WHEN predicted2 = target THEN CAST(1 AS DOUBLE) ELSE 0 END),
    count(*) FROM predictions
  UNION ALL SELECT 'orders_321', avg(CASE WHEN predicted = target THEN CAST(1 AS DOUBLE) ELSE 0 END),
    count(*) FROM predictions)
ORDER BY accuracy DESC, candidate LIMIT 1""")
def _(g):
    train, test = parts(g)
    scores = recommend.candidate_scores(
        train, test, {"orders_1": (1,), "orders_21": (2, 1), "orders_321": (3, 2, 1)})
    return recommend.best_candidate(scores).withColumn("accuracy", F.round("accuracy", 9))


@query("cold_start", "SELECT userId, label FROM drawn")
def _(g):
    events = staged(g)
    users = events.select("userId").distinct()
    return recommend.cold_start(users, seq.song_vocabulary(events))


@query("append_history", """
SELECT userId, place - 1 AS pos, song AS item FROM ordered
UNION ALL SELECT userId, (SELECT count(*) FROM stg_listen l WHERE l.userId = drawn.userId), song
FROM drawn JOIN vocab USING (label)""")
def _(g):
    """Every user plays a drawn song an hour after the last event."""
    events, vocab = numbered(g)
    after = events.agg(F.max("ts") + F.expr("INTERVAL 1 HOUR")).scalar()
    drawn = recommend.cold_start(events.select("userId").distinct(), vocab)
    new = seq.decode_label(drawn, vocab).select("userId", after.alias("ts"), "song")
    return seq.append_history(written(seq.user_sequences(events), "histories"), new)


@query("recommend_next", """
SELECT userId, n_recent, cold, song FROM chosen JOIN vocab USING (label)""")
def _(g):
    events, vocab = numbered(g)
    train, _test = parts_of(written(seq.coded_sequences(events, vocab), "coded"))
    model = written(recommend.next_track_model(train), "model")
    return recommend.recommend_next(events, vocab, model)


@query("recommendation_job", """
SELECT userId, n_recent, cold, song, (SELECT count(*) FROM train_pairs) AS train,
  (SELECT count(*) FROM test_pairs) AS test FROM chosen JOIN vocab USING (label)""")
def _(g):
    job = recommendation_job(staged(g))
    size = {name: job.sizes.where(F.col("part") == name).select("pairs").scalar()
            for name in ("train", "test")}
    return job.next_songs.select("*", size["train"].alias("train"), size["test"].alias("test"))
