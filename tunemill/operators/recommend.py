"""Next-track model: counts of what follows the last k items, with back-off."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunemill.functions.arrays import last_n
from tunemill.functions.keys import spread_number
from tunemill.operators.sequences import (
    FIRST_TARGET, MAX_LENGTH, as_arrays, decode_label, encode_sequences, last_plays)
from tunemill.session import written

ORDERS = (3, 2, 1)
# Order 0 has the empty context: the most frequent next item of all.
ANY_CONTEXT = 0


def transition_counts(pairs: DataFrame, orders: Iterable[int] = ORDERS) -> DataFrame:
    """How often each item follows each context: ``k, context, target, n``.

    All orders are counted in one pass. Hot contexts shrink in the map-side
    combine, and the final groups are spread by target.
    """
    ks = [*orders, ANY_CONTEXT]
    contexts = F.array(*[
        F.when(F.size("prefix") >= k,
               F.struct(F.lit(k).alias("k"),
                        (last_n(F.col("prefix"), k) if k else F.slice("prefix", 1, 0))
                        .alias("context")))
        for k in ks])
    rows = pairs.select(F.explode(F.array_compact(contexts)).alias("c"), "target")
    return (rows.groupBy("c.k", "c.context", "target")
            .agg(F.count(F.lit(1)).alias("n")))


def top1_next(scores: DataFrame, keys: Iterable[str], item: str, score: str) -> DataFrame:
    """The item of the highest score per key, the smallest item on a tie."""
    best = F.max_by(item, F.struct(F.col(score), (-F.col(item)).alias("_tie")))
    return scores.groupBy(*keys).agg(best.alias("predicted"), F.sum(score).alias("support"))


def next_track_model(pairs: DataFrame, orders: Iterable[int] = ORDERS) -> DataFrame:
    """Most likely next item per context: ``k, context, predicted, support``."""
    return top1_next(transition_counts(pairs, orders), ("k", "context"), "target", "n")


def looked_up(rows: DataFrame, model: DataFrame, history: str, orders: Iterable[int] = ORDERS) -> DataFrame:
    """The known contexts at the end of each history: the columns of ``rows`` but ``history``, and ``k, predicted``.

    All orders are looked up by one join of narrow rows. A row of which no context is known, or which has
    none, is there once or more with a NULL ``predicted``.
    """
    contexts = F.array_compact(F.array(*[
        F.when(F.size(history) >= k, F.struct(F.lit(k).alias("k"), last_n(F.col(history), k).alias("context")))
        for k in orders]))
    others = [c for c in rows.columns if c != history]
    asked = rows.select(*others, F.explode_outer(contexts).alias("_c")).select(*others, "_c.k", "_c.context")
    known = model.where(F.col("k").isin(*orders)).select("k", "context", "predicted")
    return asked.join(known, ["k", "context"], "left").select(*others, "k", "predicted")


def _longest(orders: Iterable[int]) -> Column:
    """What the longest known context of a row predicts, of these orders."""
    usable = F.col("predicted").isNotNull() & F.col("k").isin(*orders)
    return F.max_by("predicted", F.when(usable, F.col("k")))


def _most_frequent(model: DataFrame) -> Column:
    return model.where(F.col("k") == ANY_CONTEXT).select("predicted").scalar()


def predict(rows: DataFrame, model: DataFrame, history: str,
            orders: Iterable[int] = ORDERS) -> DataFrame:
    """``predicted`` in place of ``history``: by the longest known context, else the most frequent item.

    The other columns must tell the rows apart.
    """
    others = [c for c in rows.columns if c != history]
    return (looked_up(rows, model, history, orders).groupBy(*others)
            .agg(F.coalesce(_longest(orders), _most_frequent(model)).alias("predicted")))


def accuracy(predictions: DataFrame) -> DataFrame:
    """Share of predictions equal to the target."""
    hit = F.coalesce(F.col("predicted") == F.col("target"), F.lit(False))
    return predictions.agg(F.avg(hit.cast("double")).alias("accuracy"),
                           F.count(F.lit(1)).alias("pairs"))


def evaluate_model(model: DataFrame, pairs: DataFrame,
                   orders: Iterable[int] = ORDERS) -> DataFrame:
    return accuracy(predict(pairs, model, "prefix", orders))


def candidate_scores(train: DataFrame, test: DataFrame,
                     candidates: dict[str, Iterable[int]]) -> DataFrame:
    """Accuracy of each candidate set of orders: ``candidate, accuracy, pairs``.

    One model holds the contexts of all orders, and one lookup finds those of every test pair; a
    candidate chooses among what was found.
    """
    orders = sorted({k for ks in candidates.values() for k in ks}, reverse=True)
    model = written(next_track_model(train, orders), "model")
    found = looked_up(test, model, "prefix", orders)
    others = [c for c in test.columns if c != "prefix"]
    chosen = found.groupBy(*others).agg(*[
        F.coalesce(_longest(tuple(ks)), _most_frequent(model)).alias(f"_by_{name}") for name, ks in candidates.items()])
    each = F.array(*[F.struct(F.lit(name).alias("candidate"), F.col(f"_by_{name}").alias("predicted"))
                     for name in candidates])
    hit = F.coalesce(F.col("predicted") == F.col("target"), F.lit(False))
    return (chosen.select("target", F.inline(each)).groupBy("candidate")
            .agg(F.avg(hit.cast("double")).alias("accuracy"), F.count(F.lit(1)).alias("pairs")))


def best_candidate(scores: DataFrame) -> DataFrame:
    """The most accurate candidate, the first by name on a tie."""
    return scores.orderBy(F.desc("accuracy"), "candidate").limit(1)


def cold_start(users: DataFrame, vocab: DataFrame, seed: int = 42) -> DataFrame:
    """Add ``label``: a song drawn from all songs by a repeatable hash of the user."""
    songs = vocab.agg(F.count(F.lit(1))).scalar()
    return users.withColumn("label", F.pmod(spread_number("userId", seed), songs))


def recommend_next(plays: DataFrame, vocab: DataFrame, model: DataFrame, seed: int = 42,
                   orders: Iterable[int] = ORDERS) -> DataFrame:
    """Next song for every user at once: ``userId, n_recent, cold, song``.

    Users with fewer than three plays get a drawn song, the others the model's choice for their last
    plays. Only those last plays are encoded and moved, and cold users are split off before the lookup.
    """
    recent = last_plays(plays, MAX_LENGTH - 1).select(
        "userId", F.posexplode("items").alias("pos", "item"))
    history = written(as_arrays(encode_sequences(recent, vocab), "label"), "recent")
    is_cold = F.col("n") < FIRST_TARGET
    drawn = cold_start(history.where(is_cold).select("userId", "n"), vocab, seed)
    scored = predict(history.where(~is_cold), model, "items", orders)
    chosen = scored.select("userId", "n", F.col("predicted").alias("label")).unionByName(drawn)
    return decode_label(chosen, vocab).select(
        "userId", F.col("n").alias("n_recent"), is_cold.alias("cold"), "song")
