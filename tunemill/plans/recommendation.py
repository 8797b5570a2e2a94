"""From staged plays to a model, its accuracy and a next song for every user."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunemill.operators import recommend, sequences
from tunemill.operators.staging import drop_duplicate_events
from tunemill.session import written


@dataclass
class Recommendation:
    vocab: DataFrame
    sequences: DataFrame
    train: DataFrame
    test: DataFrame
    sizes: DataFrame
    model: DataFrame
    accuracy: DataFrame
    next_songs: DataFrame


def recommendation_job(events: DataFrame, seed: int = 42, test: float = 0.2,
                       fraction: float = 0.95,
                       orders: Iterable[int] = recommend.ORDERS) -> Recommendation:
    """Deduplicate, number the songs, build and split the sequences, count, predict.

    Plays, vocabulary, sequences, split and model are used several times, so each is
    written once. Only the part that is not held out is sampled.
    """
    plays = written(drop_duplicate_events(events).select("userId", "ts", "song"), "plays")
    vocab = written(sequences.song_vocabulary(plays), "vocabulary")
    coded = written(sequences.coded_sequences(plays, vocab), "coded")
    split = written(sequences.split_by_length(coded, test, seed), "split")
    kept = sequences.sample_fraction(split.where(~F.col("is_test")).drop("is_test"),
                                     fraction, seed)
    train = sequences.training_pairs(kept)
    held_out = sequences.training_pairs(split.where("is_test"))
    model = written(recommend.next_track_model(train, orders), "model")
    return Recommendation(
        vocab=vocab, sequences=split, train=train, test=held_out,
        sizes=sequences.dataset_sizes(train, held_out), model=model,
        accuracy=recommend.evaluate_model(model, held_out, orders),
        next_songs=recommend.recommend_next(plays, vocab, model, seed, orders))
