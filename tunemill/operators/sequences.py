"""Listening sequences, labels and training pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tunemill.functions.arrays import pad_sequence, prefix
from tunemill.functions.keys import spread
from tunemill.operators.ranking import with_global_index

# Shortest and longest sequence that is trained on, and the first
# position that is predicted.
MIN_LENGTH, MAX_LENGTH = 4, 20
FIRST_TARGET = 3
# Plays of a user that are put in order together when whole histories become arrays.
PIECE = 10_000


def play_positions(plays: DataFrame, item: str = "song") -> DataFrame:
    """One row per play: ``userId``, 0-based ``pos`` in the user's time order, the item.

    All plays are numbered in one order by range partitions; a play's place is its number less that of
    the user's first play. So a user with a third of all plays is spread over as many tasks as they
    take, also where all of them fall into one hour.
    """
    placed = with_global_index(plays.select("userId", "ts", item), "userId", "ts", item, name="_at")
    first = placed.groupBy(F.col("userId").alias("_u")).agg(F.min("_at").alias("_first"))
    return placed.join(first, F.col("userId").eqNullSafe(F.col("_u"))).select(
        "userId", (F.col("_at") - F.col("_first")).cast("bigint").alias("pos"), item)


def user_sequences(plays: DataFrame, item: str = "song") -> DataFrame:
    """Histories of all users in long form, whatever their length: ``userId, pos, item``.

    A row per play is the form that encoding, appending and decoding work on. :func:`whole_sequences` makes
    one array a user of it; for histories with a bound see :func:`bounded_sequences` and :func:`last_plays`.
    """
    return play_positions(plays, item).withColumnRenamed(item, "item")


def whole_sequences(sequences: DataFrame) -> DataFrame:
    """One array a user of a long history, whatever its length: ``userId, items``.

    Pieces of :data:`PIECE` plays are put in order by as many tasks as they take; what meets in one task
    are the finished pieces of a user, which is no more than that user's row.
    """
    piece = F.expr(f"pos div {PIECE}").alias("_piece")
    plays = F.array_sort(F.collect_list(F.struct("pos", "item")))
    pieces = (sequences.groupBy("userId", piece).agg(plays.alias("_plays"))
              .select("userId", "_piece", F.col("_plays.item").alias("_items")))
    whole = F.array_sort(F.collect_list(F.struct("_piece", "_items")))
    return (pieces.groupBy("userId").agg(whole.alias("_all"))
            .select("userId", F.flatten("_all._items").alias("items")))


def as_arrays(rows: DataFrame, column: str = "item") -> DataFrame:
    """Long rows as one array a user: ``userId, items, n``. Only for rows that have a bound on ``pos``."""
    pairs = F.array_sort(F.collect_list(F.struct("pos", F.col(column).alias("item"))))
    return (rows.groupBy("userId").agg(pairs.alias("_all"))
            .select("userId", F.col("_all.item").alias("items"), F.size("_all").alias("n")))


def sequence_lengths(plays: DataFrame) -> DataFrame:
    return plays.groupBy("userId").agg(F.count(F.lit(1)).alias("n"))


def length_histogram(lengths: DataFrame) -> DataFrame:
    """Number of users per length, most frequent first."""
    return (lengths.groupBy("n").agg(F.count(F.lit(1)).alias("users"))
            .orderBy(F.desc("users"), "n"))


def sequence_length_filter(lengths: DataFrame, shortest: int = MIN_LENGTH,
                           longest: int = MAX_LENGTH) -> DataFrame:
    return lengths.where(F.col("n").between(shortest, longest))


def bounded_plays(plays: DataFrame, item: str = "song", shortest: int = MIN_LENGTH,
                  longest: int = MAX_LENGTH) -> DataFrame:
    """Histories of the users with ``shortest`` to ``longest`` plays in long form: ``userId, pos, item``.

    A user with more than ``longest`` plays is known from the first ``longest + 1``. Spark applies that
    rank limit before the shuffle as well, so no task ever holds a long history.
    """
    by_user = Window.partitionBy("userId")
    first = (plays.select("userId", "ts", F.col(item).alias("item"))
             .withColumn("_rank", F.row_number().over(by_user.orderBy("ts", "item")))
             .where(F.col("_rank") <= longest + 1))
    return (first.withColumn("_n", F.count(F.lit(1)).over(by_user))
            .where(F.col("_n").between(shortest, longest))
            .select("userId", (F.col("_rank") - 1).cast("bigint").alias("pos"), "item"))


def bounded_sequences(plays: DataFrame, item: str = "song", shortest: int = MIN_LENGTH,
                      longest: int = MAX_LENGTH) -> DataFrame:
    """:func:`bounded_plays` as arrays of ``longest`` items at most: ``userId, items, n``."""
    return as_arrays(bounded_plays(plays, item, shortest, longest))


def last_plays(plays: DataFrame, n: int, item: str = "song") -> DataFrame:
    """The user's last ``n`` plays in time order: ``userId, items``."""
    latest = Window.partitionBy("userId").orderBy(F.desc("ts"), F.desc("item"))
    kept = (plays.select("userId", "ts", F.col(item).alias("item"))
            .withColumn("_rank", F.row_number().over(latest)).where(F.col("_rank") <= n))
    return as_arrays(kept.withColumn("pos", -F.col("_rank"))).select("userId", "items")


def song_vocabulary(plays: DataFrame) -> DataFrame:
    """Distinct songs numbered from 0 in byte order: ``label, song``."""
    songs = plays.select("song").where(F.col("song").isNotNull()).distinct()
    return with_global_index(songs, "song", name="label").select(
        F.col("label").cast("bigint"), "song")


def encode_plays(plays: DataFrame, vocab: DataFrame, song: str = "song") -> DataFrame:
    """Add the ``label`` of each play's song, NULL for a song that isn't in the vocabulary.

    No play is lost, so counts and places stay. AQE splits the plays of a hot song.
    """
    names = vocab.select("label", F.col("song").alias("_song"))
    return plays.join(names, F.col(song) == F.col("_song"), "left").drop("_song")


def encode_sequences(sequences: DataFrame, vocab: DataFrame) -> DataFrame:
    """Long histories of songs (``userId, pos, item``) with a ``label`` in place of the item.

    Each row keeps its place, so nothing is gathered by user; an unknown song has a NULL label.
    """
    return encode_plays(sequences, vocab, "item").select("userId", "pos", "label")


def coded_sequences(plays: DataFrame, vocab: DataFrame, shortest: int = MIN_LENGTH,
                    longest: int = MAX_LENGTH) -> DataFrame:
    """Bounded histories as arrays of labels: ``userId, items, n``."""
    rows = encode_sequences(bounded_plays(plays, shortest=shortest, longest=longest), vocab)
    return as_arrays(rows, "label")


def decode_label(df: DataFrame, vocab: DataFrame, label: str = "label") -> DataFrame:
    """Add the ``song`` of a label; rows without a known label get NULL."""
    names = vocab.select(F.col("label").alias("_label"), "song")
    return df.join(names, F.col(label) == F.col("_label"), "left").drop("_label")


def training_pairs(sequences: DataFrame, first: int = FIRST_TARGET) -> DataFrame:
    """Every prefix of at least ``first`` items with the item after it."""
    at = F.explode(F.sequence(F.lit(first), F.size("items") - 1)).alias("pos")
    return (sequences.where(F.size("items") > first)
            .select("userId", "items", at)
            .select("userId", "pos", prefix(F.col("items"), F.col("pos")).alias("prefix"),
                    F.element_at("items", F.col("pos") + 1).alias("target")))


def holdout_pairs(sequences: DataFrame) -> DataFrame:
    """All items but the last, and the last."""
    size = F.size("items")
    return sequences.where(size > 0).select(
        "userId", prefix(F.col("items"), size - 1).alias("prefix"),
        F.element_at("items", -1).alias("target"))


def padded(pairs: DataFrame, length: int = MAX_LENGTH - 1, label_offset: int = 0) -> DataFrame:
    """Prefixes right-padded with 0 to one length."""
    return pairs.withColumn("prefix", pad_sequence(F.col("prefix"), length, label_offset))


def _drawn(sequences: DataFrame, seed: int, *order: str) -> DataFrame:
    """``userId`` and ``n`` alone, numbered by ``order`` and a hash of the user.

    Only these narrow rows are sorted. The arrays are joined when the choice is made, so ``sequences`` is
    read twice: store it before.
    """
    narrow = sequences.select("userId", "n", spread("userId", seed).alias("_spread"))
    return with_global_index(narrow, *order, "_spread", "userId")


def split_by_length(sequences: DataFrame, test: float = 0.2, seed: int = 42) -> DataFrame:
    """Add ``is_test``: true for the share ``test`` of the users of each length. One row a user.

    Users of one length are ordered by a hash of their id, and the first ``round(test * size)`` are
    taken, so the split is exact and repeatable. A length may be shared by most users, so the order
    comes from range partitions and not from one window per length.
    """
    placed = _drawn(sequences, seed, "n")
    # One row per length, and the lengths are bounded by the sequence filter.
    strata = placed.groupBy(F.col("n").alias("_n")).agg(
        F.min("idx").alias("_start"), F.count(F.lit(1)).alias("_size"))
    chosen: Column = F.col("idx") - F.col("_start") < F.round(F.col("_size") * test)
    flags = placed.join(strata, F.col("n") == F.col("_n")).select("userId", chosen.alias("is_test"))
    return sequences.join(flags, "userId")


def sample_fraction(sequences: DataFrame, fraction: float = 0.95, seed: int = 42) -> DataFrame:
    """``floor(fraction * count)`` of the users, chosen by a repeatable hash. One row a user."""
    placed = _drawn(sequences, seed)
    taken = placed.agg(F.floor(F.count(F.lit(1)) * fraction)).scalar()
    return sequences.join(placed.where(F.col("idx") < taken).select("userId"), "userId", "left_semi")


def dataset_sizes(train: DataFrame, test: DataFrame) -> DataFrame:
    """Number of pairs in both parts, one row each."""
    return (train.agg(F.count(F.lit(1)).alias("pairs")).select(F.lit("train").alias("part"), "pairs")
            .unionByName(test.agg(F.count(F.lit(1)).alias("pairs"))
                         .select(F.lit("test").alias("part"), "pairs")))


def append_history(history: DataFrame, new: DataFrame) -> DataFrame:
    """A long history (``userId, pos, item``) with plays (``userId, ts, song``) after those it has.

    What is there keeps its place and isn't sorted again; new plays go on from the user's length. A user
    without a history starts at 0.
    """
    lengths = history.groupBy(F.col("userId").alias("_u")).agg((F.max("pos") + 1).alias("_length"))
    added = user_sequences(new).join(lengths, F.col("userId") == F.col("_u"), "left").select(
        "userId", (F.col("pos") + F.coalesce("_length", F.lit(0))).alias("pos"), "item")
    return history.select("userId", "pos", "item").unionByName(added)
