"""Character Markov models with smoothed, variable order, counted over all rows of a table.

Characters are classes of UTF-8 bytes, so that the tables have a fixed size whatever the number of
rows: ``classes ** order`` cells. Counting is an aggregation with partial sums in every task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunemill.llm.common import steps, utf8


def alphabet(signs: str, other: int | None = None) -> np.ndarray:
    """Class of each byte: 0 for white space, then one for each group of ``signs`` (split at blanks).

    Letters count in either case; bytes in no group belong to ``other`` (by default a class more).
    """
    groups = signs.split(" ")
    table = np.full(256, len(groups) + 1 if other is None else other, np.int64)
    table[list(b" \t\n\x0b\x0c\r")] = 0
    for k, group in enumerate(groups, 1):
        table[list(group.encode())] = k
        table[list(group.upper().encode())] = k
    return table


def codes(classes: np.ndarray, size: int, order: int) -> np.ndarray:
    """Number of the n-gram that ends at each place, with class 0 before the first."""
    padded = np.concatenate((np.zeros(order - 1, np.int64), classes))
    total = np.zeros(len(classes), np.int64)
    for k in range(order):
        total = total * size + padded[k:k + len(classes)]
    return total


def count_ngrams(texts: DataFrame, label: str, table: np.ndarray, order: int) -> DataFrame:
    """``(label, code, n)``: n-grams of ``text`` by the integer column ``label``, over every row.

    Rows of a NULL label are left out; a NULL text counts as empty.
    """
    size = int(table.max()) + 1

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in steps(batches):
            labels = batch.column(label).to_numpy(zero_copy_only=False)
            data = [t + b" " for t in utf8(batch.column("text"))]
            for kind in np.unique(labels):
                raw = b" " + b"".join(d for d, k in zip(data, labels) if k == kind)
                grams = codes(table[np.frombuffer(raw, np.uint8)], size, order)
                into = sums.setdefault(int(kind), np.zeros(size ** order, np.int64))
                into += np.bincount(grams, minlength=len(into))
        for kind, counts in sums.items():
            found = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(found), kind, np.int32)), pa.array(found.astype(np.int32)),
                 pa.array(counts[found])], ["label", "code", "n"])

    return (texts.where(F.col(label).isNotNull()).select(F.col(label).cast("int").alias(label), "text")
            .mapInArrow(per_task, "label int, code int, n long")
            .groupBy("label", "code").agg(F.sum("n").alias("n")))


def log_probabilities(code: np.ndarray, n: np.ndarray, size: int, order: int) -> np.ndarray:
    """Natural logarithm of P(last | before) for every n-gram, flat by its number.

    Each order is mixed with the next lower by the kinds of characters seen after its context
    (Witten-Bell); a context never seen leaves all to the lower order, down to equal shares.
    """
    counts = np.zeros(size ** order, np.float64)
    counts[code] = n
    levels = [counts.reshape((size,) * order)]
    for _ in range(order - 1):
        levels.append(levels[-1].sum(axis=0))
    mixed = np.full(size, 1.0 / size)
    for level in reversed(levels):
        seen = level.sum(axis=-1, keepdims=True)
        kinds = np.maximum((level > 0).sum(axis=-1, keepdims=True), 1.0)
        mixed = (level + kinds * mixed) / (seen + kinds)
    return np.log(mixed).astype(np.float32).reshape(-1)
