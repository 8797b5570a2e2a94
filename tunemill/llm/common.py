"""Helpers that several operators of this package share."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

#: Text bytes that one step inside a Python task takes at once (a single longer text is one step).
STEP_BYTES = 4 << 20
#: Rows of a batch for Python tasks that hold whole texts: JVM and worker both keep it outside of the heap.
BATCH_ROWS = 1000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Bytes of a batch for Python tasks of the pipeline, whose executors do one stage after the other.
BATCH_BYTES = 3 << 20
_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def steps(batches: Iterator[pa.RecordBatch], column: str = "text",
          step_bytes: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in order, cut so that a piece holds about ``step_bytes`` of ``column``."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        ends = np.cumsum(lengths.to_numpy(zero_copy_only=False).astype(np.int64))
        begin = 0
        while begin < batch.num_rows:
            before = ends[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(ends, before + step_bytes, "right")))
            yield batch.slice(begin, end - begin)
            begin = end


@contextmanager
def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> Iterator[None]:
    """Python tasks of what runs here get batches of ``rows`` rows at most; a session that asks for fewer gets fewer."""
    before = spark.conf.get(_BATCH, None)
    now = int(spark.conf.get(_BATCH))
    spark.conf.set(_BATCH, str(min(now, rows) if now > 0 else rows))
    try:
        yield
    finally:
        spark.conf.unset(_BATCH) if before is None else spark.conf.set(_BATCH, before)


def bound_batches(spark: SparkSession, size: int = BATCH_BYTES) -> None:
    """Python tasks of this session get batches of about ``size`` bytes at most, unless the session has a bound of its own.

    It stays set, because a frame that is returned runs later. Rows without texts are too short for it to matter.
    """
    if spark.conf.get(_BYTES, None) is None:
        spark.conf.set(_BYTES, str(size))


@contextmanager
def bounded_batches(spark: SparkSession, size: int = BATCH_BYTES) -> Iterator[None]:
    """As :func:`bound_batches`, for what runs here."""
    unset = spark.conf.get(_BYTES, None) is None
    bound_batches(spark, size)
    try:
        yield
    finally:
        if unset:
            spark.conf.unset(_BYTES)


def utf8(array: pa.Array) -> list[bytes]:
    """The values of a string column as UTF-8, NULL as nothing."""
    kind = pa.large_binary() if pa.types.is_large_string(array.type) else pa.binary()
    return [value or b"" for value in array.cast(kind).to_pylist()]


def signed(values: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit numbers as the longs of Spark with the same bits."""
    return np.ascontiguousarray(values, dtype=np.uint64).view(np.int64)


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mix, so that every output bit depends on every input bit."""
    x = np.asarray(values, dtype=np.uint64).copy()
    with np.errstate(over="ignore"):
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


class WordCodes(dict):
    """64-bit codes of words, kept for words already seen; emptied when it grows over ``limit``."""

    def __init__(self, limit: int = 400_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        from xxhash import xxh64_intdigest

        if len(self) >= self.limit:
            self.clear()
        code = self[word] = xxh64_intdigest(word, 42)
        return code

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def runs(keys: np.ndarray) -> np.ndarray:
    """Start of every run of equal neighbours in ``keys``, and their length as the last entry."""
    if not len(keys):
        return np.zeros(1, np.int64)
    return np.concatenate(([0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]))


def whole_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.RecordBatch]:
    """Rows sorted by ``key``, cut anew so that no group of equal keys is spread over two pieces."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column(key).to_numpy(zero_copy_only=False)
        last = int(np.searchsorted(values, values[-1], "left"))
        if last == 0 and held and held[-1].column(key)[-1].as_py() == values[0]:
            held.append(batch)
            continue
        if held:
            first = held[-1].column(key)[-1].as_py()
            cut = int(np.searchsorted(values, first, "right"))
            if cut:
                held.append(batch.slice(0, cut))
            yield _joined(held)
            batch, last = batch.slice(cut), last - cut
            held = []
        if last > 0:
            yield batch.slice(0, last)
        held = [batch.slice(max(last, 0))]
    if held:
        yield _joined(held)


def _joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    return parts[0] if len(parts) == 1 else pa.concat_batches(parts)
