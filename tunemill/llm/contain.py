"""Benchmark decontamination: size-partitioned MinHash containment search.

Test items are short, documents long, so a signature of the document would say nothing. Only items
get sketches: the shingles with the smallest hashes, in the order that one hash function gives all.
Items are partitioned by size (powers of two), and the partition fixes the sketch: of ``n`` distinct
shingles at most ``(1 - t) * n`` may be missing from a document that holds a share of ``t``, so with
one more than that for the largest size of the partition, at least one sketch shingle is in every
document to be found. A document is a candidate if it holds one; candidates are verified by the
exact share of the item's shingles.

Tasks test shingles against two bit sets, one of sketch hashes and one of all item hashes. They have
a fixed size whatever the number of items (full ones let more through, they lose nothing); what
passes is joined with the items' shingles.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunemill.llm.common import WordCodes, mixed, signed, steps, utf8
from tunemill.session import written

WORDS = 5
SHARE = 0.8
#: Bits of each bit set, as a power of two: 2 MB in every task.
BIT_SET = 24
#: What is cut off both ends of a word.
EDGES = b".,;:!?\"'()[]{}<>*#$%&|-_+=~`/\\"


class PlainWordCodes(WordCodes):
    """Codes of words without punctuation around them and with A-Z in lower case; 0 if nothing is left."""

    def __missing__(self, word: bytes) -> int:
        from xxhash import xxh64_intdigest

        if len(self) >= self.limit:
            self.clear()
        plain = word.lower().strip(EDGES)
        code = self[word] = xxh64_intdigest(plain, 42) | 1 if plain else 0
        return code


def shingle_hashes(text: bytes, codes: WordCodes, width: int = WORDS) -> np.ndarray:
    """Hashes of the word shingles of a text in order; none if it has fewer words than ``width``."""
    words = codes.of(text.split())
    words = words[words != 0]
    if len(words) < width:
        return words[:0]
    count = len(words) - width + 1
    total = np.zeros(count, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(width):
            total = total * np.uint64(0x9E3779B97F4A7C15) + words[i:i + count]
    return mixed(total)


def sketch_size(distinct: int, share: float) -> int:
    """Sketch of an item by the largest size in its partition."""
    largest = 1 << max(0, math.ceil(math.log2(distinct)))
    return int((1 - share) * largest + 1e-9) + 1


def item_shingles(items: DataFrame, share: float = SHARE, width: int = WORDS) -> DataFrame:
    """``(item_id, hash, distinct, in_sketch)``: every distinct shingle of every item."""
    def per_task(batches):
        codes = PlainWordCodes()
        for batch in steps(batches):
            ids = batch.column("item_id").to_pylist()
            for item, text in zip(ids, utf8(batch.column("text"))):
                hashes = np.unique(shingle_hashes(text, codes, width))
                if item is None or not len(hashes):
                    continue
                n = len(hashes)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([item] * n, pa.int64()), pa.array(signed(hashes)),
                     pa.array([n] * n, pa.int64()),
                     pa.array(np.arange(n) < sketch_size(n, share))],
                    ["item_id", "hash", "distinct", "in_sketch"])

    return items.select("item_id", "text").mapInArrow(
        per_task, "item_id long, hash long, distinct long, in_sketch boolean")


def _bit_set(shingles: DataFrame, bits: int) -> np.ndarray:
    """Bit set of the hashes of ``shingles``, as 64-bit words; its size depends on ``bits`` only."""
    place = F.col("hash").bitwiseAND((1 << bits) - 1)
    words = shingles.select(place.alias("place")).groupBy(F.expr("shiftright(place, 6)").alias("at")).agg(
        F.expr("bit_or(shiftleft(1L, cast(place % 64 as int)))").alias("bits")).toArrow()
    out = np.zeros(1 << (bits - 6), np.uint64)
    out[words.column("at").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    return out


def _inside(bit_set: np.ndarray, hashes: np.ndarray, bits: int) -> np.ndarray:
    place = hashes & np.uint64((1 << bits) - 1)
    return (bit_set[place >> np.uint64(6)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)


def _hits(docs: DataFrame, sketches: np.ndarray, everything: np.ndarray, bits: int,
          width: int) -> DataFrame:
    """``(doc_id, hash)``: shingles that may be an item's, of documents that may hold a sketch's."""
    sets = docs.sparkSession.sparkContext.broadcast((sketches, everything))

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = PlainWordCodes()
        first, full = sets.value
        for batch in steps(batches):
            owners, found = [], []
            ids = batch.column("doc_id").to_pylist()
            for doc, text in zip(ids, utf8(batch.column("text"))):
                hashes = shingle_hashes(text, codes, width)
                if doc is None or not len(hashes) or not _inside(first, hashes, bits).any():
                    continue
                own = np.unique(hashes[_inside(full, hashes, bits)])
                found.append(own)
                owners.append(np.full(len(own), doc, np.int64))
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(owners)), pa.array(signed(np.concatenate(found)))],
                    ["doc_id", "hash"])

    return docs.select("doc_id", "text").mapInArrow(per_task, "doc_id long, hash long")


def contained(docs: DataFrame, items: DataFrame, share: float = SHARE, width: int = WORDS,
              bits: int = BIT_SET) -> DataFrame:
    """``(doc_id, item_id, containment)`` where a document holds ``share`` of an item's shingles or more.

    Containment counts distinct shingles of ``width`` words (punctuation around words and the case of
    A-Z don't matter) in the whole document. Items and documents with fewer words have no shingles
    and match nothing, likewise NULL texts and NULL ids. Rows that repeat an id count as one document
    (or item) that holds the shingles of all of them; the sketch of an item of several rows is all of
    its shingles. Empty tables give no rows, and columns beside
    the id and ``text`` are ignored.
    """
    if not 0 < share <= 1:
        raise ValueError("share must be over 0 and not over 1")
    # a sketch of one row says nothing about the union of several, so all shingles of such items are in theirs
    several = items.groupBy("item_id").agg((F.count("*") > 1).alias("several"))
    shingles = written(item_shingles(items, share, width).join(several, "item_id").select(
        "item_id", "hash", (F.col("in_sketch") | F.col("several")).alias("in_sketch")), "item-shingles")
    hits = _hits(docs, _bit_set(shingles.where("in_sketch"), bits), _bit_set(shingles, bits), bits,
                 width).distinct()
    sizes = shingles.groupBy("item_id").agg(F.countDistinct("hash").alias("size"))
    owned = shingles.groupBy("item_id", "hash").agg(F.max("in_sketch").alias("in_sketch"))
    held = (hits.join(owned, "hash").groupBy("doc_id", "item_id")
            .agg(F.count("*").alias("held"), F.max("in_sketch").alias("candidate"))
            .where("candidate"))
    return (held.join(sizes, "item_id")
            .select("doc_id", "item_id", (F.col("held") / F.col("size")).alias("containment"))
            .where(F.col("containment") >= share))
