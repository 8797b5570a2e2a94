"""SimHash near-duplicates, found through a table of distances to reference fingerprints.

The table holds, for every distinct fingerprint, its Hamming distance to each reference, split by
blocks of bits (the distance is the sum over the blocks). Two facts make it an exact filter:

* the distances of two fingerprints to one reference differ by no more than the two differ,
* four differing bits touch four blocks at most, so of six blocks two have equal coordinates.

The second gives the meeting places: fingerprints meet where all coordinates of two blocks agree.
The first then discards pairs by their greatest coordinate difference, and what survives is
verified by its differing bits. References on whole fingerprints alone would leave more than half
of all pairs per coordinate, which no partitioning can use; the block-wise table can be joined.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunemill.llm.common import mixed, runs, signed, steps, utf8, whole_groups
from tunemill.llm.components import components
from tunemill.session import written

WORDS = 4
BITS = 4
BLOCKS = 6
REFERENCES = 24
SEED = 42
#: Distinct fingerprints of one meeting place that a task compares at once.
GROUP = 100_000
#: Above this a meeting place is searched outwards from single fingerprints instead of pair by pair.
SMALL = 64


def text_fingerprint(text: bytes) -> int:
    """Fingerprint of one text: a bit is set if over half of the shingle hashes have it."""
    from xxhash import xxh64_intdigest

    words = text.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    width = min(WORDS, len(words))
    starts = np.concatenate(([0], ends[:-1] + 1))[:len(words) - width + 1].tolist()
    hashes = np.array([xxh64_intdigest(line[s:e], SEED)
                       for s, e in zip(starts, ends[width - 1:].tolist())], np.uint64)
    set_bits = np.zeros(64, np.int64)
    for begin in range(0, len(hashes), 65_536):
        part = hashes[begin:begin + 65_536].view(np.uint8).reshape(-1, 8)
        set_bits += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * set_bits > len(hashes), bitorder="little"), "little")


def fingerprints(docs: DataFrame) -> DataFrame:
    """``(doc_id, fingerprint)`` with the fingerprint as a long, one row for every row of ``docs``."""
    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            values = np.array([text_fingerprint(t) for t in utf8(batch.column("text"))], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(signed(values))], ["doc_id", "fingerprint"])

    return docs.select("doc_id", "text").mapInArrow(per_task, "doc_id long, fingerprint long")


def references(count: int = REFERENCES) -> np.ndarray:
    """Reference fingerprints, drawn by rule."""
    return mixed(np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def block_masks(blocks: int = BLOCKS) -> np.ndarray:
    """Masks that split 64 bits into ``blocks`` neighbouring runs."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    return np.array([((1 << hi) - 1) ^ ((1 << lo) - 1) for lo, hi in zip(edges, edges[1:])],
                    np.uint64)


def distance_table(values: np.ndarray, refs: np.ndarray, masks: np.ndarray) -> np.ndarray:
    """Distances of ``values`` to ``refs`` by block: an array (values, blocks, references)."""
    apart = values[:, None] ^ refs[None, :]
    return np.bitwise_count(apart[:, None, :] & masks[None, :, None])


def _meeting_places(nodes: DataFrame, bits: int, blocks: int) -> DataFrame:
    """``(place, fingerprint)``: a place for every choice of ``blocks - bits`` blocks."""
    refs, masks = references(), block_masks(blocks)
    choices = list(combinations(range(blocks), blocks - bits))

    def per_task(batches):
        rng = mixed(np.arange(1, len(refs) + 1, dtype=np.uint64))
        for batch in batches:
            for begin in range(0, batch.num_rows, 20_000):
                part = batch.column("fingerprint").slice(begin, 20_000)
                longs = part.to_numpy(zero_copy_only=False)
                table = distance_table(longs.view(np.uint64), refs, masks).astype(np.uint64)
                with np.errstate(over="ignore"):
                    codes = mixed((table * rng).sum(axis=2, dtype=np.uint64))
                    places = []
                    for k, chosen in enumerate(choices):
                        place = np.full(len(longs), k + 1, np.uint64)
                        for b in chosen:
                            place = mixed(place * np.uint64(31) + codes[:, b])
                        places.append(place)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signed(np.concatenate(places))),
                     pa.array(np.tile(longs, len(choices)))], ["place", "fingerprint"])

    return nodes.select("fingerprint").mapInArrow(per_task, "place long, fingerprint long")


def _split_hot(rows: DataFrame, limit: int) -> DataFrame:
    """Deal a place with over ``limit`` fingerprints out to several: every pair of its shares meets."""
    hot = (rows.groupBy("place").agg(F.count("*").alias("held")).where(F.col("held") > limit)
           .select("place", F.ceil(2 * F.col("held") / limit).cast("int").alias("shares")))
    own = F.pmod(F.xxhash64("fingerprint"), F.col("shares")).cast("int")
    dealt = rows.join(hot, "place", "left").withColumn("own", own)
    many = F.transform(
        F.sequence(F.lit(0), F.col("shares") - 1),
        lambda other: F.xxhash64("place", F.least("own", other), F.greatest("own", other)))
    return dealt.select(
        F.explode(F.when(F.col("shares").isNull(), F.array("place")).otherwise(many)).alias("place"),
        "fingerprint")


def _links_of(values: np.ndarray, refs: np.ndarray, bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links that connect whatever is connected among ``values``: a search outwards from each value.

    A value leaves the search when it is reached, so a tight group costs little more than its size.
    """
    table = np.bitwise_count(values[:, None] ^ refs[None, :]).astype(np.int8)
    left = np.arange(1, len(values))
    front, out = [0], []
    while len(left) or front:
        if not front:
            front, left = [int(left[0])], left[1:]
        at = front.pop()
        if not len(left):
            break
        near = np.abs(table[left] - table[at]).max(axis=1) <= bits
        hits = left[near]
        hits = hits[np.bitwise_count(values[hits] ^ values[at]) <= bits]
        if len(hits):
            out.append((np.full(len(hits), values[at]), values[hits]))
            front.extend(hits.tolist())
            left = left[~np.isin(left, hits)]
    return out


def links(nodes: DataFrame, bits: int = BITS, blocks: int = BLOCKS, group: int = GROUP) -> DataFrame:
    """Edges ``(u, v)`` between distinct fingerprints that connect all that differ in <= ``bits`` bits."""
    refs = references()

    def per_task(batches):
        for batch in whole_groups(batches, "place"):
            places = batch.column("place").to_numpy(zero_copy_only=False)
            values = batch.column("fingerprint").to_numpy(zero_copy_only=False).view(np.uint64)
            starts = runs(places)
            sizes = np.diff(starts)
            found = []
            small = np.repeat((sizes > 1) & (sizes <= SMALL), sizes)
            rows = np.flatnonzero(small)
            ends = np.repeat(starts[1:], sizes)
            shift = 1
            while len(rows):
                rows = rows[rows + shift < ends[rows]]
                a, b = values[rows], values[rows + shift]
                for r in refs:  # discard by one coordinate after the other
                    gap = np.bitwise_count(a ^ r).astype(np.int8) - np.bitwise_count(b ^ r)
                    keep = np.abs(gap.astype(np.int8)) <= bits
                    a, b = a[keep], b[keep]
                close = np.bitwise_count(a ^ b) <= bits
                found.append((a[close], b[close]))
                shift += 1
            for i in np.flatnonzero(sizes > SMALL):
                found += _links_of(values[starts[i]:starts[i + 1]], refs, bits)
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signed(np.concatenate([f[k] for f in found]))) for k in (0, 1)],
                    ["u", "v"])

    met = _split_hot(_meeting_places(nodes, bits, blocks), group)
    return (met.repartition("place").sortWithinPartitions("place")
            .mapInArrow(per_task, "u long, v long").where("u != v").distinct())


def near_duplicates(docs: DataFrame, bits: int = BITS, blocks: int = BLOCKS,
                    group: int = GROUP) -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` for every row of ``docs``.

    ``fingerprint`` is a long; ``component_id`` the least doc_id that links reach, the own included.
    NULL and empty texts have fingerprint 0 and link like any other. Rows that repeat a doc_id get a
    row each. A NULL doc_id takes part in links and is never the least; a component of nothing else
    has a NULL id. An empty table gives no rows. Columns beside ``doc_id`` and ``text`` are ignored.
    ``blocks`` must be over ``bits``; more blocks make meeting places smaller and more numerous.
    """
    if not 0 <= bits < blocks:
        raise ValueError("blocks must be over bits")
    prints = written(fingerprints(docs), "fingerprints")
    nodes = written(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first")), "nodes")
    edges = written(links(nodes, bits, blocks, group), "links")
    roots = components(edges).withColumnRenamed("u", "fingerprint")
    joined = roots.join(nodes, "fingerprint")
    named = (joined.groupBy("root").agg(F.min("first").alias("least"))
             .join(joined.select("fingerprint", "root"), "root").select("fingerprint", "least"))
    known = nodes.join(named, "fingerprint", "left").select(
        "fingerprint", F.coalesce("least", "first").alias("component_id"))
    return prints.join(known, "fingerprint").select("doc_id", "fingerprint", "component_id")


def hex_fingerprint(column: str):
    """A long as 16 lowercase hex digits."""
    return F.lower(F.lpad(F.hex(column), 16, "0"))
