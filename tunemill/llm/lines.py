"""Line dedup by an exact set-similarity join: rarest tokens first, prefix, position and length filters.

A line is the set of its words. Words are ordered by rarity (counted over all documents by hashed
buckets, ties by hash), and two lines of Jaccard similarity ``t`` or more share a word among the
first ``n - ceil(t * n) + 1`` of each. Lines meet at those words; the sizes, the places of the word
in both, and parity signatures leave few pairs, which are verified on the whole sets. A line that
an earlier one (by document, then by line) is similar to is removed.

Copies and near copies never make all pairs. A line equal to an earlier one of the same step is
settled there, and short sets are grouped over all steps; at a meeting word a later line takes one earlier candidate and leaves. Only for lines
whose candidates all fail, which few do, every candidate is tried in a second round, where lines meet
at pairs of words: similar lines share two words among the first ``n - ceil(t * n) + 2`` of each, and
other lines hardly ever do. Meeting keys of many lines are dealt out so that every pair of shares
meets. The bit sets and bucket counts that tasks hold have a bounded size whatever the input.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunemill.llm.common import bounded_batches, mixed, runs, signed, steps, utf8, whole_groups
from tunemill.session import written

SIMILARITY = 0.8
#: Lines of fewer words are left alone, unless a caller asks for shorter ones; the registered query and the pipeline take all.
LEAST_WORDS = 5
#: Sets of fewer words are told to be equal by a grouping, before the join.
SHORT = 5
#: Buckets of words for rarity, and bits of the sets of lines and words, as powers of two.
BUCKETS = 20
BIT_SET = 24
#: Lines that meet at a word in one task.
GROUP = 1 << 15
#: Sets of more words meet at single words in the second round as well, as pairs of words grow with the square of a prefix.
LONG = 160
#: Most bits, as a power of two, of the set of keys in the second round.
KEY_BITS = 28
#: Text bytes that a task takes at once: arrays of some eighty times that live for a moment.
STEP = 3 << 19
#: A line at a key, as packs of them go through the shuffle: key, document, line, size, place, and both halves of a signature.
POSTING = np.dtype([("word", "<u8"), ("doc", "<i8"), ("low", "<u8"), ("high", "<u8"), ("line", "<i4"), ("n", "<i4"), ("at", "<i4")])
#: Packs are made of so many postings at a time; of a place there are two to the power of ``_PLACES`` at least, with ``_PLACE`` postings at most.
_PACKED = 1 << 18
_PLACES = 11
_PLACE = 1 << 16
#: Pairs that a task holds before it hands them on.
_PAIRS = 1 << 18
_CHUNK = 1 << 12
_HOT_BUCKETS = 16
_KEY_ROWS = 2000


def overlap_needed(total: np.ndarray, similarity: float) -> np.ndarray:
    """Least common words of two sets of ``total`` words together."""
    return np.ceil(similarity / (1 + similarity) * total - 1e-9).astype(np.int64)


def partner_size(n: np.ndarray, at: np.ndarray, similarity: float) -> np.ndarray:
    """Most words of a set that can be similar to one of ``n`` words, if the first common word stands at ``at`` of these."""
    total = np.floor((n - at + 1e-9) * (1 + similarity) / similarity).astype(np.int64) + 1
    while (over := overlap_needed(total, similarity) > n - at).any():
        total -= over
    return total - n


def prefix_size(n: np.ndarray, similarity: float) -> np.ndarray:
    return n - np.ceil(similarity * n - 1e-9).astype(np.int64) + 1


_WHITE = np.isin(np.arange(256), list(b" \t\n\x0b\x0c\r"))
_LETTER = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_LETTER[65:91] = _LETTER[97:123]
_LETTER[_WHITE] = 0
_STEP = 0xD6E8FEB86659FD93
#: The number that undoes a multiplication by ``_STEP``.
_BACK = pow(_STEP, -1, 1 << 64)
#: Powers are kept for so many letters; longer texts make their own.
_KEPT = STEP + (1 << 16)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, count: int) -> np.ndarray:
    """The first ``count`` powers of ``base``, of 64 bits."""
    if base not in _powers or count > _KEPT:
        size = max(count, _KEPT)
        with np.errstate(over="ignore"):
            made = np.multiply.accumulate(np.concatenate((np.ones(1, np.uint64), np.full(size - 1, base, np.uint64))))
        if size > _KEPT:
            return made
        _powers[base] = made
    return _powers[base][:count]


def hashed_words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words in UTF-8 bytes (A-Z as lower case), and where each begins.

    Whole arrays at a time: numbers of the letters, each times a power for its place in the data; the
    sum of a word is then moved to its beginning, and white space counts nothing.
    """
    inside = np.concatenate(([False], ~_WHITE[data], [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64), starts
    with np.errstate(over="ignore"):
        terms = _LETTER[data]
        terms *= _power(_STEP, len(data))
        sums = np.add.reduceat(terms, starts) * _power(_BACK, len(data))[starts]
        return mixed(sums + (ends - starts).astype(np.uint64)), starts


def _bucket_sums(rows: DataFrame, hashed: Callable[[pa.RecordBatch], Iterable[np.ndarray]], buckets: int) -> np.ndarray:
    """How many of the hashes that ``hashed`` makes of the batches of ``rows`` end in each of ``2 ** buckets`` numbers."""
    chunk = min(_CHUNK, 1 << buckets)

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(1 << buckets, np.int64)
        for batch in batches:
            for hashes in hashed(batch):
                sums += np.bincount((hashes & np.uint64(len(sums) - 1)).astype(np.int64), minlength=len(sums))
        for at in (at for at in range(0, len(sums), chunk) if sums[at:at + chunk].any()):
            yield pa.RecordBatch.from_arrays(
                [pa.array([at // chunk], pa.int32()), pa.array([sums[at:at + chunk].tobytes()])], ["chunk", "sums"])

    def added(part: pd.DataFrame) -> pd.DataFrame:
        total = sum((np.frombuffer(s, np.int64) for s in part["sums"]), np.zeros(chunk, np.int64))
        return pd.DataFrame({"chunk": part["chunk"].iloc[:1], "sums": [total.tobytes()]})

    found = (rows.mapInArrow(per_task, "chunk int, sums binary")
             .groupBy("chunk").applyInPandas(added, "chunk int, sums binary").toArrow())
    totals = np.zeros(1 << buckets, np.int64)
    for at, sums in zip(found.column("chunk").to_pylist(), found.column("sums").to_pylist()):
        totals[at * chunk:(at + 1) * chunk] = np.frombuffer(sums, np.int64)
    return totals


def rarity_levels(docs: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Level of every bucket of words: the binary logarithm of how often its words stand in ``docs``."""
    def hashed(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for step in steps([batch], step_bytes=STEP):
            yield hashed_words(np.frombuffer(b"\n".join(utf8(step.column("text"))), np.uint8))[0]

    totals = _bucket_sums(docs.select("text"), hashed, buckets)
    return np.ceil(np.log2(totals + 1)).astype(np.uint8)


def line_hash(doc: np.ndarray, number: np.ndarray) -> np.ndarray:
    """Hash of document and line number, as bit sets hold it."""
    with np.errstate(over="ignore"):
        return mixed(np.asarray(doc, np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                     + np.asarray(number, np.int64).view(np.uint64))


def _within_lines(line: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """Order by line and then by token; one sort of a joint key unless that leaves a doubt."""
    if not len(line) or line[-1] < 1 << 20:
        key = line.astype(np.uint64) << np.uint64(44) | tokens >> np.uint64(20)
        order = np.argsort(key)
        ranked, found = key[order], tokens[order]
        if not np.any((ranked[1:] == ranked[:-1]) & (found[1:] != found[:-1])):
            return order
    return np.lexsort((tokens, line))


class _Lines:
    """The lines of a step with ``least`` words or more: owner, number, and their sets as sorted tokens.

    With ``wanted``, a bit set of lines, only those.
    """

    def __init__(self, batch: pa.RecordBatch, levels: np.ndarray, least: int, wanted: np.ndarray | None = None):
        ids = batch.column("doc_id").to_pylist()
        kept = [i for i, doc in enumerate(ids) if doc is not None]
        texts = utf8(batch.column("text"))
        texts = [texts[i] for i in kept]
        data = np.frombuffer(b"\n".join(texts), np.uint8)
        ends = np.flatnonzero(data == 10)
        counts = np.array([t.count(b"\n") + 1 for t in texts], np.int64)
        # all lines of the step, whatever their words
        doc = np.repeat(np.array([ids[i] for i in kept], np.int64), counts)
        number = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
        if wanted is not None and len(doc):
            take = _inside(wanted, line_hash(doc, number))
            data = data[np.repeat(take, np.diff(np.concatenate(([-1], ends, [len(data) - 1]))))]
            ends, doc, number = np.flatnonzero(data == 10), doc[take], number[take]
        hashes, starts = hashed_words(data)
        line = np.searchsorted(ends, starts)
        use = np.bincount(line, minlength=len(doc)) >= least
        hashes, line = hashes[use[line]], (np.cumsum(use) - 1)[line[use[line]]]
        self.doc, self.number = doc[use], number[use]
        # a token: the level of its word above 59 bits of its hash, so that rare words come first
        level = levels[(hashes & np.uint64(len(levels) - 1)).astype(np.int64)].astype(np.uint64)
        tokens = (np.minimum(level, np.uint64(31)) << np.uint64(59)) | (mixed(hashes) >> np.uint64(5))
        order = _within_lines(line, tokens)
        tokens, line = tokens[order], line[order]
        new = np.ones(len(tokens), bool)
        new[1:] = (tokens[1:] != tokens[:-1]) | (line[1:] != line[:-1])
        self.tokens = tokens[new]
        self.size = np.bincount(line[new], minlength=len(self.doc))
        self.begin = np.cumsum(self.size) - self.size

    def signatures(self) -> tuple[np.ndarray, np.ndarray]:
        """Parity of the tokens at each of 128 places: sets apart by ``d`` tokens differ in <= ``d`` bits."""
        if not len(self.size):
            return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        bit = np.uint64(1) << (self.tokens & np.uint64(63))
        upper = (self.tokens & np.uint64(64)) > 0
        none = np.uint64(0)
        return (np.bitwise_xor.reduceat(np.where(upper, none, bit), self.begin),
                np.bitwise_xor.reduceat(np.where(upper, bit, none), self.begin))

    def sums(self) -> np.ndarray:
        """A number that equal sets have in common (verified where it decides)."""
        if not len(self.size):
            return np.zeros(0, np.uint64)
        with np.errstate(over="ignore"):
            return np.add.reduceat(mixed(self.tokens), self.begin) + self.size.astype(np.uint64)


def _lists(tokens: np.ndarray, begin: np.ndarray, size: np.ndarray) -> pa.Array:
    ends = np.cumsum(size)
    at = np.repeat(begin - (ends - size), size) + np.arange(int(ends[-1]) if len(ends) else 0)
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)).astype(np.int32)),
                                    pa.array(signed(tokens[at])))


def _prefixes(docs: DataFrame, levels: np.ndarray, similarity: float, least: int) -> DataFrame:
    """``(doc_id, line_no, n, low, high, prefix)`` (both halves of a signature) of the lines that go on, ``prefix`` NULL for those
    that are settled: equal to an earlier line of the same step. It is a word longer than one meeting word asks for; of a set of
    fewer than ``SHORT`` words it is the whole set."""
    sent = docs.sparkSession.sparkContext.broadcast(levels)

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, step_bytes=STEP):
            found = _Lines(batch, sent.value, least)
            if not len(found.size):
                continue
            sums = found.sums()
            order = np.lexsort((found.number, found.doc, sums))
            sums = sums[order]
            settled = np.zeros(len(order), bool)
            first = np.repeat(runs(sums)[:-1], np.diff(runs(sums)))
            for i in np.flatnonzero(first != np.arange(len(order))):
                x, y = order[first[i]], order[i]
                same = found.size[x] == found.size[y] and np.array_equal(
                    found.tokens[found.begin[x]:found.begin[x] + found.size[x]],
                    found.tokens[found.begin[y]:found.begin[y] + found.size[y]])
                settled[y] = same and (found.doc[x], found.number[x]) < (found.doc[y], found.number[y])
            size = np.where(settled, 0, np.where(found.size < SHORT, found.size, np.minimum(found.size, prefix_size(found.size, similarity) + 1)))
            lists = _lists(found.tokens, found.begin, size)
            lists = pa.ListArray.from_arrays(lists.offsets, lists.values, mask=pa.array(settled))
            yield pa.RecordBatch.from_arrays(
                [pa.array(found.doc), pa.array(found.number.astype(np.int32)), pa.array(found.size.astype(np.int32)),
                 *(pa.array(signed(s)) for s in found.signatures()), lists],
                ["doc_id", "line_no", "n", "low", "high", "prefix"])

    return docs.select("doc_id", "text").mapInArrow(
        per_task, "doc_id long, line_no int, n int, low long, high long, prefix array<long>")


def _short_firsts(short: DataFrame, similarity: float) -> tuple[DataFrame, DataFrame]:
    """Of lines with short sets: the first of every set that another set can be similar to, and the lines that an equal one precedes."""
    least = F.min(F.struct("doc_id", "line_no")).alias("first")
    firsts = written(short.groupBy("prefix").agg(least, *(F.min(c).alias(c) for c in ("n", "low", "high")))
                     .select("first.doc_id", "first.line_no", "n", "low", "high", "prefix"), "short-lines")
    later = short.join(firsts, ["doc_id", "line_no", "prefix"], "left_anti").select("doc_id", "line_no")
    sizes = np.arange(1, SHORT)
    fewest = np.ceil(similarity * sizes - 1e-9)
    meet = (fewest < sizes) | (np.floor(sizes / similarity + 1e-9) > sizes)
    return firsts.where(F.col("n").isin([int(k) for k in sizes[meet]])), later


def _bit_set(hashes: DataFrame, bits: int) -> np.ndarray:
    """Bit set of a column ``hash``; its size depends on ``bits`` only."""
    words = (hashes.select(F.col("hash").bitwiseAND((1 << bits) - 1).alias("place"))
             .groupBy(F.expr("shiftright(place, 6)").alias("at"))
             .agg(F.expr("bit_or(shiftleft(1L, cast(place % 64 as int)))").alias("bits")).toArrow())
    out = np.zeros(1 << (bits - 6), np.uint64)
    out[words.column("at").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    return out


def _inside(bit_set: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    place = hashes & np.uint64(len(bit_set) * 64 - 1)
    return (bit_set[place >> np.uint64(6)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)


def _places(rows: DataFrame) -> DataFrame:
    """Hashes of the lines ``(doc_id, line_no)``, by :func:`line_hash`."""
    def per_task(batches):
        for batch in batches:
            found = line_hash(*(batch.column(c).to_numpy(zero_copy_only=False) for c in ("doc_id", "line_no")))
            yield pa.RecordBatch.from_arrays([pa.array(signed(found))], ["hash"])

    return rows.select("doc_id", "line_no").mapInArrow(per_task, "hash long")


def _word_keys(batch: pa.RecordBatch, similarity: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, place and word of every word at which a line meets others in the first round."""
    return _single(batch, np.arange(batch.num_rows), similarity)


def _single(batch: pa.RecordBatch, rows: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    lists = batch.column("prefix")
    n = batch.column("n").to_numpy(zero_copy_only=False).astype(np.int64)[rows]
    size = prefix_size(n, similarity)
    at = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    words = lists.values.to_numpy(zero_copy_only=False).view(np.uint64)
    return np.repeat(rows, size), at, words[np.repeat(lists.offsets.to_numpy()[:-1].astype(np.int64)[rows], size) + at]


def _pair_keys(batch: pa.RecordBatch, similarity: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, place and key of the pairs of words at which a line meets others in the second round.

    Similar sets share ``max(ceil(t * n))`` words or more. Where that is two, both hold the first two
    common words in a prefix one word longer; the second of them stands a place or more after the
    first, so the place before it bounds what can be common. Single words stand in for pairs where one
    common word can be enough, and for sets over ``LONG`` words; sets near ``LONG`` have both, so that
    every two sets of sizes that can be similar have keys of one kind in common.
    """
    n = batch.column("n").to_numpy(zero_copy_only=False).astype(np.int64)
    least = np.ceil(similarity * n - 1e-9)
    parts = [_single(batch, np.flatnonzero((least < 2) | (n > np.floor(similarity * LONG))), similarity)]
    words = batch.column("prefix").values.to_numpy(zero_copy_only=False).view(np.uint64)
    begin = batch.column("prefix").offsets.to_numpy()[:-1].astype(np.int64)
    size = np.where(n <= LONG, np.minimum(n, prefix_size(n, similarity) + 1), 0)
    for p in np.unique(size[size > 1]):
        rows = np.flatnonzero(size == p)
        first, second = np.triu_indices(int(p), 1)
        held = words[begin[rows][:, None] + np.arange(p)]
        with np.errstate(over="ignore"):
            keys = mixed(mixed(held[:, first]) + np.uint64(0x9E3779B97F4A7C15) * held[:, second])
        parts.append((np.repeat(rows, len(first)), np.tile(second - 1, len(rows)), keys.ravel()))
    return tuple(np.concatenate(v) for v in zip(*parts))


def _small(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, _KEY_ROWS):
        # taken, not sliced, so that offsets of lists begin at 0
        yield batch.take(pa.array(np.arange(at, min(at + _KEY_ROWS, batch.num_rows))))


def _in_packs(arrays: Iterator[np.ndarray], places: int) -> Iterator[pa.RecordBatch]:
    """Postings as ``(place, postings)``: in packs of those that some ``_PACKED`` have for one of ``2 ** places`` places."""
    for made in _together(arrays, _PACKED):
        place = (mixed(made["word"]) >> np.uint64(64 - places)).astype(np.int64)
        order = np.argsort(place, kind="stable")
        place, made = place[order], made[order]
        starts = runs(place)
        for some in range(0, len(starts) - 1, _KEY_ROWS):
            edges = starts[some:some + _KEY_ROWS + 1]
            yield pa.RecordBatch.from_arrays(
                [pa.array(place[edges[:-1]]), pa.array([made[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:])], pa.binary())],
                ["place", "postings"])


def _unpacked(batch: pa.RecordBatch) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column("postings").to_pylist()), POSTING)


def _made(batches: Iterator[pa.RecordBatch], keys_of: Callable, similarity: float) -> Iterator[np.ndarray]:
    """The postings of lines, by the keys of ``keys_of``."""
    for batch in batches:
        for part in _small(batch):
            row, at, key = keys_of(part, similarity)
            out = np.empty(len(key), POSTING)
            out["word"], out["at"] = key, at
            for name, column in (("doc", "doc_id"), ("line", "line_no"), ("n", "n"), ("low", "low"), ("high", "high")):
                out[name] = part.column(column).to_numpy(zero_copy_only=False).view(POSTING[name])[row]
            yield out


def _postings(prefixes: DataFrame, keys_of: Callable, similarity: float, group: int,
              wanted: np.ndarray | None = None) -> DataFrame:
    """A posting for every line and key (with ``wanted``, a bit set of keys by two hashes, of those only), in
    packs of those that a step has for a meeting place: ``(place, postings)``, bytes of ``POSTING``.

    A place is that of many keys, told by a hash; their number grows with the postings, so that those of
    a place do not. Keys that over ``group`` lines have, counted by hashed buckets, are dealt out: ``word``
    is then a hash of the key and two shares, and a line goes to every pair of shares that has its own.
    """
    sc = prefixes.sparkSession.sparkContext
    rows = prefixes.select("doc_id", "line_no", "n", "low", "high", "prefix")

    def hashed(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        return (mixed(keys_of(part, similarity)[2]) for part in _small(batch))

    by_lines = wanted is None
    if by_lines:
        totals = _bucket_sums(rows.select("n", "prefix"), hashed, _HOT_BUCKETS)
    else:
        # few of many keys: found once, and kept
        sent = sc.broadcast(wanted)

        def wanted_keys(part: pa.RecordBatch, similarity: float) -> tuple[np.ndarray, ...]:
            row, at, key = keys_of(part, similarity)
            use = np.flatnonzero(_inside(sent.value, key))
            use = use[_inside(sent.value, mixed(key[use]))]
            return row[use], at[use], key[use]

        rows = written(rows.mapInArrow(lambda batches: _in_packs(_made(batches, wanted_keys, similarity), 1),
                                       "place long, postings binary").select("postings"), "open-postings")
        totals = _bucket_sums(rows, lambda batch: [mixed(_unpacked(batch)["word"])], _HOT_BUCKETS)
    dealt = np.where(totals > group, -(-2 * totals // group), 0).astype(np.int32)
    count = int((totals * np.maximum(dealt, 1)).sum())
    places = max(_PLACES, (count // _PLACE).bit_length())
    shares = sc.broadcast(dealt)

    def in_shares(arrays: Iterator[np.ndarray]) -> Iterator[np.ndarray]:
        parts = shares.value
        for made in arrays:
            share = parts[(mixed(made["word"]) & np.uint64(len(parts) - 1)).astype(np.int64)].astype(np.int64)
            if share.any():
                times = np.maximum(share, 1)
                other = np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)
                made, share = np.repeat(made, times), np.repeat(share, times)
                own = (line_hash(made["doc"], made["line"]) % np.maximum(share, 1).astype(np.uint64)).astype(np.int64)
                both = np.minimum(own, other) << 32 | np.maximum(own, other)
                with np.errstate(over="ignore"):
                    made["word"] = np.where(share > 0, mixed(made["word"] + mixed(both.view(np.uint64) + np.uint64(1))), made["word"])
            yield made

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = _made(batches, keys_of, similarity) if by_lines else map(_unpacked, batches)
        return _in_packs(in_shares(made), places)

    return rows.mapInArrow(per_task, "place long, postings binary")


def _keys_of_lines(prefixes: DataFrame, wanted: np.ndarray, similarity: float) -> DataFrame:
    """Two hashes, column ``hash``, of every key that lines of a bit set have in the second round."""
    sent = prefixes.sparkSession.sparkContext.broadcast(wanted)

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            use = _inside(sent.value, line_hash(*(batch.column(c).to_numpy(zero_copy_only=False) for c in ("doc_id", "line_no"))))
            for part in _small(batch.filter(pa.array(use))):
                key = np.unique(_pair_keys(part, similarity)[2])
                yield pa.RecordBatch.from_arrays([pa.array(signed(np.concatenate((key, mixed(key)))))], ["hash"])

    return prefixes.select("doc_id", "line_no", "n", "prefix").mapInArrow(per_task, "hash long")


def _together(arrays: Iterator[np.ndarray], rows: int) -> Iterator[np.ndarray]:
    """Arrays put together until they have ``rows`` rows."""
    held, count = [], 0
    for array in arrays:
        held.append(array)
        count += len(array)
        if count >= rows:
            yield np.concatenate(held)
            held, count = [], 0
    if held:
        yield np.concatenate(held)


def _meetings(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """The postings of packs sorted by place, of some whole places at a time, ordered by key, document and line."""
    for found in _together(map(_unpacked, whole_groups(batches, "place")), _PACKED):
        yield found[np.lexsort((found["line"], found["doc"], found["word"]))]


def _pairs_met(found: np.ndarray, similarity: float, wanted: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    """Pairs of lines that pass the filters at a key, of postings ordered by key, document and line; ``wanted`` as targets of
    :func:`_candidates`. They are handed on as they are found, as a key can make the square of its lines."""
    word, doc, number, low, high = (np.ascontiguousarray(found[c]) for c in ("word", "doc", "line", "low", "high"))
    n = found["n"].astype(np.int64)
    most = partner_size(n, found["at"], similarity)
    starts = runs(word)
    before = np.arange(len(word)) - np.repeat(starts[:-1], np.diff(starts))
    y = np.arange(len(word))
    if wanted is not None:
        y = y[_inside(wanted, line_hash(doc, number))]
    shift, xs, ys, held = 1, [], [], 0
    while held or len(y):
        y = y[before[y] >= shift]
        x = y - shift
        good = (n[x] <= most[y]) & (n[y] <= most[x])
        where = np.flatnonzero(good)
        a, b = x[where], y[where]
        total = n[a] + n[b]
        apart = np.bitwise_count(low[a] ^ low[b]).astype(np.int64) + np.bitwise_count(high[a] ^ high[b])
        good[where] = (apart <= total - 2 * overlap_needed(total, similarity)) & ((doc[a] != doc[b]) | (number[a] != number[b]))
        xs.append(x[good])
        ys.append(y[good])
        held += len(xs[-1])
        if held >= _PAIRS or held and not len(y):
            x, y_met = np.concatenate(xs), np.concatenate(ys)
            yield pa.RecordBatch.from_arrays([pa.array(v) for v in (doc[x], number[x], doc[y_met], number[y_met])],
                                             ["x_doc", "x_line", "y_doc", "y_line"])
            xs, ys, held = [], [], 0
        if wanted is None:
            y = y[~good]
        shift += 1


def _candidates(postings: DataFrame, similarity: float, targets: np.ndarray | None = None) -> DataFrame:
    """Pairs of an earlier line x and a later line y that pass the filters at a word.

    Each y takes the nearest earlier x that passes; with ``targets``, a bit set of lines, every x for
    each y in it.
    """
    sent = postings.sparkSession.sparkContext.broadcast(targets)

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in _meetings(batches):
            yield from _pairs_met(found, similarity, sent.value)

    return (postings.repartition("place").sortWithinPartitions("place")
            .mapInArrow(per_task, "x_doc long, x_line int, y_doc long, y_line int").distinct())


def _verified(pairs: DataFrame, docs: DataFrame, levels: np.ndarray, similarity: float, bits: int,
              least: int) -> DataFrame:
    """Of the candidate pairs those that are similar by their whole sets."""
    ends = pairs.select(F.col("x_doc").alias("doc_id"), F.col("x_line").alias("line_no")).union(
        pairs.select("y_doc", "y_line"))
    sent = docs.sparkSession.sparkContext.broadcast((levels, least, _bit_set(_places(ends), bits)))

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, step_bytes=STEP):
            found = _Lines(batch, *sent.value)
            if len(found.size):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found.doc), pa.array(found.number.astype(np.int32)),
                     _lists(found.tokens, found.begin, found.size)], ["doc", "line", "words"])

    sets = written(docs.select("doc_id", "text").mapInArrow(per_task, "doc long, line int, words array<long>")
                   .dropDuplicates(["doc", "line"]), "line-sets")
    xs = sets.toDF("x_doc", "x_line", "x_words")
    ys = sets.toDF("y_doc", "y_line", "y_words")
    common = F.size(F.array_intersect("x_words", "y_words"))
    return (pairs.join(xs, ["x_doc", "x_line"]).join(ys, ["y_doc", "y_line"])
            .withColumn("common", common)
            .where(F.col("common") >= similarity * (F.size("x_words") + F.size("y_words") - F.col("common")) - 1e-9)
            .select("x_doc", "x_line", "y_doc", "y_line"))


def removed_lines(docs: DataFrame, similarity: float = SIMILARITY, group: int = GROUP,
                  buckets: int = BUCKETS, bits: int = BIT_SET, least_words: int = LEAST_WORDS) -> DataFrame:
    """``(doc_id, line_no)`` of the lines (from 0) that an earlier line is similar to.

    Words are told apart with A-Z in lower case. Lines of fewer than ``least_words`` words stay, as do all lines
    of rows with a NULL doc_id. Rows that repeat a doc_id are one document: their lines of a number
    are decided together and are not copies of each other. NULL texts have no lines; other columns
    are ignored; an empty table gives no rows.
    """
    if not 0.5 <= similarity <= 1:
        raise ValueError("similarity must be between 0.5 and 1")
    with bounded_batches(docs.sparkSession):
        return _removed(docs, similarity, group, buckets, bits, least_words)


def _removed(docs: DataFrame, similarity: float, group: int, buckets: int, bits: int, least_words: int) -> DataFrame:
    """The lines of :func:`removed_lines`; all that takes texts or postings is done when this returns."""
    levels = rarity_levels(docs, buckets)
    prefixes = written(_prefixes(docs, levels, similarity, least_words), "line-prefixes")
    open_prefixes = prefixes.where("prefix IS NOT NULL")
    meeting, later = _short_firsts(open_prefixes.where(F.col("n") < SHORT), similarity)
    going = open_prefixes.where(F.col("n") >= SHORT).unionByName(meeting)
    pairs = written(_candidates(_postings(going, _word_keys, similarity, group), similarity), "line-pairs")
    similar = written(_verified(pairs, docs, levels, similarity, bits, least_words), "similar-lines")
    lines = similar.select(F.col("y_doc").alias("doc_id"), F.col("y_line").alias("line_no")).distinct()
    failed = written(pairs.select(F.col("y_doc").alias("doc_id"), F.col("y_line").alias("line_no")).distinct()
                     .join(lines, ["doc_id", "line_no"], "left_anti"), "unsettled-lines")
    if not failed.isEmpty():
        open_lines = _bit_set(_places(failed), bits)
        keys = written(_keys_of_lines(going, open_lines, similarity), "open-keys")
        key_bits = max(bits, min(KEY_BITS, int(np.log2(keys.count() + 1)) + 6))
        again = _postings(going, _pair_keys, similarity, group, _bit_set(keys, key_bits))
        more = written(_candidates(again, similarity, open_lines)
                       .join(pairs, ["x_doc", "x_line", "y_doc", "y_line"], "left_anti"), "more-pairs")
        found = written(_verified(more, docs, levels, similarity, bits, least_words), "more-similar")
        lines = lines.union(found.select("y_doc", "y_line")).distinct()
    settled = prefixes.where("prefix IS NULL").select("doc_id", "line_no")
    return lines.union(settled).union(later).distinct()


def line_report(docs: DataFrame, similarity: float = SIMILARITY, least_words: int = LEAST_WORDS) -> DataFrame:
    """``(doc_id, n_lines, n_removed, removed)`` for every row: lines, and the numbers of those removed."""
    found = (removed_lines(docs, similarity, least_words=least_words).groupBy("doc_id")
             .agg(F.sort_array(F.collect_list("line_no")).alias("removed")))
    text = F.coalesce("text", F.lit(""))
    breaks = F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n")))
    rows = docs.select("doc_id", (breaks + 1).cast("long").alias("n_lines"))
    removed = F.coalesce("removed", F.array().cast("array<int>"))
    return rows.join(found, "doc_id", "left").select(
        "doc_id", "n_lines", F.size(removed).cast("long").alias("n_removed"), removed.alias("removed"))


def clean(docs: DataFrame, similarity: float = SIMILARITY, least_words: int = LEAST_WORDS) -> DataFrame:
    """``docs`` without the removed lines, all columns as they are; ``n_chars``, if there, is counted anew.

    A document of which no word is left, and had some, goes.
    """
    found = (removed_lines(docs, similarity, least_words=least_words).groupBy("doc_id").agg(F.collect_list("line_no").alias("removed"))
             .select(F.col("doc_id").alias("_removed_doc"), F.col("removed").alias("_removed")))
    joined = docs.join(found, docs["doc_id"] == found["_removed_doc"], "left").drop("_removed_doc")
    names = docs.columns

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            texts = batch.column("text").to_pylist()
            lists = batch.column("_removed").to_pylist()
            keep = []
            for i, (text, numbers) in enumerate(zip(texts, lists)):
                if numbers and text:
                    gone = set(numbers)
                    texts[i] = "\n".join(x for k, x in enumerate(text.split("\n")) if k not in gone)
                    keep.append(bool(texts[i].encode().split()))
                else:
                    keep.append(True)
            columns = {n: batch.column(n) for n in names}
            columns["text"] = pa.array(texts, batch.column("text").type)
            if "n_chars" in columns:
                old = columns["n_chars"].to_pylist()
                columns["n_chars"] = pa.array([len(t) if g and t else o for t, g, o in zip(texts, lists, old)],
                                              batch.column("n_chars").type)
            yield pa.RecordBatch.from_arrays(list(columns.values()), names).filter(pa.array(keep))

    return joined.select(*(docs[n] for n in names), "_removed").mapInArrow(per_task, docs.schema)
