"""Removal of long repeated word sequences, by a compacted de Bruijn graph of word windows.

A window of ``WINDOW`` words is an edge of the graph; its nodes are the windows without the last and the
first word. Only edges that stand twice or more matter. Where every occurrence of an edge is followed by
the same edge, and every occurrence of that one preceded by the first, the node between doesn't branch;
such edges form one path, which all its occurrences run through from end to end. So a path is compacted
from the edges' counts and neighbours alone, joined back to where they stand, and its occurrences can be
compared as wholes: the words at the source coordinates of each give a 128-bit digest, and a path whose
digests differ (a false meeting of hashes) is taken apart into windows that are told by their words.

Edges aren't sent one by one. Of the ``ANCHOR``-word sequences in a window the one of the least hash is
its anchor, so equal windows have equal anchors. A first pass counts anchors (about a tenth of all places),
a second one sends only windows whose anchor stands twice, a run of neighbours with one anchor as one row;
equal runs are summed up before their edges are told apart. Texts meet their spans by a 128-bit key, copies
of a text only once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunemill.llm.common import mixed, runs, signed, small_batches, steps, utf8
from tunemill.session import written

WINDOW = 35
ANCHOR = 16
#: Windows of a run at most; longer ones (periodic texts) are cut.
RUN = 32
#: Bits of a bit set of hashes that tasks test before a join, as a power of two: 4 MB at most.
MOST_BITS = 25
#: Bytes of text that a step takes at once: arrays of some forty times that live for a moment.
STEP = 1 << 19

_WHITE = np.isin(np.arange(256), list(b" \t\n\x0b\x0c\r"))
_BYTE = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407))
_LETTER_STEP = np.uint64(0x9FB21C651E98DF25)
_WORD_STEP = 0xD1342543DE82EF95
_WORD_BACK = pow(_WORD_STEP, -1, 1 << 64)
_TEXT = ["t1", "t2"]
_KEPT = ("doc_id long, t1 long, t2 long, n_words long, n_removed long, kept_sha256 string, "
         "paths array<struct<from:int,to:int,head:long,d1:long,d2:long>>")


def word_hashes(data: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words in UTF-8 bytes, in order; long input is taken in pieces."""
    if len(data) > 2 * STEP:
        gaps = np.flatnonzero(_WHITE[data])
        cuts = np.unique(gaps[np.searchsorted(gaps, np.arange(STEP, len(data), STEP)).clip(max=len(gaps) - 1)]) if len(gaps) else []
        if len(cuts):
            return np.concatenate([word_hashes(p) if len(p) < len(data) else _short_hashes(p)
                                   for p in np.split(data, cuts)])
    return _short_hashes(data)


def _short_hashes(data: np.ndarray) -> np.ndarray:
    at = np.flatnonzero(~_WHITE[data])
    if not len(at):
        return np.zeros(0, np.uint64)
    begin = np.flatnonzero(np.concatenate(([True], np.diff(at) > 1)))
    size = np.diff(np.append(begin, len(at)))
    place = np.arange(len(at)) - np.repeat(begin, size)
    with np.errstate(over="ignore"):
        powers = np.multiply.accumulate(np.concatenate(([np.uint64(1)], np.full(int(size.max()) - 1, _LETTER_STEP))))
        return mixed(np.add.reduceat(_BYTE[data[at]] * powers[place], begin) + size.astype(np.uint64))


def _powers(base: int, count: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(np.concatenate(([np.uint64(1)], np.full(max(0, count - 1), np.uint64(base)))))


def sequence_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of every ``width`` neighbouring words."""
    if len(words) < width:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        sums = np.concatenate(([np.uint64(0)], np.cumsum(words * _powers(_WORD_STEP, len(words)))))
        return mixed((sums[width:] - sums[:-width]) * _powers(_WORD_BACK, len(words) - width + 1))


def sliding(values: np.ndarray, width: int, chosen) -> np.ndarray:
    """``chosen`` (least or greatest) of every ``width`` neighbouring values."""
    have = 1
    while 2 * have <= width and len(values) > have:
        values, have = chosen(values[:-have], values[have:]), 2 * have
    rest = width - have
    return chosen(values[:-rest], values[rest:]) if rest and len(values) > rest else values


class _Windows:
    """The windows of the texts of a step: their hashes, anchors, and whether they lie in one text."""

    def __init__(self, texts: list[bytes], window: int, anchor: int):
        found = [word_hashes(np.frombuffer(t, np.uint8)) for t in texts] if any(len(t) > STEP for t in texts) else None
        if found is None:
            data = np.frombuffer(b"\n".join(texts), np.uint8)
            hashes = word_hashes(data)
            inside = ~_WHITE[data]
            first = inside.copy()
            first[1:] &= ~inside[:-1]
            ends = np.cumsum([len(t) + 1 for t in texts])
            counts = np.diff(np.concatenate(([0], np.cumsum(first)[np.minimum(ends, len(data)) - 1] if len(data) else ends * 0)))
        else:
            hashes, counts = np.concatenate(found), np.array([len(x) for x in found], np.int64)
        self.text = np.repeat(np.arange(len(texts)), counts)
        self.begin = np.cumsum(counts) - counts
        count = max(0, len(hashes) - window + 1)
        self.valid = self.text[:count] == self.text[window - 1:] if count else np.zeros(0, bool)
        self.edges = sequence_hashes(hashes, window)
        self.parts = sequence_hashes(hashes, anchor)
        self.width = window - anchor + 1
        self.anchors = sliding(self.parts, self.width, np.minimum)[:count] if count else np.zeros(0, np.uint64)

    def chosen(self) -> np.ndarray:
        """Hashes that are the anchor of a window, once for every place at which they stand."""
        if not len(self.anchors):
            return self.anchors
        pad = np.zeros(self.width - 1, np.uint64)
        greatest = sliding(np.concatenate((pad, np.where(self.valid, self.anchors, np.uint64(0)), pad)), self.width, np.maximum)
        return self.parts[(self.parts == greatest) & (greatest > 0)]


class Bits:
    """A bit set of hashes with a bounded size: it lets some through that aren't in, and loses none."""

    @staticmethod
    def of(column: DataFrame, most: int = MOST_BITS) -> np.ndarray:
        """The set of the one long column of ``column``; no more than ``2 ** (most - 6)`` rows are fetched."""
        name = column.columns[0]
        size = min(most, max(10, int(16 * column.count()).bit_length()))
        slot = F.col(name).bitwiseAND((1 << size) - 1)
        rows = column.groupBy(F.shiftright(slot, 6).alias("word")).agg(
            F.bit_or(F.expr(f"shiftleft(1L, cast({name} & 63 as int))")).alias("bits")).toArrow()
        words = np.zeros(1 << (size - 6), np.int64)
        words[rows.column("word").to_numpy()] = rows.column("bits").to_numpy()
        return words

    @staticmethod
    def hold(words: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        slot = hashes & np.uint64(64 * len(words) - 1)
        return (words.view(np.uint64)[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63)) & np.uint64(1)) > 0


def repeated_anchors(docs: DataFrame, window: int, anchor: int) -> DataFrame:
    """``(anchor)``: the anchors that stand at two places or more."""
    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, step_bytes=STEP):
            values, counts = np.unique(_Windows(utf8(batch.column("text")), window, anchor).chosen(), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(signed(values)), pa.array(counts)], ["anchor", "n"])

    return (docs.select("text").mapInArrow(per_task, "anchor long, n long")
            .groupBy("anchor").agg(F.sum("n").alias("n")).where("n > 1").select("anchor"))


def _low(hashes: np.ndarray) -> np.ndarray:
    """32 bits of a hash, never 0."""
    return (hashes & np.uint64(0xFFFFFFFF)) | np.uint64(1)


def window_runs(docs: DataFrame, bits, window: int, anchor: int) -> DataFrame:
    """``(t1, t2, at, anchor, link, hashes)``: neighbouring windows with one anchor that ``bits`` holds.

    ``at`` is the first window's place in its text; ``link`` has 32 bits of the window before the run and
    of the one after it, 0 where the text has none.
    """
    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = bits.value
        for batch in steps(batches, step_bytes=STEP):
            found = _Windows(utf8(batch.column("text")), window, anchor)
            use = np.flatnonzero(found.valid)
            use = use[Bits.hold(held, found.anchors[use])]
            if not len(use):
                continue
            anchors, text = found.anchors[use], found.text[use]
            new = np.concatenate(([True], (np.diff(use) > 1) | (anchors[1:] != anchors[:-1]) | (text[1:] != text[:-1])))
            begin = np.flatnonzero(new)
            size = np.diff(np.append(begin, len(use)))
            new |= (np.arange(len(use)) - np.repeat(begin, size)) % RUN == 0
            begin = np.flatnonzero(new)
            last = np.append(begin[1:], len(use)) - 1
            first, after, owner = use[begin], use[last] + 1, text[begin]
            none = np.uint64(0)
            has_before = (first > found.begin[owner])
            has_after = (after < len(found.valid)) & found.valid[np.minimum(after, len(found.valid) - 1)] \
                & (found.text[np.minimum(after, len(found.valid) - 1)] == owner)
            before = np.where(has_before, _low(found.edges[np.maximum(first - 1, 0)]), none)
            follows = np.where(has_after, _low(found.edges[np.minimum(after, len(found.edges) - 1)]), none)
            rows = pa.array(owner)
            yield pa.RecordBatch.from_arrays([
                batch.column("t1").take(rows), batch.column("t2").take(rows),
                pa.array((first - found.begin[owner]).astype(np.int32)), pa.array(signed(anchors[begin])),
                pa.array(signed(before << np.uint64(32) | follows)),
                pa.ListArray.from_arrays(pa.array(np.append(begin, len(use)).astype(np.int32)), pa.array(signed(found.edges[use]))),
            ], ["t1", "t2", "at", "anchor", "link", "hashes"])

    return docs.select(*_TEXT, "text").mapInArrow(
        per_task, "t1 long, t2 long, at int, anchor long, link long, hashes array<long>")


def _edges_of(kinds: DataFrame) -> DataFrame:
    """``(anchor, run, place, edge, n, same, any)``: the edges of distinct runs with their neighbours' bits."""
    def bits(link: str):
        half = lambda h: h.bitwiseAND(0xFFFFFFFF).bitwiseOR(F.lit(1))
        at = lambda i: F.get("hashes", i)
        return lambda i: (
            F.shiftleft(F.when(i > 0, half(at(F.greatest(i - 1, F.lit(0))))).otherwise(F.shiftrightunsigned(link, 32)), 32)
            .bitwiseOR(F.when(i < F.size("hashes") - 1, half(at(i + 1))).otherwise(F.col(link).bitwiseAND(0xFFFFFFFF))))

    same, any_ = bits("same"), bits("any")
    return kinds.select("anchor", "run", "n", F.inline(F.transform("hashes", lambda h, i: F.struct(
        i.alias("place"), h.alias("edge"), same(i).alias("same_link"), any_(i).alias("any_link")))))


def path_pieces(kinds: DataFrame) -> DataFrame:
    """``(anchor, run, first, last, head, left, right)``: what repeated paths cover of distinct runs.

    ``left`` and ``right`` say that the path may go on beyond the run.
    """
    edges = _edges_of(kinds)
    apart = F.expr("bit_and(same_link) ^ bit_or(any_link)")
    repeated = edges.groupBy("edge").agg(F.sum("n").alias("n"), apart.alias("apart")).where("n > 1").select(
        "edge", (F.shiftrightunsigned("apart", 32) == 0).alias("left"),
        (F.col("apart").bitwiseAND(0xFFFFFFFF) == 0).alias("right"))
    marked = (edges.select("anchor", "run", "place", "edge").join(repeated, "edge")
              .groupBy("anchor", "run").agg(F.sort_array(F.collect_list(
                  F.struct("place", "edge", "left", "right"))).alias("marks")))  # RUN of them at most

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = batch.column("marks")
            row = np.repeat(np.arange(batch.num_rows), np.diff(marks.offsets.to_numpy()))
            place, edge, left, right = (marks.flatten().field(k).to_numpy(zero_copy_only=False) for k in range(4))
            if not len(row):
                continue
            new = np.ones(len(row), bool)
            new[1:] = (row[1:] != row[:-1]) | (place[1:] != place[:-1] + 1) | ~(right[:-1] & left[1:])
            begin = np.flatnonzero(new)
            last = np.append(begin[1:], len(row)) - 1
            rows = pa.array(row[begin])
            yield pa.RecordBatch.from_arrays([
                batch.column("anchor").take(rows), batch.column("run").take(rows), pa.array(place[begin]),
                pa.array(place[last]), pa.array(edge[begin]), pa.array(left[begin]), pa.array(right[last])],
                ["anchor", "run", "first", "last", "head", "left", "right"])

    return marked.mapInArrow(per_task, "anchor long, run long, first int, last int, head long, left boolean, right boolean")


def _by_text(pieces: DataFrame) -> DataFrame:
    """``(t1, t2, spans)``: all pieces of a text, which are no more than its words."""
    return pieces.groupBy(*_TEXT).agg(F.collect_list(F.struct("from", "to", "head", "left", "right")).alias("spans"))


def repeated_spans(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """``(t1, t2, spans)`` for every distinct text with windows that stand elsewhere too.

    A span is a piece of a path: first and last window, the edge that heads the path, and whether it goes on.
    """
    spark = docs.sparkSession
    anchors = written(repeated_anchors(docs, window, anchor), "anchors")
    bits = spark.sparkContext.broadcast(Bits.of(anchors))
    places = written(window_runs(docs, bits, window, anchor).withColumn("run", F.xxhash64("hashes")), "window-runs")
    kinds = written(places.groupBy("anchor", "run", "hashes").agg(
        F.count("*").alias("n"), F.bit_and("link").alias("same"), F.bit_or("link").alias("any"))
        .join(anchors, "anchor", "left_semi"), "distinct-runs")
    bits.unpersist()
    pieces = written(path_pieces(kinds), "path-pieces")
    at = F.col("at")
    return _by_text(places.select(*_TEXT, "at", "anchor", "run").join(pieces, ["anchor", "run"]).select(
        *_TEXT, (at + F.col("first")).alias("from"), (at + F.col("last")).alias("to"), "head", "left", "right").distinct())


def text_paths(spans: list[dict]) -> list[tuple[int, int, int]]:
    """First window, last window and head of every path of a text, from its pieces."""
    found: list[list] = []
    goes_on = False
    for span in sorted(spans, key=lambda s: s["from"]):
        if found and goes_on and span["left"] and span["from"] == found[-1][1] + 1:
            found[-1][1] = span["to"]
        else:
            found.append([span["from"], span["to"], span["head"]])
        goes_on = span["right"]
    return [tuple(f) for f in found]


def span_digest(words: list[bytes]) -> tuple[int, int]:
    """128 bits that tell a word sequence."""
    found = np.frombuffer(hashlib.blake2b(b" ".join(words), digest_size=16).digest(), np.int64)
    return int(found[0]), int(found[1])


def without_spans(rows: DataFrame, window: int) -> DataFrame:
    """Counts, the digest of the words that stay, and the paths with their digests, of ``rows`` with their ``spans``."""
    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, step_bytes=STEP):
            out = {name: [] for name in ("n_words", "n_removed", "kept_sha256", "paths")}
            for text, spans in zip(utf8(batch.column("text")), batch.column("spans").to_pylist()):
                words = text.split()
                paths = [] if not spans else [
                    dict(zip(("from", "to", "head", "d1", "d2"), (a, z, head, *span_digest(words[a:z + window]))))
                    for a, z, head in text_paths(spans)]
                kept, done = [], 0
                for path in paths:  # in order of their first words
                    kept += words[done:path["from"]]
                    done = max(done, path["to"] + window)
                kept += words[done:]
                out["n_words"].append(len(words))
                out["n_removed"].append(len(words) - len(kept))
                out["kept_sha256"].append(hashlib.sha256(b" ".join(kept)).hexdigest())
                out["paths"].append(paths)
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct(
                [("from", pa.int32()), ("to", pa.int32()), ("head", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64())])))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("t1"), batch.column("t2"),
                 *(pa.array(v, k) for v, k in zip(out.values(), kinds))], ["doc_id", "t1", "t2", *out])

    return rows.select("doc_id", *_TEXT, "text", "spans").mapInArrow(per_task, _KEPT)


def _member(words: np.ndarray, spark) -> Column:
    held = spark.sparkContext.broadcast(words)

    @F.pandas_udf("boolean")
    def inside(keys: pd.Series) -> pd.Series:
        return pd.Series(Bits.hold(held.value, keys.to_numpy(np.int64).view(np.uint64)))

    return inside("t1")


def _taken_apart(docs: DataFrame, kept: DataFrame, heads: DataFrame, window: int) -> DataFrame:
    """Rows of the texts that hold a path of ``heads``, whose windows are told by their words."""
    paths = kept.select(*_TEXT, F.inline("paths")).select(*_TEXT, "from", "to", "head")
    texts = written(paths.join(heads, "head", "left_semi").select(*_TEXT).distinct(), "doubtful-texts")
    paths = paths.join(texts, _TEXT, "left_semi").distinct()
    doubtful = _by_text(paths.join(heads, "head", "left_semi").withColumns(
        {"left": F.lit(False), "right": F.lit(False)}))

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, step_bytes=STEP):
            for row, (text, spans) in enumerate(zip(utf8(batch.column("text")), batch.column("spans").to_pylist())):
                words = text.split()
                at = [i for span in spans for i in range(span["from"], span["to"] + 1)]
                found = np.array([span_digest(words[i:i + window]) for i in at], np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(np.full(len(at), batch.column(c)[row].as_py(), np.int64)) for c in _TEXT),
                     pa.array(at, pa.int32()), pa.array(found[:, 0]), pa.array(found[:, 1])], [*_TEXT, "from", "d1", "d2"])

    windows = written(docs.join(doubtful, _TEXT).select(*_TEXT, "text", "spans").mapInArrow(
        per_task, "t1 long, t2 long, from int, d1 long, d2 long"), "doubtful-windows")
    twice = windows.groupBy("d1", "d2").agg(F.count("*").alias("n")).where("n > 1")
    told = windows.join(twice, ["d1", "d2"], "left_semi").select(
        *_TEXT, "from", F.col("from").alias("to"), F.col("d1").alias("head"))
    spans = _by_text(told.union(paths.join(heads, "head", "left_anti").select(*_TEXT, "from", "to", "head"))
                     .distinct().withColumns({"left": F.lit(False), "right": F.lit(False)}))
    redone = without_spans(docs.join(texts, _TEXT, "left_semi").join(spans, _TEXT, "left"), window)
    return redone.union(kept.join(texts, _TEXT, "left_anti").select(*redone.columns))


def deduplicated(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept_sha256)`` for every row of ``docs``.

    Each word goes that is covered by ``window`` neighbouring words which also start anywhere else, in the
    same row, in another one, or in a row that repeats the doc_id; windows are judged on the input. NULL
    and empty texts have no words and the digest of nothing; texts shorter than a window keep all words.
    A NULL doc_id is an id like any other. Other columns are ignored whatever their names. An empty table
    gives no rows. ``anchor`` must be under ``window``.
    """
    if not 0 < anchor < window:
        raise ValueError("anchor must be under window")
    with small_batches(docs.sparkSession):
        return _deduplicated(docs, window, anchor)


def _deduplicated(docs: DataFrame, window: int, anchor: int) -> DataFrame:
    spark = docs.sparkSession
    text = F.coalesce("text", F.lit(""))
    keyed = docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("t1"), F.xxhash64(F.lit(1), text).alias("t2"))
    spans = written(repeated_spans(keyed, window, anchor), "text-spans")
    inside = _member(Bits.of(spans.select("t1")), spark)
    none = F.lit(None).cast(spans.schema["spans"].dataType)
    kept = written(without_spans(keyed.where(~inside).withColumn("spans", none), window).union(
        without_spans(keyed.where(inside).join(spans, _TEXT, "left"), window)), "kept-words")
    told = kept.select(F.inline("paths")).groupBy("head").agg(
        *(f(c).alias(f.__name__ + c) for f in (F.min, F.max) for c in ("d1", "d2")))
    heads = written(told.where("mind1 <> maxd1 OR mind2 <> maxd2").select("head"), "false-paths")
    if not heads.isEmpty():
        kept = written(_taken_apart(keyed, kept, heads, window), "kept-words")
    return kept.select("doc_id", "n_words", "n_removed", "kept_sha256")


def deduplicated_sql(window: int = WINDOW) -> str:
    """DuckDB SQL for :func:`deduplicated` over ``documents``."""
    return rf"""
WITH texts AS (SELECT row_number() OVER () AS r, doc_id,
    list_filter(string_split_regex(coalesce(text, ''), '[ \t-\r]+'), lambda x: x <> '') AS ws FROM documents),
starts AS (SELECT r, unnest(range(1, len(ws) - {window} + 2))::BIGINT AS i, ws FROM texts WHERE len(ws) >= {window}),
repeated AS (SELECT r, i FROM (SELECT r, i, array_to_string(ws[i:i + {window - 1}], ' ') AS w FROM starts)
    QUALIFY count(*) OVER (PARTITION BY w) > 1),
covered AS (SELECT DISTINCT r, i + s AS i FROM repeated, range({window}) AS g(s)),
words AS (SELECT r, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS i FROM texts),
kept AS (SELECT r, string_agg(w, ' ' ORDER BY i) AS t, count(*) AS n
    FROM words LEFT JOIN covered USING (r, i) WHERE covered.r IS NULL GROUP BY r)
SELECT doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed,
    sha256(coalesce(t, '')) AS kept_sha256
FROM texts LEFT JOIN kept USING (r)"""
