"""Ranked lexical search over posting lists that are blocked by the similarity of their documents.

Documents are put in order by the signs of random projections of their term impacts, and cut into cells
of alike documents. The part of a term's posting list in a cell is a block, so every list is clustered
in the same geometry. A block stores its summary: for each term that stands beside its own term in some
query, the greatest impact in any of its documents. The sum of a summary over a query's terms is no less
than the score of any document of the block, and a block is passed over only if that sum is under the
score of the query's last place so far. All numbers are 64-bit integers, so bounds and scores are exact.

Queries are taken in blocks with a bounded number of terms; what tasks are sent grows with such a block
and not with the documents. Two passes read the cells: the first scores the best block of each query in
each cell, which gives every query a score that its last place can't be under; the second does the rest.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tunemill.llm.common import mixed, steps, utf8
from tunemill.session import written

TOP = 50
#: Terms of all queries of one block together, repeats included (a query is never cut).
BLOCK_TERMS = 30_000
#: Queries of more terms have no summaries: all blocks of their terms are scored.
LONG = 300
#: Documents (65,536 at most) and postings of a cell at most; a cell has one document at least.
CELL_DOCS = 256
CELL_POSTINGS = 32_768
PROJECTIONS = 30

_TERM = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256))
_VECTOR = "doc_id long, n long, terms array<int>, tfs array<int>"
_CELL_NAMES = ["docs", "n", "terms", "starts", "rows", "tfs", "filled", "tops"]
_CELL = "docs array<long>, " + ", ".join(f"{name} binary" for name in _CELL_NAMES[1:])
_FOUND = "query int, doc_id long, score long"


def terms_of(text: bytes) -> list[bytes]:
    """Terms of a text in order: letters (A-Z as lower case), digits and all that isn't ASCII."""
    return text.translate(_TERM).split()


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All numbers of the ranges that begin at ``starts``."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(int(ends[-1]) if len(ends) else 0)


def query_terms(items: DataFrame) -> DataFrame:
    """``(item_id, terms)``: the distinct terms of each item; rows that repeat an item_id are one item."""
    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            terms = [[t.decode() for t in set(terms_of(text))] for text in utf8(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("item_id"), pa.array(terms, pa.list_(pa.string()))], ["item_id", "terms"])

    return (items.select("item_id", "text").mapInArrow(per_task, "item_id long, terms array<string>")
            .groupBy("item_id").agg(F.array_distinct(F.flatten(F.collect_list("terms"))).alias("terms")))


def vectors(docs: DataFrame, vocabulary) -> DataFrame:
    """``(doc_id, n, terms, tfs)``: number of all terms, and the terms of ``vocabulary`` as numbers with their counts."""
    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = vocabulary.value
        for batch in steps(batches):
            sizes, starts, terms, tfs = [], [0], [], []
            for text in utf8(batch.column("text")):
                words = terms_of(text)
                counts = Counter(map(number.get, words))
                counts.pop(None, None)
                sizes.append(len(words))
                terms += counts.keys()
                tfs += counts.values()
                starts.append(len(terms))
            offsets = pa.array(starts, pa.int32())
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(sizes, pa.int64()),
                pa.ListArray.from_arrays(offsets, pa.array(terms, pa.int32())),
                pa.ListArray.from_arrays(offsets, pa.array(tfs, pa.int32()))], ["doc_id", "n", "terms", "tfs"])

    return docs.select("doc_id", "text").mapInArrow(per_task, _VECTOR)


def document_counts(rows: DataFrame, size: int) -> np.ndarray:
    """How many of ``rows`` hold each of ``size`` terms."""
    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(size, np.int64)
        for batch in batches:
            sums += np.bincount(batch.column("terms").flatten().to_numpy(), minlength=size)
        held = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array(sums[held])], ["term", "n"])

    found = rows.select("terms").mapInArrow(per_task, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(size, np.int64)
    counts[found.column("term").to_numpy()] = found.column("n").to_numpy()
    return counts


def impact(weight: np.ndarray, tf: np.ndarray, n: np.ndarray, documents: int, length: int) -> np.ndarray:
    """What a term adds to the score of a document of ``n`` terms."""
    m = 100 - 50 + (50 * n * documents) // max(1, length)
    return weight * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))


def query_tables(queries: list[list[int]], size: int) -> tuple[np.ndarray, ...]:
    """Arrays that tasks search with, by term number below ``size``.

    For each term the queries that hold it (``pair_start, pair_query``) and the terms it stands beside
    (``beside_start, beside``); for each such pair the places of the query's terms among those
    (``place_start, place``), none if the query is long.
    """
    lengths = np.array([len(q) for q in queries], np.int64)
    query = np.repeat(np.arange(len(queries)), lengths)
    term = np.array([t for q in queries for t in sorted(q)], np.int64)
    begin = np.cumsum(lengths) - lengths
    order = np.argsort(term, kind="stable")
    pair_query, pair_term = query[order], term[order]
    pair_start = np.searchsorted(pair_term, np.arange(size + 1))
    short = lengths[pair_query] <= LONG
    sizes = np.where(short, lengths[pair_query], 0)
    owner = np.repeat(pair_term, sizes)
    near = term[_spread(begin[pair_query], sizes)]
    joint, place = np.unique(owner * size + near, return_inverse=True)
    beside_start = np.searchsorted(joint, np.arange(size + 1) * size)
    place = place.reshape(-1) - beside_start[owner]
    return (pair_start, pair_query, beside_start, joint % max(1, size), np.concatenate(([0], np.cumsum(sizes))), place)


def in_order(rows: DataFrame, weights: np.ndarray, documents: int, length: int) -> DataFrame:
    """``rows`` with a term, alike ones together: sorted by the signs of projections of their impacts."""
    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = np.arange(len(weights), dtype=np.uint64)
        for batch in batches:
            sizes = np.diff(batch.column("terms").offsets.to_numpy())
            row, term = np.repeat(np.arange(batch.num_rows), sizes), batch.column("terms").flatten().to_numpy()
            value = impact(weights[term], batch.column("tfs").flatten().to_numpy().astype(np.int64),
                           batch.column("n").to_numpy()[row], documents, length).astype(np.float64)
            place = np.zeros(batch.num_rows, np.int64)
            for k in range(PROJECTIONS):
                with np.errstate(over="ignore"):
                    sign = np.where(mixed(numbers + np.uint64(k + 1) * np.uint64(0x9E3779B97F4A7C15)) & np.uint64(1), 1.0, -1.0)
                place = 2 * place + (np.bincount(row, value * sign[term], batch.num_rows) > 0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(place)], [*batch.schema.names, "place"])

    placed = rows.where("size(terms) > 0").mapInArrow(per_task, _VECTOR + ", place long")
    return placed.repartitionByRange("place", "doc_id").sortWithinPartitions("place", "doc_id").drop("place")


def _opened(docs, n, terms, starts, rows, tfs, scale: tuple) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Impacts of a cell's postings, as a list and as a table with a last column of zeros; columns by term number."""
    weights, documents, length = scale
    rows = rows.astype(np.int64)
    value = impact(np.repeat(weights[terms], np.diff(starts)), tfs.astype(np.int64), n[rows], documents, length)
    column = np.full(len(weights), len(terms), np.int64)
    column[terms] = np.arange(len(terms))
    table = np.zeros((len(docs), len(terms) + 1), np.int64)
    table[rows, np.repeat(np.arange(len(terms)), np.diff(starts))] = value
    return value, table, column


def cells(rows: DataFrame, scale, tables) -> DataFrame:
    """The index: a row for each cell with the posting lists of its terms and a summary for every block.

    A term's postings are ``rows`` and ``tfs`` from its place in ``starts`` on. Its summary has a number for
    each term beside it: ``filled`` has a bit for each that isn't 0, and for those ``tops`` has the row
    whose impact is the greatest. All but the ids are the bytes of arrays.
    """
    def cell(docs: list, n: np.ndarray, sizes: np.ndarray, term: np.ndarray, tf: np.ndarray) -> list:
        _, _, beside_start, beside, _, _ = tables.value
        row = np.repeat(np.arange(len(docs)), sizes)
        order = np.lexsort((row, term))
        row, term, tf = row[order], term[order], tf[order]
        held, starts = np.unique(term, return_index=True)
        starts = np.append(starts, len(term))
        _, table, column = _opened(docs, n, held, starts, row, tf, scale.value)
        table = np.where(table > 0, table << 16 | np.arange(len(docs))[:, None], 0)  # the impact, and whose it is
        filled, tops = [], []
        for t, a, z in zip(held.tolist(), starts, starts[1:]):
            best = table[row[a:z, None], column[beside[beside_start[t]:beside_start[t + 1]]][None, :]].max(axis=0)
            filled.append(best > 0)
            tops.append(best[best > 0] & 0xFFFF)
        return [docs, *(a.astype(kind).tobytes() for a, kind in (
            (n, np.int64), (held, np.int32), (starts, np.int32), (row, np.uint16), (tf, np.int32),
            (np.packbits(np.concatenate(filled)), np.uint8), (np.concatenate(tops), np.uint16)))]

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs, n, sizes, terms, tfs, held = [], [], [], [], [], 0
        kinds = [pa.list_(pa.int64()), *[pa.binary()] * 7]

        def full():
            made = cell(docs, np.array(n, np.int64), np.array(sizes, np.int64), np.concatenate(terms), np.concatenate(tfs))
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(made, kinds)], _CELL_NAMES)

        for batch in batches:
            offsets = batch.column("terms").offsets.to_numpy()
            offsets = offsets - offsets[0]
            term = batch.column("terms").flatten().to_numpy()
            tf = batch.column("tfs").flatten().to_numpy()
            for doc, size, a, z in zip(batch.column("doc_id").to_pylist(), batch.column("n").to_pylist(),
                                       offsets.tolist(), offsets[1:].tolist()):
                if docs and (len(docs) == CELL_DOCS or held + z - a > CELL_POSTINGS):
                    yield full()
                    docs, n, sizes, terms, tfs, held = [], [], [], [], [], 0
                docs.append(doc)
                n.append(size)
                sizes.append(z - a)
                terms.append(term[a:z])
                tfs.append(tf[a:z])
                held += z - a
        if docs:
            yield full()

    return rows.mapInArrow(per_task, _CELL)


def _read_cell(batch: pa.RecordBatch, i: int, scale: tuple, tables: tuple) -> tuple:
    """The ids of a cell, and what :func:`cell_scores` takes."""
    _, _, beside_start, beside, _, _ = tables
    kinds = (np.int64, np.int32, np.int32, np.uint16, np.int32, np.uint8, np.uint16)
    n, terms, starts, rows, tfs, filled, tops = (
        np.frombuffer(batch.column(k)[i].as_py(), kind) for k, kind in enumerate(kinds, 1))
    value, table, column = _opened(n, n, terms, starts, rows, tfs, scale)
    width = beside_start[terms + 1] - beside_start[terms]
    summaries = np.zeros(int(width.sum()), np.int64)
    filled = np.unpackbits(filled, count=len(summaries)).view(bool)
    summaries[filled] = table[tops, column[beside[_spread(beside_start[terms], width)[filled]]]]
    return batch.column(0)[i].values, (n, terms, starts, rows.astype(np.int64), value, summaries)


def cell_scores(held: tuple, tables: tuple, least: np.ndarray, best_only: bool) -> tuple[np.ndarray, ...]:
    """``(query, row, score)`` of the documents of a cell (``docs`` has one entry each) that reach ``least`` of the query, from blocks that may hold one.

    With ``best_only`` just the block of the highest bound is looked into for every query.
    """
    docs, terms, starts, rows, impacts, summaries = held
    pair_start, pair_query, beside_start, _, place_start, place = tables
    count = pair_start[terms + 1] - pair_start[terms]
    pair = _spread(pair_start[terms], count)
    block = np.repeat(np.arange(len(terms)), count)
    query = pair_query[pair]
    # bounds: the sum of the block's summary over the terms of the query
    width = beside_start[terms + 1] - beside_start[terms]
    base = np.cumsum(width) - width
    sizes = place_start[pair + 1] - place_start[pair]
    whole = sizes == 0  # long queries
    at = place[_spread(place_start[pair], sizes)] + np.repeat(base[block], sizes)
    sums = np.concatenate(([0], np.cumsum(summaries[at])))
    ends = np.cumsum(sizes)
    bound = sums[ends] - sums[ends - sizes]
    if best_only:
        order = np.lexsort((-bound, query))
        keep = np.zeros(len(pair), bool)
        keep[order[np.concatenate(([True], np.diff(query[order]) != 0))[:len(order)]]] = True
        keep &= whole | (bound >= least[query])
    else:
        keep = whole | (bound >= least[query])
    if not keep.any():
        return (np.zeros(0, np.int64),) * 3
    live = np.unique(query[keep])
    local = np.full(len(least), -1)
    local[live] = np.arange(len(live))
    n = len(docs)
    looked = np.zeros(len(live) * n, bool)
    size = starts[block + 1] - starts[block]
    spots = _spread(starts[block[keep]], size[keep])
    looked[np.repeat(local[query[keep]], size[keep]) * n + rows[spots]] = True
    use = local[query] >= 0
    spots = _spread(starts[block[use]], size[use])
    scores = np.bincount(np.repeat(local[query[use]], size[use]) * n + rows[spots],
                         impacts[spots].astype(np.float64), len(live) * n).astype(np.int64)  # whole numbers under 2**53
    found = np.flatnonzero(looked & (scores > 0))
    found = found[scores[found] >= least[live[found // n]]]
    return live[found // n], found % n, scores[found]


def searched(index: DataFrame, scale, tables, least, top: int, best_only: bool = False) -> DataFrame:
    """``(query, doc_id, score)``: of each task the ``top`` best documents of every query, ties by doc_id, NULL last."""
    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds, arrays = least.value.copy(), tables.value
        query, score = np.zeros(0, np.int64), np.zeros(0, np.int64)
        doc, none = np.zeros(0, np.int64), np.zeros(0, bool)
        waiting: list[tuple] = []

        def settled():
            nonlocal query, score, doc, none, waiting
            query, score, doc, none = (np.concatenate(x) for x in zip((query, score, doc, none), *waiting))
            waiting = []
            order = np.lexsort((doc, none, -score, query))
            query, score, doc, none = query[order], score[order], doc[order], none[order]
            begin = np.searchsorted(query, query)
            place = np.arange(len(query)) - begin
            last = place == top - 1
            bounds[query[last]] = np.maximum(bounds[query[last]], score[last])
            keep = place < top
            query, score, doc, none = query[keep], score[keep], doc[keep], none[keep]

        for batch in batches:
            for i in range(batch.num_rows):
                ids, held = _read_cell(batch, i, scale.value, arrays)
                q, row, s = cell_scores(held, arrays, bounds, best_only)
                if len(q):
                    found = ids.take(pa.array(row))
                    waiting.append((q, s, found.fill_null(0).to_numpy(zero_copy_only=False),
                                    found.is_null().to_numpy(zero_copy_only=False)))
                    if sum(len(w[0]) for w in waiting) > 20_000 or best_only:
                        settled()
        settled()
        yield pa.RecordBatch.from_arrays(
            [pa.array(query.astype(np.int32)), pa.array(doc, pa.int64(), mask=none), pa.array(score)], ["query", "doc_id", "score"])

    return index.mapInArrow(per_task, _FOUND)


def _best(found: DataFrame, top: int) -> DataFrame:
    by = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= top)


def _ranked_block(docs: DataFrame, queries: list[tuple], top: int) -> DataFrame:
    """``(query, rank, doc_id, score)`` for a block of queries: ``(item_id, terms)``."""
    spark = docs.sparkSession
    number = {t: i for i, t in enumerate(sorted({t for _, terms in queries for t in terms}))}
    vocabulary = spark.sparkContext.broadcast({t.encode(): i for t, i in number.items()})
    rows = written(vectors(docs, vocabulary), "term-vectors")
    documents, length = rows.agg(F.count(F.when(F.col("n") > 0, 1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = document_counts(rows, len(number))
    weights = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
    tables = spark.sparkContext.broadcast(query_tables([[number[t] for t in terms] for _, terms in queries], len(number)))
    scale = spark.sparkContext.broadcast((weights, documents, length))
    index = written(cells(in_order(rows, weights, documents, length), scale, tables), "cells")
    least = np.ones(len(queries), np.int64)
    first = _best(searched(index, scale, tables, spark.sparkContext.broadcast(least), top, best_only=True), top)
    for row in first.where(F.col("rank") == top).select("query", "score").collect():  # one a query at most
        least[row["query"]] = row["score"]
    return _best(searched(index, scale, tables, spark.sparkContext.broadcast(least), top), top)


def ranked(docs: DataFrame, items: DataFrame, top: int = TOP, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the ``top`` documents of the highest scores above 0 for every item.

    Equal scores go by ascending doc_id, a NULL doc_id comes last; rows that repeat a doc_id have a rank
    each. Rows that repeat an item_id are one item with the terms of all of them, NULL ids included. NULL
    and empty texts have no terms: such documents don't count and are never found, such items find
    nothing. Other columns are ignored whatever their names. Empty tables give no rows.
    """
    spark = docs.sparkSession
    asked = written(query_terms(items).where("size(terms) > 0"), "query-terms")
    slots = asked.agg(F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()[0]
    blocks = max(1, math.ceil(slots / block_terms))
    found = None
    for block in range(blocks):
        queries = [(r["item_id"], r["terms"]) for r in asked.where(
            F.pmod(F.coalesce(F.xxhash64("item_id"), F.lit(0)), F.lit(blocks)) == block).collect()]
        if not queries:
            continue
        names = spark.createDataFrame([(i, q[0]) for i, q in enumerate(queries)], "query int, item_id long")
        part = written(_ranked_block(docs, queries, top), "ranked").join(F.broadcast(names), "query").select(
            "item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
        found = part if found is None else found.union(part)
    return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long") if found is None else found


def ranked_sql(top: int = TOP) -> str:
    """DuckDB SQL for :func:`ranked` of ``documents`` by ``benchmark``."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    terms = (rf"regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), "
             r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')")
    return rf"""
WITH texts AS (SELECT row_number() OVER () AS r, doc_id, {terms} AS ts FROM documents),
sizes AS (SELECT count(*) FILTER (len(ts) > 0) AS docs, coalesce(sum(len(ts)), 0)::BIGINT AS total FROM texts),
asked AS (SELECT DISTINCT item_id, unnest({terms}) AS term FROM benchmark),
counted AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(ts) AS term FROM texts)
    WHERE term IN (SELECT term FROM asked) GROUP BY r, term),
weighed AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
    FROM counted, sizes GROUP BY term, docs),
impacts AS (SELECT r, doc_id, term,
    w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * len(ts) * docs) // total))) AS impact
    FROM counted JOIN weighed USING (term) JOIN texts USING (r), sizes),
scored AS (SELECT item_id, r, doc_id, sum(impact)::BIGINT AS score
    FROM asked JOIN impacts USING (term) GROUP BY item_id, r, doc_id)
SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id ASC NULLS LAST))::INT AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= {top}"""
