"""Filter interaction audit by count-weighted decision diagrams.

Every document has a failure mask, one bit a filter. Only the counts of the masks of a part go into its
diagram: a level for every filter, a branch for passing and one for failing, equal subdiagrams held once,
and at the ends how many documents (and good and toxic ones) have that mask. An order of the filters is an
order of the levels. All orders are reached one after the other, each by one swap of two neighbouring
levels, which rebuilds the lower of the two alone. In any order the path on which every filter passes
tells the steps: the branch it leaves at a level holds what that filter removes there.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tunemill.llm.common import steps, utf8

FILTERS = "ABCDE"
LEAST_WORDS = 100
LEAST_DISTINCT_PERCENT = 80
MOST_CAPITALS_PERCENT = 10
SYMBOLS = "[#$%&*|]"

_CAPITALS = bytes(range(65, 91))
_COUNTS = ("n", "good", "toxic")
_RESULT = ("part string, filter_order string, step int, kept long, removed long, redundant long, "
           "unique_fails long, good_lost long, toxic_lost long, shapley long")


def adjacent_swaps(size: int) -> Iterator[int]:
    """Places ``i`` so that swapping ``i`` and ``i + 1`` again and again passes through every order once."""
    places, away = list(range(size)), [-1] * size
    while True:
        for value in range(size - 1, -1, -1):
            at = places.index(value)
            to = at + away[value]
            if 0 <= to < size and places[to] < value:
                break
        else:
            return
        places[at], places[to] = places[to], places[at]
        for larger in range(value + 1, size):
            away[larger] = -away[larger]
        yield min(at, to)


class Diagram:
    """Counts of failure masks as a levelled decision diagram whose levels can be swapped.

    ``weights`` gives the counts of a mask (bit ``i`` set: filter ``i`` fails). A node is a pair of places
    in the next level, for passing and for failing; ``sums`` has the counts below every node.
    """

    def __init__(self, size: int, weights: dict[int, tuple[int, ...]]):
        self.order = list(range(size))
        none = tuple(0 for _ in next(iter(weights.values())))
        self.ends: list[tuple[int, ...]] = []
        below = self._numbered([weights.get(mask, none) for mask in range(1 << size)], self.ends)
        self.levels: list[list[tuple[int, int]]] = [[] for _ in range(size)]
        for level in range(size - 1, -1, -1):  # its bit is the highest of the masks still told apart
            half = 1 << level
            below = self._numbered([(below[m], below[m + half]) for m in range(half)], self.levels[level])
        self.sums: list[list[tuple[int, ...]]] = [[] for _ in range(size)] + [self.ends]
        for level in range(size - 1, -1, -1):
            self._sum(level)

    @staticmethod
    def _numbered(values: list, table: list) -> list[int]:
        """The places of ``values`` in ``table``, which gets every distinct one once."""
        known: dict = {}
        for value in values:
            if value not in known:
                known[value] = len(table)
                table.append(value)
        return [known[value] for value in values]

    def _sum(self, level: int) -> None:
        under = self.sums[level + 1]
        self.sums[level] = [tuple(map(sum, zip(under[p], under[f]))) for p, f in self.levels[level]]

    def swap(self, level: int) -> None:
        """Exchange ``level`` and the one under it; nodes above and further down stay as they are."""
        upper, lower = self.levels[level], self.levels[level + 1]
        pairs = [(lower[p][k], lower[f][k]) for p, f in upper for k in (0, 1)]
        self.levels[level + 1] = []
        places = self._numbered(pairs, self.levels[level + 1])
        self.levels[level] = list(zip(places[::2], places[1::2]))
        self.order[level], self.order[level + 1] = self.order[level + 1], self.order[level]
        self._sum(level + 1)

    def path(self) -> Iterator[tuple[int, tuple[int, ...], tuple[int, ...]]]:
        """From the top down, always passing: the filter, the counts that pass it, and those that fail."""
        node = 0
        for level, chosen in enumerate(self.order):
            passing, failing = self.levels[level][node]
            yield chosen, self.sums[level + 1][passing], self.sums[level + 1][failing]
            node = passing


def order_steps(size: int, weights: dict[int, tuple[int, ...]]) -> list[tuple]:
    """``(order, step, kept, removed, redundant, unique_fails, *lost, shapley)`` for every order and step.

    ``lost`` has the other counts of what is removed. A filter that comes first removes all that fail it,
    one that comes last removes what fails nothing else.
    """
    diagram = Diagram(size, weights)
    found = []
    swaps = adjacent_swaps(size)
    while True:
        order = tuple(diagram.order)
        found += [(order, step, kept[0], *lost) for step, (_, kept, lost) in enumerate(diagram.path(), 1)]
        at = next(swaps, None)
        if at is None:
            break
        diagram.swap(at)
    failing, alone, total = {}, {}, dict.fromkeys(range(size), 0)
    for order, step, _, removed, *_ in found:
        chosen = order[step - 1]
        total[chosen] += removed
        if step == 1:
            failing[chosen] = removed
        if step == size:
            alone[chosen] = removed
    rows = []
    for order, step, kept, removed, *lost in found:
        chosen = order[step - 1]
        rows.append((order, step, kept, removed, failing[chosen] - removed, alone[chosen], *lost, total[chosen]))
    return rows


def failure_marks(docs: DataFrame) -> DataFrame:
    """``(doc_id, part, mask, digest)``: filters A to D as bits, and SHA-256 of the text."""
    symbols = re.compile(SYMBOLS.encode())

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            points = pc.fill_null(pc.utf8_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
            masks, digests = [], []
            for text, size in zip(utf8(batch.column("text")), points.tolist()):
                words = text.split()
                capitals = len(text) - len(text.translate(None, _CAPITALS))
                masks.append((len(words) < LEAST_WORDS)
                             | (100 * len(set(words)) < LEAST_DISTINCT_PERCENT * len(words)) << 1
                             | (100 * capitals > MOST_CAPITALS_PERCENT * size) << 2
                             | (symbols.search(text) is not None) << 3)
                digests.append(hashlib.sha256(text).digest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("part"), pa.array(np.array(masks, np.int32)),
                 pa.array(digests, pa.binary())], ["doc_id", "part", "mask", "digest"])

    return (docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), "text")
            .mapInArrow(per_task, "doc_id long, part string, mask int, digest binary"))


def mask_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(part, mask, n, good, toxic)`` over all documents; bit 4 marks a text of a smaller doc_id.

    Of repeated label rows of a document one is enough. Copies are summed up before they meet: a text has
    one row for each part, with what stands at the least id beside it, so no group grows with its copies.
    """
    judged = labels.groupBy("doc_id").agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"),
        F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    sums = [F.sum(c).alias(c) for c in _COUNTS]
    rows = (failure_marks(docs).join(judged, "doc_id", "left")
            .select("doc_id", "digest", "part", "mask", F.lit(1).alias("n"), *(F.coalesce(c, F.lit(0)).alias(c) for c in _COUNTS[1:]))
            .groupBy("doc_id", "digest", "part", "mask").agg(*sums))
    named = F.col("doc_id").isNotNull()
    texts = rows.groupBy("digest", "part", "mask").agg(
        *sums, F.struct(*(F.coalesce(F.sum(F.when(~named, F.col(c))), F.lit(0)).alias(c) for c in _COUNTS)).alias("unnamed"),
        F.min(F.when(named, F.struct("doc_id", *_COUNTS))).alias("least"))
    first = F.min("least.doc_id").over(Window.partitionBy("digest"))  # over the parts of a text
    texts = texts.withColumn("at_first", F.coalesce(F.col("least.doc_id") == first, F.lit(False)))
    texts = texts.withColumn("stay", F.struct(*(
        (F.col("unnamed")[c] + F.when(F.col("at_first"), F.col("least")[c]).otherwise(0)).alias(c) for c in _COUNTS)))
    both = F.array(F.struct(F.col("mask"), *(F.col("stay")[c].alias(c) for c in _COUNTS)),
                   F.struct((F.col("mask") + 16).alias("mask"), *((F.col(c) - F.col("stay")[c]).alias(c) for c in _COUNTS)))
    return texts.select("part", F.inline(both)).where("n > 0").groupBy("part", "mask").agg(*sums)


def order_report(counts: DataFrame, filters: str = FILTERS) -> DataFrame:
    """Steps of every order of ``filters`` for every part of ``counts``: ``(part, mask, n, good, toxic)``.

    A part is a group of at most one row a mask, whatever the number of documents.
    """
    def per_part(rows: pd.DataFrame) -> pd.DataFrame:
        weights = {int(m): tuple(map(int, c)) for m, *c in rows[["mask", *_COUNTS]].itertuples(index=False)}
        found = [("".join(filters[i] for i in order), *rest) for order, *rest in order_steps(len(filters), weights)]
        table = pd.DataFrame(found, columns=["filter_order", "step", "kept", "removed", "redundant",
                                             "unique_fails", "good_lost", "toxic_lost", "shapley"])
        table.insert(0, "part", rows["part"].iloc[0])
        return table

    return counts.groupBy("part").applyInPandas(per_part, _RESULT)


def audited(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row for every part, order of the five filters, and step.

    A NULL text is empty (fails A alone, and E if there is another one of a smaller id), a NULL language
    is the part of the empty string. A NULL doc_id neither fails E nor makes others fail it and has no
    labels; rows that repeat a doc_id all count, and none of them comes before the others. Other
    columns are ignored whatever their names. An empty table gives no rows.
    """
    return order_report(mask_counts(docs, labels))


def audited_sql() -> str:
    """DuckDB SQL for :func:`audited` over ``documents`` and ``labels``."""
    words = r"list_filter(string_split_regex(t, '[ \t-\r]+'), lambda x: x <> '')"
    letters = " ".join(f"CROSS JOIN (SELECT unnest(string_split('{','.join(FILTERS)}', ',')) AS {c}) AS l{c}"
                       for c in "bcde")
    return rf"""
WITH texts AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
firsts AS (SELECT t, min(doc_id) AS first FROM texts GROUP BY t),
judged AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
split AS (SELECT doc_id, part, t, {words} AS ws FROM texts),
marked AS (SELECT s.part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    {{'A': len(ws) < {LEAST_WORDS},
      'B': 100 * len(list_distinct(ws)) < {LEAST_DISTINCT_PERCENT} * len(ws),
      'C': 100 * len(regexp_extract_all(s.t, '[A-Z]')) > {MOST_CAPITALS_PERCENT} * length(s.t),
      'D': regexp_matches(s.t, '{SYMBOLS}'),
      'E': coalesce(s.doc_id > first, false)}} AS fails
    FROM split AS s JOIN firsts USING (t) LEFT JOIN judged ON judged.doc_id = s.doc_id),
masks AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM marked GROUP BY ALL),
orders AS (SELECT a || b || c || d || e AS filter_order
    FROM (SELECT unnest(string_split('{','.join(FILTERS)}', ',')) AS a) AS la {letters}
    WHERE len(list_distinct([a, b, c, d, e])) = 5),
steps AS (SELECT filter_order, unnest(range(1, 6))::INT AS step FROM orders),
told AS (SELECT part, filter_order, step, substr(filter_order, step, 1) AS f, n, good, toxic,
    list_filter(['A', 'B', 'C', 'D', 'E'], lambda x: CASE x WHEN 'A' THEN fails.A WHEN 'B' THEN fails.B
        WHEN 'C' THEN fails.C WHEN 'D' THEN fails.D ELSE fails.E END) AS failed
    FROM masks CROSS JOIN steps),
placed AS (SELECT *, list_contains(failed, f) AS hit,
    len(list_filter(failed, lambda x: strpos(filter_order, x) < step)) = 0 AS here FROM told),
summed AS (SELECT part, filter_order, step, f,
    coalesce(sum(n) FILTER (here AND NOT hit), 0)::BIGINT AS kept,
    coalesce(sum(n) FILTER (here AND hit), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (hit AND NOT here), 0)::BIGINT AS redundant,
    coalesce(sum(n) FILTER (hit AND len(failed) = 1), 0)::BIGINT AS unique_fails,
    coalesce(sum(good) FILTER (here AND hit), 0)::BIGINT AS good_lost,
    coalesce(sum(toxic) FILTER (here AND hit), 0)::BIGINT AS toxic_lost
    FROM placed GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
    (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley
FROM summed"""
