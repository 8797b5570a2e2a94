"""Blocked search against scoring every document, and the bounds that let it skip."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tests.llm.brute import docs_of
from tunemill.llm import ranking

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    return TERM.findall((text or "").translate(lower))


def plain_ranking(docs, items, top):
    counts = [(i, Counter(plain_terms(t))) for i, t in docs]
    sizes = [c.total() for _, c in counts]
    n_docs, length = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(t for _, c in counts for t in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(plain_terms(t))
    out = []
    for item, terms in asked.items():
        scores = []
        for (i, c), n in zip(counts, sizes):
            m = 100 - 50 + 50 * n * n_docs // max(1, length)
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m))
                    for t in terms if c[t])
            if s > 0:
                scores.append((-s, i is None, i))
        out += [(item, r, i, -s) for r, (s, _, i) in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:top], 1)]
    return sorted(out, key=repr)


def items_of(spark, rows):
    return spark.createDataFrame([(i, t, "x") for i, t in rows], "item_id long, text string, query string")


def got(df):
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, df.collect()), key=repr)


def corpus(seed, size=400, languages=4):
    draw = random.Random(seed)
    words = [[f"{'aeiou'[k]}{i}" for i in range(150)] for k in range(languages)]
    text = lambda k, n: " ".join(draw.choice(words[k])[: draw.choice((3, 4))] if draw.random() < 0.9 else "The," for _ in range(n))
    docs = [(i, text(i % languages, draw.randint(0, 90))) for i in range(size)]
    docs += [(size + i, docs[7][1]) for i in range(60)]
    items = [(i, text(i % languages, draw.randint(1, 30)) + " " + docs[i * 3][1][:50]) for i in range(25)]
    return docs, items


@pytest.mark.parametrize("seed, top, block_terms, cell", [(1, 50, 30_000, 256), (2, 3, 30_000, 8), (3, 10, 60, 16)])
def test_ranking_equals_scoring_everything(spark, monkeypatch, seed, top, block_terms, cell):
    monkeypatch.setattr(ranking, "CELL_DOCS", cell)
    docs, items = corpus(seed)
    assert got(ranking.ranked(docs_of(spark, docs), items_of(spark, items), top, block_terms)) == plain_ranking(docs, items, top)


def test_long_queries_have_no_summaries(spark, monkeypatch):
    monkeypatch.setattr(ranking, "LONG", 12)
    docs, items = corpus(4)
    assert got(ranking.ranked(docs_of(spark, docs), items_of(spark, items), 5)) == plain_ranking(docs, items, 5)


def test_odd_rows(spark):
    long = " ".join(f"w{i % 3001}" for i in range(50_000))
    docs = [(1, None), (2, ""), (3, " .,\n"), (4, "Rare É x common"), (4, "Rare É x common"), (None, "rare common"),
            (5, "rare common"), (None, "rare common"), (6, long), (7, "common" * 500_000 + " common rare"), (8, "common " * 30),
            *((10 + i, "common filler") for i in range(30))]
    items = [(1, "RARE, common"), (1, "é X"), (2, None), (3, ""), (4, "absent"), (None, "w5 w7"), (5, "common"), (6, long)]
    frame = docs_of(spark, docs, extra=("terms", "n", "query", "score", "rank", "item_id"))
    assert got(ranking.ranked(frame, items_of(spark, items), 50)) == plain_ranking(docs, items, 50)
    assert ranking.ranked(frame.limit(0), items_of(spark, items)).collect() == []
    assert ranking.ranked(frame, items_of(spark, items).limit(0)).collect() == []


def test_bounds_are_never_under_a_score_and_skip_blocks():
    draw = np.random.default_rng(5)
    size, queries = 60, [sorted(draw.choice(60, draw.integers(1, 12), replace=False).tolist()) for _ in range(30)]
    tables = ranking.query_tables(queries, size)
    dense = draw.integers(0, 1000, (40, size)) * (draw.random((40, size)) < 0.1)
    held = np.flatnonzero(dense.any(axis=0))
    term, row = np.nonzero(dense[:, held].T)
    starts = np.searchsorted(term, np.arange(len(held) + 1))
    _, _, beside_start, beside, _, _ = tables
    summaries = np.concatenate([dense[row[a:z]][:, beside[beside_start[t]:beside_start[t + 1]]].max(axis=0)
                                for t, a, z in zip(held, starts, starts[1:])])
    cell = (np.arange(40), held, starts, row, dense[row, held[term]], summaries)
    for cut in (1, 500, 1500, 2500):
        q, r, s = ranking.cell_scores(cell, tables, np.full(30, cut), False)
        want = {(k, i): int(dense[i, terms].sum()) for k, terms in enumerate(queries) for i in range(40)}
        assert dict(zip(zip(q.tolist(), r.tolist()), s.tolist())) == {k: v for k, v in want.items() if v >= cut}
    few = ranking.cell_scores(cell, tables, np.ones(30, np.int64), True)
    assert 0 < len(few[0]) < len(ranking.cell_scores(cell, tables, np.ones(30, np.int64), False)[0])
