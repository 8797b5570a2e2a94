"""Filter audit against a plain model of every order, and its diagrams against sums over masks."""

import re
from itertools import permutations

import pytest
from hypothesis import given as drawn
from hypothesis import settings
from hypothesis import strategies as st

from tests.llm.brute import docs_of
from tunemill.llm import audit


def plain_report(rows, labels):
    """rows: (doc_id, text, lang); labels: (doc_id, quality, toxic)."""
    least, good, toxic = {}, set(), set()
    for i, text, _ in rows:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    for i, q, t in labels:
        if i is not None:
            good |= {i} if q == 1 else set()
            toxic |= {i} if t == 1 else set()
    parts = {}
    for i, text, lang in rows:
        t = text or ""
        ws = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {f for f, x in zip("ABCDE", (
            len(ws) < 100, 100 * len(set(ws)) < 80 * len(ws), 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
            re.search(r"[#$%&*|]", t), i is not None and t in least and i > least[t])) if x}
        parts.setdefault(lang or "", []).append((fails, i in good, i in toxic))
    out = set()
    for part, docs in parts.items():
        found, total = [], dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = docs
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[0]]
                left = [d for d in left if f not in d[0]]
                total[f] += len(gone)
                found.append((f, "".join(order), step, len(left), len(gone), sum(f in d[0] for d in docs) - len(gone),
                              sum(d[0] == {f} for d in docs), sum(d[1] for d in gone), sum(d[2] for d in gone)))
        out |= {(part, *x[1:], total[x[0]]) for x in found}
    return out


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


WORDS = " ".join(f"word{i}" for i in range(120))
CASES = [(1, WORDS, "en"), (2, WORDS, "en"), (3, WORDS, "fr"), (4, WORDS, "fr"), (4, WORDS, None),
         (None, WORDS, ""), (5, None, "en"), (6, "", "en"), (7, "a a a a", "en"), (8, "ABCDEFG hij", None),
         (9, WORDS.upper() + " #", "en"), (10, "tab\tand\x0bmore\n" * 20_000 + "x|", "de"), (11, "É" * 90 + "ABCDEFGHIJ", "en"),
         (12, "x\x1cy z", "en"), (0, "a a a a", "fr")]
LABELS = [(1, 1, 0), (2, 1, 1), (2, 0, 0), (3, 0, 1), (4, 1, 1), (5, None, 1), (None, 1, 1), (99, 1, 1), (6, 1, 0)]


def test_audit_equals_plain_model(spark):
    docs = docs_of(spark, [(i, t) for i, t, _ in CASES], extra=("mask", "part", "digest", "first", "good"))
    langs = spark.createDataFrame([(n, x) for n, (_, _, x) in enumerate(CASES)], "n int, l string").collect()
    rows = [(*r[:2], langs[n].l, *r[3:]) for n, r in enumerate(docs.collect())]
    docs = spark.createDataFrame(rows, docs.schema)
    labels = labels_of(spark, LABELS)
    got = [tuple(r) for r in audit.audited(docs, labels).collect()]
    assert len(got) == len(set(got)) == 4 * 120 * 5
    assert set(got) == plain_report(CASES, LABELS)


def test_empty_tables(spark):
    docs, labels = docs_of(spark, [(1, "one")]), labels_of(spark, [])
    assert audit.audited(docs.limit(0), labels).collect() == []
    got = audit.audited(docs, labels).collect()
    assert len(got) == 600 and {r.good_lost for r in got} == {0}


@pytest.mark.parametrize("size", [1, 2, 3, 5, 6])
def test_swaps_reach_every_order_once(size):
    order, seen = list(range(size)), {tuple(range(size))}
    for at in audit.adjacent_swaps(size):
        order[at], order[at + 1] = order[at + 1], order[at]
        assert tuple(order) not in seen
        seen.add(tuple(order))
    assert len(seen) == len(list(permutations(range(size))))


@settings(max_examples=60, deadline=None)
@drawn(st.dictionaries(st.integers(0, 15), st.tuples(st.integers(0, 9), st.integers(0, 2)), min_size=1),
       st.lists(st.integers(0, 2), max_size=12))
def test_diagram_after_any_swaps(weights, swaps):
    diagram = audit.Diagram(4, weights)
    for at in swaps:
        diagram.swap(at)
        assert all(len(set(level)) == len(level) for level in diagram.levels)
    done = 0
    for chosen, kept, lost in diagram.path():
        for fails, counts in ((False, kept), (True, lost)):
            want = [w for m, w in weights.items() if not m & done and bool(m >> chosen & 1) == fails]
            assert counts == tuple(sum(w[k] for w in want) for k in (0, 1))
        done |= 1 << chosen


def test_equal_subdiagrams_are_held_once():
    diagram = audit.Diagram(5, {m: (3,) for m in range(32)})
    assert [len(level) for level in diagram.levels] == [1] * 5
