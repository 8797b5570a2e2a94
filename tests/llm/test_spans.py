"""Removal of repeated sequences against plain counting of windows, also with hashes that meet falsely."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from tests.llm.brute import docs_of
from tunemill.llm import spans


def plain_rows(rows, window):
    split = [(i, (t or "").encode().split()) for i, t in rows]
    found = Counter(tuple(ws[k:k + window]) for _, ws in split for k in range(len(ws) - window + 1))
    out = []
    for i, ws in split:
        gone = {k + s for k in range(len(ws) - window + 1) if found[tuple(ws[k:k + window])] > 1 for s in range(window)}
        kept = b" ".join(w for k, w in enumerate(ws) if k not in gone)
        out.append((i, len(ws), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def got(df):
    assert df.columns == ["doc_id", "n_words", "n_removed", "kept_sha256"]
    return sorted(map(tuple, df.collect()), key=repr)


def corpus(seed, size=60, vocabulary=6):
    """Texts over a small vocabulary with passages they share, copies, periods and odd blanks."""
    draw = random.Random(seed)
    word = lambda: "w" * draw.randint(1, 2) + str(draw.randint(0, vocabulary))
    shared = [[word() for _ in range(draw.randint(4, 70))] for _ in range(6)]
    texts = []
    for _ in range(size):
        words = []
        for _ in range(draw.randint(0, 5)):
            passage = draw.choice(shared)
            cut = draw.randint(0, len(passage))
            words += draw.choice(([word() for _ in range(draw.randint(0, 40))], passage, passage[cut:], passage[:cut],
                                  [word()] * draw.randint(1, 60), [word(), word()] * draw.randint(1, 30)))
        texts.append(draw.choice((" ", "\n", "\t \x0b")).join(words))
    return texts + texts[::5]


@pytest.mark.parametrize("window, anchor, seed", [(35, 16, 1), (6, 3, 2), (3, 1, 3), (5, 4, 4)])
def test_removal_equals_counting(spark, window, anchor, seed):
    texts = corpus(seed, vocabulary=200 if window < 35 else 6)
    assert got(spans.deduplicated(docs_of(spark, texts), window, anchor)) == plain_rows(list(enumerate(texts)), window)


def test_false_meetings_are_told_by_words(spark, monkeypatch):
    real = spans.sequence_hashes
    monkeypatch.setattr(spans, "sequence_hashes", lambda words, width: real(words, width) % np.uint64(61) + np.uint64(1))
    texts = corpus(5, vocabulary=900)
    want = plain_rows(list(enumerate(texts)), 4)
    assert got(spans.deduplicated(docs_of(spark, texts), 4, 2)) == want
    assert any(0 < n < m for _, m, n, _ in want)


def test_odd_rows(spark):
    long = " ".join(f"x{i % 4001}" for i in range(60_000))
    same = "\x1c".join("ab") + " é ü " + " ".join(f"y{i}" for i in range(50))
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, long), (5, "one two"), (6, same), (6, same), (None, same + " end"),
            (None, None), (7, "z " * 36), (8, "q " * 35), (9, "Y0 " + same), (10, "word" * 600_000 + " " + same.replace("é", "è"))]
    docs = docs_of(spark, rows, extra=("t1", "t2", "spans", "anchor", "n"))
    assert got(spans.deduplicated(docs)) == plain_rows(rows, 35)
    assert spans.deduplicated(docs.limit(0)).collect() == []


def test_long_input_is_hashed_in_pieces(monkeypatch):
    data = " ".join(corpus(6)).encode() + b" last"
    whole = spans.word_hashes(np.frombuffer(data, np.uint8))
    monkeypatch.setattr(spans, "STEP", 100)
    assert np.array_equal(spans.word_hashes(np.frombuffer(data, np.uint8)), whole)
    assert len(whole) == len(data.split())


def test_equal_windows_have_equal_anchors():
    texts = [t.encode() for t in corpus(7)]
    found = spans._Windows(texts, 9, 4)
    anchors = {}
    for i in np.flatnonzero(found.valid):
        assert anchors.setdefault(found.edges[i], found.anchors[i]) == found.anchors[i]
    assert set(found.anchors[found.valid]) == set(found.chosen())


def test_paths_don_t_branch():
    piece = lambda a, z, head, left, right: {"from": a, "to": z, "head": head, "left": left, "right": right}
    assert spans.text_paths([piece(5, 9, 2, True, False), piece(0, 4, 1, False, True), piece(10, 11, 3, True, True),
                             piece(13, 14, 4, True, True), piece(15, 15, 5, True, True)]) == [(0, 9, 1), (10, 11, 3), (13, 15, 4)]


def test_a_step_and_its_batches_stay_small(spark, monkeypatch):
    import tracemalloc

    import pyarrow as pa

    from tunemill.llm.common import steps

    draw = random.Random(7)
    texts = [" ".join(str(draw.randint(0, 9999)) for _ in range(400)) for _ in range(2000)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    tracemalloc.start()
    for step in steps(iter([batch]), step_bytes=spans.STEP):
        spans._Windows(spans.utf8(step.column("text")), 35, 16).chosen()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40 << 20

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows])], ["n"])

    seen = []
    monkeypatch.setattr(spans, "_deduplicated", lambda docs, *_: seen.extend(
        r.n for r in docs.mapInArrow(sizes, "n long").collect()))
    spans.deduplicated(spark.range(5000).repartition(1).selectExpr("id AS doc_id", "'a' AS text"))
    assert sum(seen) == 5000 and max(seen) <= 1000
    assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) == 10000
