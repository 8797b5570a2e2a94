import random
import re

import pytest

from tests.llm.brute import docs_of
from tunemill.llm import lines


def sets_of(rows):
    out = []
    for doc, text in rows:
        for number, line in enumerate((text or "").split("\n")):
            words = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in re.split("[ \t\r\x0b\x0c]+", line) if w]
            if doc is not None and len(words) >= 5:
                out.append(((doc, number), frozenset(words)))
    return sorted(set(out), key=lambda x: x[0])


def plain(rows, t):
    found = sets_of(rows)
    gone = set()
    for j, (y, b) in enumerate(found):
        for x, a in found[:j]:
            if x < y and len(a & b) >= t * len(a | b) - 1e-9:
                gone.add(y)
                break
    return sorted(gone)


def world(seed, n=80):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)] + ["the", "of", "and"] * 20
    pool = [" ".join(rng.choices(words, k=rng.choice([3, 5, 6, 8, 15, 40, 120, 300]))) for _ in range(50)]
    rows = []
    for i in range(n):
        text = []
        for _ in range(rng.randint(1, 6)):
            w = rng.choice(pool).split()
            for _ in range(rng.choice([0, 0, 1, 2, 5])):
                w[rng.randrange(len(w))] = rng.choice(words).upper()
            text.append(" ".join(w))
        rows.append((i, "\n".join(text)))
    return rows


def got_of(df):
    return sorted((r.doc_id, r.line_no) for r in df.collect())


@pytest.mark.parametrize("similarity", [0.8, 0.6, 1.0])
def test_removed_lines_equal_brute_force(spark, similarity):
    rows = world(1)
    want = plain(rows, similarity)
    assert len(want) > 40
    assert got_of(lines.removed_lines(docs_of(spark, rows, ["line_no", "n", "word"]), similarity)) == want


@pytest.mark.parametrize("options", [{"group": 8}, {"buckets": 3}, {"bits": 7}])
def test_limits_of_memory_lose_nothing(spark, options):
    rows = world(2, 60)
    assert got_of(lines.removed_lines(docs_of(spark, rows), **options)) == plain(rows, 0.8)


def test_second_round_tries_every_candidate(spark, monkeypatch):
    rows = world(3, 40)
    df = docs_of(spark, rows)
    real = lines._verified
    calls = []

    def doubting(pairs, *rest):
        calls.append(pairs)
        # what the first round found counts for nothing, so that the second has all to do
        found = real(pairs, *rest)
        return found if len(calls) > 1 else found.limit(0)
    monkeypatch.setattr(lines, "_verified", doubting)
    got = got_of(lines.removed_lines(df))
    assert len(calls) == 2
    assert set(got) <= set(plain(rows, 0.8))
    # pairs tried in the first round are not tried again; only lines with no other pair may be missing
    tried = {(r.y_doc, r.y_line) for r in calls[0].collect()}
    assert set(plain(rows, 0.8)) - set(got) <= tried


def test_copies_near_copies_and_one_common_line(spark):
    rng = random.Random(5)
    base = [f"word{i}" for i in range(60)]
    rows = [(i, "one line that very many documents share\n" + " ".join(
        base if i % 2 else [w if rng.random() > 0.02 else f"x{rng.random()}" for w in base])) for i in range(300)]
    assert got_of(lines.removed_lines(docs_of(spark, rows))) == plain(rows, 0.8)


def test_nulls_repeats_and_empty_tables(spark):
    line = "one two three four five"
    rows = [(None, line), (3, line), (3, line), (4, f"x\n{line}"), (5, None), (6, ""), (2, f"{line}\nshort line\nshort line"),
            (9, "six seven eight nine ten\n" + "w " * 100_000)]
    df = docs_of(spark, rows, ["removed"])
    assert got_of(lines.removed_lines(df)) == [(3, 0), (4, 1)]
    report = sorted(((r.doc_id, r.n_lines, r.n_removed) for r in lines.line_report(df).collect()), key=repr)
    assert (2, 3, 0) in report and (4, 2, 1) in report and (None, 1, 0) in report and len(report) == 8
    kept = sorted(((r.doc_id, r.text, r.n_chars, r.removed) for r in lines.clean(df).collect() if r.doc_id != 9), key=repr)
    assert kept == sorted([(None, line, 23, "x"), (4, "x", 1, "x"), (5, None, None, "x"), (6, "", 0, "x"),
                           (2, f"{line}\nshort line\nshort line", 45, "x")], key=repr)
    assert lines.removed_lines(df.limit(0)).count() == 0 and lines.clean(df.limit(0)).count() == 0


@pytest.mark.parametrize("similarity", [0.8, 0.6])
def test_lines_of_any_number_of_words_take_part(spark, similarity):
    rng = random.Random(11)
    rows = [(i, "\n".join(" ".join(rng.sample("a b c d e f g".split(), k=rng.randint(1, 6))) for _ in range(3))) for i in range(60)]
    rows += [(100, "w x y z"), (101, "w x y z v"), (102, "all rights reserved."), (103, "All rights reserved."), (104, "\n \n"), (None, "w x y z")]
    seen, want = [], []
    for doc, number, line in sorted((d, k, x) for d, t in rows if d is not None for k, x in enumerate(t.split("\n"))):
        words = set(line.lower().split())
        if words and any(len(words & s) >= similarity * len(words | s) - 1e-9 for s in seen):
            want.append((doc, number))
        seen.append(words)
    assert {(101, 0), (103, 0)} <= set(want)
    assert got_of(lines.removed_lines(docs_of(spark, rows).repartition(3), similarity, least_words=1)) == want


def test_the_query_takes_all_lines(spark, tmp_path):
    from tunemill.llm.registry import QUERIES

    docs_of(spark, [(1, "home\nall rights reserved."), (2, "all rights reserved.\nhome\nnew")]).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.removed for r in QUERIES["op5_line_similarity"](spark, str(tmp_path)).collect()}
    assert got == {1: [], 2: [0, 1]}


@pytest.mark.parametrize("similarity", [0.5, 0.6, 0.8, 1.0])
def test_similar_sets_share_a_key_of_the_second_round(similarity):
    import numpy as np
    import pyarrow as pa

    rng = random.Random(7)
    sets = []
    for n in [1, 2, 3, 4, 5, 7, 12, 40, 120, 127, 128, 129, 159, 160, 161, 200, 240] * 6:
        first = rng.sample(range(1, 10_000), n)
        second = first[rng.randint(0, n // 4):] + rng.sample(range(10_000, 20_000), rng.randint(0, n // 4 + 1))
        sets += [sorted(first), sorted(second)]
    prefixes = [s if len(s) < lines.SHORT else s[:int(lines.prefix_size(np.array(len(s)), similarity)) + 1] for s in sets]
    batch = pa.record_batch({"n": pa.array([len(s) for s in sets], pa.int32()), "prefix": pa.array(prefixes, pa.list_(pa.int64()))})
    held = [{} for _ in sets]
    for row, at, key in zip(*(v.tolist() for v in lines._pair_keys(batch, similarity))):
        held[row][key] = at
    similar = 0
    for i in range(0, len(sets), 2):
        x, y = sets[i], sets[i + 1]
        common = len(set(x) & set(y))
        if common >= similarity * (len(x) + len(y) - common) - 1e-9:
            similar += 1
            need = int(lines.overlap_needed(np.array(len(x) + len(y)), similarity))
            assert any(min(len(x) - held[i][k], len(y) - held[i + 1][k]) >= need for k in held[i].keys() & held[i + 1].keys())
    assert similar >= (20 if similarity < 1 else 1)


def test_pairs_of_a_key_are_handed_on_in_pieces():
    import numpy as np

    found = np.zeros(1500, lines.POSTING)
    found["n"], found["doc"] = 10, np.arange(1500)
    # every line is to meet every earlier one, as unsettled lines do
    pieces = list(lines._pairs_met(found, 0.8, np.full(4, np.uint64(-1 % 2 ** 64))))
    assert sum(p.num_rows for p in pieces) == 1500 * 1499 // 2
    assert len(pieces) > 3 and max(p.num_rows for p in pieces) < lines._PAIRS + 1500
    pairs = {(a, b) for p in pieces for a, b in zip(p.column("x_doc").to_pylist(), p.column("y_doc").to_pylist())}
    assert len(pairs) == 1500 * 1499 // 2 and all(a < b for a, b in pairs)


def test_partner_size_is_the_largest_that_the_filters_pass():
    import numpy as np

    for similarity in (0.5, 0.6, 0.8, 1.0):
        n, at = (v.ravel() for v in np.meshgrid(np.arange(1, 200), np.arange(60)))
        n, at = n[at < n], at[at < n]
        most = lines.partner_size(n, at, similarity)
        assert (lines.overlap_needed(n + most, similarity) <= n - at).all()
        assert (lines.overlap_needed(n + most + 1, similarity) > n - at).all()


def test_a_step_of_a_task_stays_small():
    import tracemalloc

    import numpy as np
    import pyarrow as pa

    from tunemill.llm.common import steps

    rng = random.Random(13)
    texts = ["\n".join(" ".join(f"w{rng.randrange(5000)}" for _ in range(12)) for _ in range(30)) for _ in range(3000)]
    batch = pa.record_batch({"doc_id": pa.array(range(3000), pa.int64()), "text": texts})
    levels = np.zeros(1 << 10, np.uint8)
    lines._Lines(next(steps([batch], step_bytes=lines.STEP)), levels, 1)  # the kept powers are made
    tracemalloc.start()
    for step in steps([batch], step_bytes=lines.STEP):
        lines._Lines(step, levels, 1)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 70 << 20


def test_batches_of_texts_are_bounded_while_lines_are_found(spark, monkeypatch):
    name, seen = "spark.sql.execution.arrow.maxBytesPerBatch", []
    before = spark.conf.get(name, None)
    real = lines._candidates
    monkeypatch.setattr(lines, "_candidates", lambda *rest: seen.append(spark.conf.get(name)) or real(*rest))
    lines.removed_lines(docs_of(spark, [(1, "a b c d e f"), (2, "a b c d e f")])).collect()
    assert int(seen[0]) <= 4 << 20 and spark.conf.get(name, None) == before
