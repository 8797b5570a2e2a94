import itertools
import math
import random
import zlib

import numpy as np
import pytest

from tests.llm.brute import docs_of
from tunemill.llm import toxicity as tox
from tunemill.llm.charlm import alphabet, codes, log_probabilities

CLEAN = "the stupid idiot and the moron are in the garden with a loser and scum while people walk home for dinner"
LABELS = "doc_id long, quality int, toxic int, text string"


@pytest.fixture(scope="module")
def restorer():
    table = alphabet(" ".join(tox.LETTERS))
    raw = (CLEAN + " ").encode() * 3
    size = int(table.max()) + 1
    code, n = np.unique(codes(table[np.frombuffer(raw, np.uint8)], size, tox.ORDER), return_counts=True)
    return tox.Restorer(log_probabilities(code, n, size, tox.ORDER))


def plain_cost(restorer, word):
    """Least cost over all readings, one by one. Words without letters that repeat."""
    best = math.inf
    for reading in itertools.product(*(restorer.options(c) for c in word)):
        cost, a, b = 0.0, 0, 0
        for letter, price in reading:
            cost += price
            if letter is not None:
                cost -= restorer.logs[a][b][letter]
                a, b = b, letter
        best = min(best, cost - restorer.logs[a][b][0])
    return best


def cost_of(restorer, word, text):
    """Least cost of the readings of ``word`` as ``text``."""
    numbers = [0 if c == " " else restorer.number[c] for c in text]
    best = math.inf
    for reading in itertools.product(*(restorer.options(c) for c in word)):
        if [x for x, _ in reading if x is not None] == numbers:
            cost, a, b = sum(p for _, p in reading), 0, 0
            for x in numbers:
                cost -= restorer.logs[a][b][x]
                a, b = b, x
            best = min(best, cost - restorer.logs[a][b][0])
    return best


def test_search_finds_the_best_reading(restorer, monkeypatch):
    monkeypatch.setattr(tox, "BEAM", 10_000)
    monkeypatch.setattr(tox, "COST_REPEAT", 1e9)
    rng = random.Random(3)
    for word in ["1d1ot", "m0r0n", "s.c.u.m", "l05er", "i d i o t", "a b"] + ["".join(rng.choices("abe013$@!. -", k=6)) for _ in range(40)]:
        assert cost_of(restorer, word, restorer.restore(word)) == pytest.approx(plain_cost(restorer, word))


def least_cost(restorer, lattice):
    """Least cost over all states, and the repeats of a letter."""
    states, before = {(0, 0): 0.0}, ""
    for sign, options in lattice:
        after = {}
        for (a, b), cost in states.items():
            for letter, price in options:
                ways = [((a, b), price)] if letter is None else [((b, letter), price - restorer.logs[a][b][letter])]
                if letter and letter == b and (letter < restorer.size - 1 or sign == before):
                    ways.append(((a, b), tox.COST_REPEAT + price))
                for key, more in ways:
                    after[key] = min(after.get(key, math.inf), cost + more)
        states, before = after, sign
    return min(c - restorer.logs[a][b][0] for (a, b), c in states.items())


def reading_cost(restorer, lattice, text):
    """Least cost of the lattice's readings as ``text``."""
    numbers = [0 if c == " " else restorer.number[c] for c in text]
    ends, before = {0: 0.0}, ""  # by letters that have come
    for sign, options in lattice:
        after = {}
        for n, cost in ends.items():
            a, b = ([0, 0] + numbers[:n])[-2:]
            for letter, price in options:
                ways = [(n, price)] if letter is None else []
                if letter is not None and n < len(numbers) and numbers[n] == letter:
                    ways.append((n + 1, price - restorer.logs[a][b][letter]))
                if letter and n and letter == b:
                    ways.append((n, tox.COST_REPEAT + price))
                for key, more in ways:
                    after[key] = min(after.get(key, math.inf), cost + more)
        ends, before = after, sign
    a, b = ([0, 0] + numbers)[-2:]
    return ends[len(numbers)] - restorer.logs[a][b][0]


def test_no_path_is_left_out_whatever_the_length(restorer, monkeypatch):
    rng = random.Random(8)
    words = ["f**k", "b*t*h", "s***d", "i d i o t " * 9 + "s"] + ["".join(rng.choices("abeiost013$@!. -*", k=k)) for k in (5, 60, 130)]
    words += ["-".join(rng.choices("abeiost", k=60)), "".join(rng.choices("abeiost013 -", k=90))]
    for part in (1024, 7):
        monkeypatch.setattr(tox, "PART", part)
        for word in words:
            lattice = restorer.inside(word)
            assert reading_cost(restorer, lattice, restorer.restore(word)) == pytest.approx(least_cost(restorer, lattice)), word


def test_edges_digits_and_doubled_letters_reach_the_lattice(restorer):
    for word, plain in [("!diot", "idiot"), ("|diot", "idiot"), ("1d107", "idiot"), ("iidiot", "idiot"), ("$cum!!", "scum"), ("*diot", "idiot"),
                        ("(!diot)", "idiot"), ("5tup1d", "stupid"), ("1053r", "loser"), ("$c**", "scum"), ("mor0n+", "moron"), ("5(um", "scum")]:
        assert plain in tox.plain_words(word, restorer), (word, tox.plain_words(word, restorer))
    for word in ("@$$", "a$$"):
        assert any(w.isalpha() and w[:2] == "as" for w in tox.plain_words(word, restorer)), word


def test_disguises_are_undone(restorer):
    for word, plain in [("1d1ot", "idiot"), ("m0r0n", "moron"), ("st*pid", "stupid"), ("i-d-i-o-t", "idiot"), ("s c u m", "scum"),
                        ("scccccum", "scum"), ("$tup1d", "stupid"), ("l0ser", "loser")]:
        assert plain in tox.plain_words(word, restorer), word
    assert tox.plain_words("people,", restorer) == ("people",)
    assert tox.plain_words("!!!", restorer) == ()
    assert restorer.restore("x" * 500) is not None


def corpus(seed=1, n=360):
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdefghiklmnoprstu", k=rng.randint(2, 7))) for _ in range(150)] + CLEAN.split()
    words = [w for w in words if w not in ("idiot", "moron", "stupid", "scum", "loser")]
    rows, labels = [], []
    for i in range(n):
        text = rng.choices(words, k=rng.randint(20, 60))
        bad = i % 5 == 0
        if bad:
            for w in rng.choices(["idiot", "moron", "stupid"], k=3):
                text[rng.randrange(len(text))] = rng.choice([w, w.upper() + "!!", w.replace("o", "0"), "-".join(w)])
        rows.append((i, " ".join(text)))
        labels.append((i, 1, int(bad), "x"))
    return rows, labels


def test_held_out_documents_are_told_apart(spark):
    rows, labels = corpus()
    got = {r.doc_id: r for r in tox.scored(docs_of(spark, rows, ["score", "toxic"]), spark.createDataFrame(labels, LABELS)).collect()}
    for i, _ in rows:
        assert got[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1)
        assert got[i].predicted == int(got[i].score >= 0.7) and 0 <= got[i].score <= 1
    held = [(got[i].predicted, y) for i, _, y, _ in labels if got[i].held_out]
    assert sum(p == y for p, y in held) / len(held) > 0.93


def test_held_out_labels_and_other_columns_do_not_matter(spark):
    rows, labels = corpus(2, 150)
    turned = [(i, 0, 1 - y if zlib.crc32(str(i).encode()) % 3 == 1 else y, "z") for i, _, y, _ in labels]
    results = []
    for given in (labels, turned):
        scores = tox.scored(docs_of(spark, rows).selectExpr("doc_id", "text", "'q' AS lang", "'r' AS source"),
                            spark.createDataFrame(given, LABELS)).collect()
        results.append({r.doc_id: r.score for r in scores})
    assert results[0] == pytest.approx(results[1])


def test_nulls_repeats_and_empty_tables(spark):
    rows, labels = corpus(3, 60)
    df = docs_of(spark, rows + [(None, "idiot"), (500, None), (500, None), (501, ""), (502, "idiot " * 40_000)])
    known = spark.createDataFrame(labels + [(None, 1, 1, ""), (1, 1, None, ""), (0, 0, 1, "")], LABELS)
    got = tox.scored(df, known).collect()
    assert len(got) == 65 and all(r.score is not None for r in got)
    assert {r.held_out for r in got if r.doc_id is None} == {None}
    assert len({r.score for r in got if r.doc_id in (500, 501)}) == 1
    assert tox.scored(df.limit(0), known).count() == 0
    assert {r.predicted for r in tox.scored(df, known.limit(0)).collect()} == {0}


def test_restored_texts(spark):
    df = docs_of(spark, [CLEAN] * 5 + ["What an 1d1ot, m-o-r-o-n!!", None])
    got = {r.doc_id: r.text for r in tox.restored(df).collect()}
    assert got[5] == "what an idiot moron" and got[6] is None and got[0] == CLEAN


def test_shared_ends_and_look_ups_equal_the_search_of_each_lattice(restorer):
    rng = random.Random(12)
    words = ["".join(rng.choices("aabbeeiosst", k=rng.randint(1, 9))) for _ in range(150)]
    for word in words:
        lattice = restorer.inside(word)
        assert reading_cost(restorer, lattice, restorer.doubled(word)) == pytest.approx(least_cost(restorer, lattice)), word
    for word in words[:60] + ["1d10t", "s-s", "f*k"]:
        before, behind = "".join(rng.choices("!(*.", k=rng.randint(0, 3))), "".join(rng.choices("!#*.+", k=rng.randint(0, 4)))
        wanted = set()
        for left in restorer.forced(before, -1):
            for right in restorer.forced(behind, 0):
                if left or right or tox.ODD.search(word):
                    wanted.add(restorer.best((restorer.edge(before, left) if left else []) + restorer.inside(word)
                                             + (restorer.edge(behind, right) if right else [])))
        assert set(restorer.readings(before, word, behind)) == wanted, (before, word, behind)
