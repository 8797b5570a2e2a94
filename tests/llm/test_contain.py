import random
import re

import pytest

from tests.llm.brute import docs_of
from tunemill.llm import contain

ITEMS = "item_id long, text string, hash string"


def plain_shingles(text):
    words = [w.strip(contain.EDGES.decode()) for w in re.split(r"[ \t\n\x0b\x0c\r]+", text or "")]
    words = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in words if w]
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}


def world(seed, n_items=25, n_docs=60):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    items = [" ".join(rng.choices(words, k=rng.choice([3, 5, 6, 9, 20, 60, 300]))) for _ in range(n_items)]
    docs = []
    for _ in range(n_docs):
        parts = [" ".join(rng.choices(words, k=rng.randint(0, 500)))]
        for item in rng.sample(items, 2):
            w = item.split()
            for _ in range(rng.choice([0, 0, 1, 2])):
                w[rng.randrange(len(w))] = "changed"
            cut = rng.choice([1.0, 0.9, 0.85, 0.8, 0.7])
            parts.append(" ".join(w[:max(1, int(len(w) * cut))]).upper() + "!!")
        docs.append(". ".join(rng.sample(parts, len(parts))))
    return docs, items


@pytest.mark.parametrize("share", [0.8, 0.5, 1.0])
@pytest.mark.parametrize("bits", [8, 24])
def test_pairs_equal_brute_force(spark, share, bits):
    docs, items = world(4)
    frame = spark.createDataFrame([(i, t, "") for i, t in enumerate(items)], ITEMS)
    got = {(r.doc_id, r.item_id): r.containment
           for r in contain.contained(docs_of(spark, docs, ["hash"]), frame, share=share, bits=bits).collect()}
    want = {}
    for d, doc in enumerate(docs):
        have = plain_shingles(doc)
        for i, item in enumerate(items):
            need = plain_shingles(item)
            if need and len(need & have) / len(need) >= share:
                want[d, i] = len(need & have) / len(need)
    assert len(want) > 5
    assert got == pytest.approx(want)


def test_sketch_always_meets_what_is_held():
    for n in range(1, 700):
        for share in (0.5, 0.8, 0.9, 1.0):
            missing = n - -(-int(round(share * n * 1000)) // 1000)
            assert contain.sketch_size(n, share) > missing


def test_nulls_repeats_and_empty_tables(spark):
    text = "one two three four five six"
    items = spark.createDataFrame([(1, text, ""), (None, text, ""), (2, None, ""), (3, "one two", ""), (4, "", "")], ITEMS)
    df = docs_of(spark, [(None, text), (5, text), (5, text), (6, None), (7, ""), (8, "x " * 50000 + text)])
    got = sorted(tuple(r) for r in contain.contained(df, items).collect())
    assert got == [(5, 1, 1.0), (8, 1, 1.0)]
    assert contain.contained(df.limit(0), items).count() == 0
    assert contain.contained(df, items.limit(0)).count() == 0


def test_rows_that_repeat_an_item_are_one_item_and_lose_no_document(spark):
    rng = random.Random(21)
    word = lambda: "".join(rng.choices("abcdefghij", k=6))
    items, docs, want = [], [], {}
    for i in range(60):
        parts = [[word() for _ in range(rng.randint(5, 40))] for _ in range(2)]
        items += [(i, " ".join(p)) for p in parts]
        sizes = [len(p) - 4 for p in parts]
        for cut in (0, 1, 3, 8):  # a document that lacks the end of the shorter part
            short = min(range(2), key=lambda k: sizes[k])
            kept = parts[short][:len(parts[short]) - cut] if cut else parts[short]
            held = sizes[1 - short] + max(0, len(kept) - 4)
            docs.append((len(docs), " ".join(parts[1 - short]) + " zzzz yyyy xxxx wwww vvvv " + " ".join(kept)))
            if held >= 0.8 * sum(sizes) - 1e-9:
                want[len(docs) - 1, i] = held / sum(sizes)
    found = contain.contained(spark.createDataFrame(docs, "doc_id long, text string"),
                              spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id): round(r.containment, 9) for r in found} == {k: round(v, 9) for k, v in want.items()}
