import random

import pytest
import xxhash

from tests.llm.brute import docs_of
from tunemill.llm import simhash


def plain_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for space in "\t\n\x0b\x0c\r":
        words = words.replace(space, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def plain_components(pairs):
    """pairs of id and fingerprint."""
    root = list(range(len(pairs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(pairs)):
        for j in range(i):
            if (pairs[i][1] ^ pairs[j][1]).bit_count() <= 4:
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(pairs):
        if doc is not None:
            least[find(i)] = min(least.get(find(i), doc), doc)
    return [least.get(find(i)) for i in range(len(pairs))]


def rows_of(df):
    return sorted(((r.doc_id, r.fingerprint % (1 << 64), r.component_id) for r in df.collect()), key=repr)


def test_fingerprints_and_components_equal_brute_force(spark):
    rng = random.Random(3)
    words = ["the", "a", "of", "Straße", "ÉTÉ", "b\x0bc", "x y", "to", "in", "Ab"]
    texts = [" ".join(rng.choices(words, k=rng.randint(0, 60))) for _ in range(120)]
    for base in texts[:30]:
        for _ in range(3):
            w = base.split(" ")
            w[rng.randrange(len(w))] = rng.choice(words)
            texts.append(" ".join(w))
    texts += [None, "", " \t\n", texts[5], texts[5], "one", "one two", "ONE\ntwo"]
    got = rows_of(simhash.near_duplicates(docs_of(spark, texts, ["fingerprint", "u", "place", "least"])))
    pairs = [(i, plain_fingerprint(t)) for i, t in enumerate(texts)]
    want = [(i, f, c) for (i, f), c in zip(pairs, plain_components(pairs))]
    assert got == sorted(want, key=repr)


@pytest.mark.parametrize("group", [16, 100_000])
def test_dense_groups_and_chains_lose_no_link(spark, group):
    rng = random.Random(5)
    seeds = [rng.getrandbits(64) for _ in range(40)]
    values = set(seeds)
    for _ in range(600):  # one tight group
        values.add(seeds[0] ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 3))))
    step = seeds[1]
    for _ in range(12):  # a chain of steps of four bits
        step ^= sum(1 << b for b in rng.sample(range(64), 4))
        values.add(step)
    for s in seeds[2:20]:
        values.add(s ^ sum(1 << b for b in rng.sample(range(64), rng.choice([4, 5]))))
    values = sorted(values)
    nodes = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v,) for v in values], "fingerprint long")
    edges = [(r.u % (1 << 64), r.v % (1 << 64)) for r in simhash.links(nodes, group=group).collect()]
    assert all((u ^ v).bit_count() <= 4 for u, v in edges)
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v
    for u, v in edges:
        root[find(u)] = find(v)
    want = plain_components(list(enumerate(values)))
    classes = {}
    for v, c in zip(values, want):
        classes.setdefault(find(v), set()).add(c)
    assert all(len(c) == 1 for c in classes.values())
    assert len(classes) == len(set(want))


def test_nulls_repeats_and_empty_tables(spark):
    df = docs_of(spark, [(None, "a b c d"), (7, "a b c d"), (7, "a b c d"), (3, None), (4, ""), (None, "q r s t u")])
    got = sorted(((r.doc_id, r.component_id) for r in simhash.near_duplicates(df).collect()), key=repr)
    assert got == sorted([(None, 7), (7, 7), (7, 7), (3, 3), (4, 3), (None, None)], key=repr)
    assert simhash.near_duplicates(df.limit(0)).count() == 0


def test_block_distances_add_up():
    import numpy as np
    refs, masks = simhash.references(), simhash.block_masks()
    values = refs[:5]
    table = simhash.distance_table(values, refs, masks)
    assert (table.sum(axis=2).T.sum() == np.bitwise_count(values[:, None] ^ refs).sum())
    assert sum(int(m) for m in masks) == (1 << 64) - 1
