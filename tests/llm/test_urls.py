import math
import random

import numpy as np

from tunemill.llm import charlm, urls

PAGES = "page_id long, url string, html string, host string, score string"


def pages_of(spark, given):
    return spark.createDataFrame([(i, u, "", "h", "s") for i, u in given], PAGES)


def plain_parts(url):
    url = url or ""
    if "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = rest
    for sign in "/?#":
        host = host.split(sign, 1)[0]
    path = rest[len(host):].split("?", 1)[0].split("#", 1)[0]
    return "".join(c.lower() if c.isascii() else c for c in host), path


def plain_rule(host, path):
    fits = [(len(h + p), v, h + p) for v, h, p in urls.RULES
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


ODD = [None, "", "com/", "http://com/", "x://EXAMPLE.com/en/x?y#z", "http://a.example.com/en/1", "http://www.example.com/en/",
       "http://sub.www.example.com/en/#", "http://notexample.com/en/", "http://a.net/es/", "http://a.net/fr/x", "http://net/es",
       "http://a.net/ES/", "http://?q", "http://a.com", "http://a.com?x=/en/", "://", "http://b.org/p\nq", "HTTP://Ä.Com/é", "a://b://c.com/"]


def test_hosts_paths_and_rules(spark):
    got = {r.page_id: r for r in urls.judged(pages_of(spark, list(enumerate(ODD)))).collect()}
    for i, url in enumerate(ODD):
        host, path = plain_parts(url)
        verdict, rule = plain_rule(host, path)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule), url
        assert got[i].verdict == verdict if rule else got[i].verdict in ("allow", "block")


def test_probabilities_equal_a_plain_model():
    rng = random.Random(1)
    size, order = 4, 3
    text = [rng.randrange(size) for _ in range(300)]
    grams = charlm.codes(np.array(text), size, order)
    code, n = np.unique(grams, return_counts=True)
    got = charlm.log_probabilities(code, n, size, order)
    padded = [0, 0] + text

    def plain(context, c):
        if context is None:
            return 1 / size
        k = len(context)
        after = [padded[i] for i in range(2, len(padded)) if tuple(padded[i - k:i]) == context]
        kinds = max(1, len(set(after)))
        return (after.count(c) + kinds * plain(context[1:] if k else None, c)) / (len(after) + kinds)
    for a in range(size):
        for b in range(size):
            for c in range(size):
                assert math.isclose(got[(a * size + b) * size + c], math.log(plain((a, b), c)), rel_tol=1e-5)


def test_model_tells_held_out_kinds_apart(spark):
    rng = random.Random(2)
    names = ["".join(rng.choices("abcdefg", k=6)) for _ in range(400)]
    given = [f"http://{n}.com/x{n}" for n in names] + [f"http://q.example.com/en/casino-{n}" for n in names]
    fresh = [f"http://{n}.org/x{n}" for n in names[:50]] + [f"http://q.example.org/en/casino-{n}" for n in names[:50]]
    got = {r.page_id: r.verdict for r in urls.judged(pages_of(spark, list(enumerate(given + fresh)))).collect()}
    right = [got[800 + i] == ("allow" if i < 50 else "block") for i in range(100)]
    assert sum(right) >= 95


def test_nulls_repeats_and_empty_tables(spark):
    df = pages_of(spark, [(None, "http://a.com/"), (1, "http://z.org/"), (1, "http://z.org/"), (2, "http://x.org/" + "y" * 200_000)])
    got = sorted(((r.page_id, r.rule, r.verdict) for r in urls.judged(df).collect()), key=repr)
    assert got == sorted([(None, "com/", "allow"), (1, None, "allow"), (1, None, "allow"), (2, None, "allow")], key=repr)
    assert urls.judged(df.limit(0)).count() == 0
