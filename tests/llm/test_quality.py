import random
import re
from collections import Counter

from tests.conftest import plan_of
from tests.llm.brute import docs_of
from tunemill.llm import quality


def plain(text):
    text = text or ""
    words = [w for w in re.split("[ \t-\r]+", text) if w]
    lines = [x for x in text.split("\n") if re.search("[^ \t-\r]", x)]
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    twice = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if twice[w] > 1 for k in range(3)}
    n, r = len(words), len(covered)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), r,
            n < 50 or 100 * r > 50 * n)


def test_counts_equal_brute_force(spark):
    rng = random.Random(8)
    parts = ["the", "of", "a", "x|y", "Zeile", "été", "\n", "\n", "  ", "\t", "\x0b", "50%", "word.", " nbsp"]
    texts = [" ".join(rng.choices(parts[:rng.randint(2, len(parts))], k=rng.randint(0, 150))) for _ in range(120)]
    texts += [None, "", "\n\n", "a b", "a b c", "a a a a", "x y z x y z", ("the end. " * 40_000)]
    got = {r.doc_id: r for r in quality.measured(docs_of(spark, texts, ["_words", "kept", "n_lines"])).collect()}
    for i, text in enumerate(texts):
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == plain(text), text
        assert not (r.kept and r.base_failed)


def sentence(k):
    return " ".join(f"word{k}{i}" for i in range(20)) + "."


def test_lines_are_judged_before_documents(spark):
    good = "\n".join(map(sentence, range(5)))
    bad = ["home | news | sport | more.", "no end of a line at all here", "THIS IS ALL SHOUTED NOW!",
           "Released under the MIT License.", "a# b# c# d$ e%."]
    many = "\n".join(b.replace(" ", f" {k}", 3) for k in range(60, 90) for b in bad[1:3])
    rows = {r.doc_id: r for r in quality.measured(docs_of(spark, [good, good + "\n" + "\n".join(bad), good + "\n" + many])).collect()}
    assert rows[0].kept and rows[0].n_lines_removed == 0 and rows[0].clean_text == good
    assert rows[1].kept and rows[1].n_lines_removed == 5 and rows[1].clean_text == good
    assert not rows[2].kept and not rows[2].base_failed
    assert {r.doc_id: r.text for r in quality.clean(docs_of(spark, [good, many])).collect()} == {0: good}


def test_nulls_repeats_and_empty_tables(spark):
    df = docs_of(spark, [(None, "a"), (1, None), (1, None)])
    got = sorted(((r.doc_id, r.n_words, r.kept) for r in quality.measured(df).collect()), key=repr)
    assert got == sorted([(None, 1, False), (1, 0, False), (1, 0, False)], key=repr)
    assert quality.measured(df.limit(0)).count() == 0


def test_plan_has_no_exchange_and_no_python(spark):
    plan = plan_of(quality.measured(docs_of(spark, ["a"])))
    assert not re.search("Exchange|Python|Pandas|Arrow", plan)
