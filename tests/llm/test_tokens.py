import random

import public_tokenizers
from tokenizers import Tokenizer

from tests.llm.brute import docs_of
from tunemill.llm import tokens

ODD = ["İstanbul ΣΑΣ ΟΔΟΣ", "été Å", "a\x1cb\x1dc", "x y\xa0z\x85w", "don't 'sup we'll I'M",
       "½ ² ٣ 123,456", "<|endoftext|>abc<|startoftext|> <|endoftext|", "日本語テキスト 한국어", "\U0001f600\U0001f1e9!!!",
       "aaaaaaaaaaaaaaaaaaaaaaa", "ababababababa" * 50, "!" * 300, "́start", "a<|endoftext|>́b", "ﬁ ǅ ß ẞ", "\t \n", ""]


def test_counts_equal_the_library(spark):
    rng = random.Random(1)
    letters = "abcdeeehhnnrstt  .,!'\néßΣ9́"
    texts = ODD + ["".join(rng.choices(letters, k=rng.randint(0, 400))) for _ in range(150)]
    library = Tokenizer.from_file(public_tokenizers.path(tokens.VOCABULARY))
    want = [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
    got = tokens.token_counts(docs_of(spark, texts, ["n_tokens"]), limit=100).orderBy("doc_id").collect()
    assert [r.n_tokens for r in got] == want
    assert [r.n_bytes for r in got] == [len(t.encode()) for t in texts]
    assert [r.over_limit for r in got] == [n > 100 for n in want]


def test_given_documents_equal_the_library(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    library = Tokenizer.from_file(public_tokenizers.path(tokens.VOCABULARY))
    texts = {r.doc_id: r.text for r in df.collect()}
    for r in tokens.token_counts(df).collect():
        assert r.n_tokens == len(library.encode(texts[r.doc_id], add_special_tokens=False).ids)


def test_nulls_repeats_and_empty_tables(spark):
    df = docs_of(spark, [(None, "two words"), (1, None), (1, None), (2, "")])
    got = sorted(((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in tokens.token_counts(df).collect()), key=repr)
    assert got == sorted([(None, 9, 2, False), (1, 0, 0, False), (1, 0, 0, False), (2, 0, 0, False)], key=repr)
    assert tokens.token_counts(df.limit(0)).count() == 0


def test_words_over_the_room_of_a_merge(monkeypatch):
    monkeypatch.setattr(tokens, "ROOM", 10)
    merger = tokens.RankMerger(public_tokenizers.path(tokens.VOCABULARY))
    words = ["the", "internationalization" * 20, "", "a1b2", "you're"]
    library = Tokenizer.from_file(public_tokenizers.path(tokens.VOCABULARY))
    assert list(merger.counts(words)) == [len(library.encode(w).ids) for w in words]
