import random

import pytest

from tests.llm.brute import docs_of
from tunemill.llm import pieces
from tunemill.llm.pieces import Pieces, decode, encode, model_path


@pytest.fixture(scope="module")
def model():
    return Pieces(model_path())


def plain_score(model, text):
    """Greatest sum of scores over the whole marked text, without words or a trie."""
    text = " " + text
    best = [0.0] + [float("-inf")] * len(text)
    for end in range(1, len(text) + 1):
        best[end] = best[end - 1] + model.unknown
        for begin in range(max(0, end - model.longest), end):
            if text[begin:end] in model.scores:
                best[end] = max(best[end], best[begin] + model.scores[text[begin:end]][0])
    return best[-1]


def score_of(model, ids):
    """Sum of the scores of ids; each character written as bytes costs the unknown score."""
    inverse = {i: s for s, i in model.scores.values()}
    total = 0.0
    for i in ids:
        if i in inverse:
            total += inverse[i]
        elif model.text[i][0] & 0xC0 != 0x80:
            total += model.unknown
    return total


TEXTS = ["hello world", "  two  blanks   ", "line\nfeed\n\nend", "▁mark ▁ sign", "日本語 ñandú Ærø \U0001f600",
         "the thesis theses thesaurus the", "x" * 500, " ", "\n", "tab\tand\rreturn", "a\x00b"]


def test_segmentation_is_the_best_and_decoding_exact(spark, model):
    rng = random.Random(2)
    texts = TEXTS + ["".join(rng.choices("theinorsd  \nàñ.,", k=rng.randint(1, 200))) for _ in range(80)]
    df = docs_of(spark, texts, ["ids"])
    rows = {r.doc_id: r.ids for r in encode(df).collect()}
    for i, text in enumerate(texts):
        assert score_of(model, rows[i]) == pytest.approx(plain_score(model, text))
    back = {r.doc_id: r.text for r in decode(encode(df)).collect()}
    assert back == dict(enumerate(texts))
    checked = pieces.round_trip(df).collect()
    assert all(r.round_trip and r.ids == rows[r.doc_id] and r.n_pieces == len(r.ids) for r in checked)


def test_shared_prefixes_change_nothing(model):
    words = sorted({" the", " there", " therefore", " thermal", " x", " xenon", "\n", " ", "   a"})
    together = list(model.encode_sorted(words))
    assert together == [next(model.encode_sorted([w])) for w in words]


def test_words_stay_known_over_generations(model):
    known = pieces.Known(model, room=4)
    for words in ({" a", " b", " c"}, {" a", " d"}, {" a", " b", " e"}, {" c"}):
        found = known.of(words)
        assert {w: found[w] for w in words} == dict(zip(sorted(words), model.encode_sorted(sorted(words))))


def test_every_text_piece_of_the_file_takes_part(model):
    import sentencepiece

    file = sentencepiece.SentencePieceProcessor(model_file=model_path())
    table = {file.id_to_piece(i).replace("▁", " "): file.get_score(i) for i in range(file.vocab_size())
             if not (file.is_byte(i) or file.is_control(i) or file.is_unknown(i) or file.is_unused(i))}
    assert {" " * n for n in range(1, 17) if n != 15} <= table.keys()
    lowest = min(table.values()) - pieces.UNKNOWN
    for word in [" ★", " 梦", "  b", "   ", " " * 15, " " * 40 + "b", "     ★", " a", " \u2581 "]:
        best = [0.0]
        for end in range(1, len(word) + 1):
            best.append(max([best[end - 1] + lowest] + [best[begin] + table[word[begin:end]] for begin in range(end)
                                                        if word[begin:end] in table]))
        ids = memoryview(next(model.encode_sorted([word]))).cast("i").tolist()
        assert model.byte[32] not in ids, word
        assert "".join(file.id_to_piece(i) for i in ids if not file.is_byte(i)).replace("▁", " ") == word.replace("\u2581", "")
        unknown = sum(file.is_byte(i) for i in ids) // 3
        assert sum(file.get_score(i) for i in ids if not file.is_byte(i)) + unknown * lowest == best[-1], word


def test_nulls_repeats_and_empty_tables(spark):
    df = docs_of(spark, [(None, "a"), (1, None), (1, None), (2, ""), (3, "b c")])
    encoded = encode(df, keep=("text",))
    got = {(r.doc_id, r.text, None if r.ids is None else len(r.ids) > 0) for r in encoded.collect()}
    assert got == {(None, "a", True), (1, None, None), (2, "", False), (3, "b c", True)}
    back = sorted(((r.doc_id, r.text) for r in decode(encoded).collect()), key=repr)
    assert back == sorted([(None, "a"), (1, None), (1, None), (2, ""), (3, "b c")], key=repr)
    assert encode(df.limit(0)).count() == 0
    checked = {(r.doc_id, r.n_pieces is None, r.round_trip) for r in pieces.round_trip(df).collect()}
    assert checked == {(None, False, True), (1, True, True), (2, False, True), (3, False, True)}
