"""SentencePiece encoding and decoding with one Viterbi pass over a trie of marked words.

A marked word is a run of blanks with the word after it. No piece goes on from a word into the next
blank and none holds a line feed, so the best segmentation of a text is that of its marked words.
The distinct marked words of a step are sorted; walking the sorted list is a depth-first walk of
their trie, and the forward scores of the prefix shared with the word before are kept.

Scores are those of the model file, for every piece that is text; the mark alone and runs of marks
have by far the lowest, so they stand only where no other piece covers a blank. The best segmentation
has the greatest sum; of equal sums the one with the longest last piece is taken, and so on backwards.
A character no piece covers costs the lowest score less ``UNKNOWN`` and is written as its UTF-8 bytes,
so decoding gives back every text exactly, also one that holds the mark sign itself.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tunemill.llm.common import steps

MODEL = "piece_bpe_32k.model"
UNKNOWN = 10.0
#: Words whose ids a task keeps.
KEPT = 200_000
MARKED = re.compile(r" *[^ \n]+| +|\n")


class Pieces:
    """The pieces of a model file, as text with blanks for marks."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.text: list[bytes] = []
        self.scores: dict[str, tuple[float, int]] = {}
        self.byte = [0] * 256
        for i in range(model.vocab_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte[int(piece[3:5], 16)] = i
                self.text.append(bytes([int(piece[3:5], 16)]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.text.append(b"")
            else:
                plain = piece.replace("▁", " ")
                self.text.append(plain.encode())
                self.scores[plain] = (model.get_score(i), i)
        if any("\n" in p or re.search(r"[^ ] ", p) for p in self.scores):
            raise ValueError("a piece spans marked words")
        self.longest = max(map(len, self.scores))
        # every ending of a piece, so that a search for pieces from their end knows when to stop
        self.endings: dict[str, tuple] = {p[i:]: () for p in self.scores for i in range(len(p))}
        self.endings.update(self.scores)
        self.sizes = np.array([len(t) for t in self.text], np.int64)
        self.begins = np.cumsum(self.sizes) - self.sizes
        self.joined = np.frombuffer(b"".join(self.text), np.uint8)
        self.unknown = min(s for s, _ in self.scores.values()) - UNKNOWN

    def encode_sorted(self, words: list[str]) -> Iterator[bytes]:
        """Ids of every word of a sorted list, as little-endian 32-bit numbers."""
        find, unknown = self.endings.get, self.unknown
        best, came = [0.0], [None]  # by prefix length: forward score, (begin, id) of the last piece
        before = ""
        for word in words:
            shared = 0
            for x, y in zip(before, word):
                if x != y:
                    break
                shared += 1
            del best[shared + 1:], came[shared + 1:]
            for end in range(shared + 1, len(word) + 1):
                top, step = best[end - 1] + unknown, None
                for begin in range(end - 1, -1, -1):
                    found = find(word[begin:end])
                    if found is None:
                        break
                    if found and (total := best[begin] + found[0]) >= top:
                        top, step = total, (begin, found[1])
                best.append(top)
                came.append(step)
            ids, end = [], len(word)
            while end:
                if came[end] is None:
                    ids.extend(self.byte[b] for b in reversed(word[end - 1].encode()))
                    end -= 1
                else:
                    end, piece = came[end]
                    ids.append(piece)
            before = word
            ids.reverse()
            yield array("i", ids).tobytes()

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> list[bytes]:
        """UTF-8 of rows of ids that lie one after the other; ``ends`` are the rows' ends."""
        sizes = self.sizes[ids]
        into = np.cumsum(sizes)
        total = int(into[-1]) if len(into) else 0
        at = np.repeat(self.begins[ids] - (into - sizes), sizes) + np.arange(total, dtype=np.int64)
        text = self.joined[at].tobytes()
        cuts = np.concatenate(([0], into))[np.concatenate(([0], ends))].tolist()
        return [text[a + (text[a:a + 1] == b" " and b > a):b] for a, b in zip(cuts, cuts[1:])]


class Known:
    """Ids of words met lately: two generations, so that frequent words stay when room runs out."""

    def __init__(self, pieces: Pieces, room: int = KEPT):
        self.pieces, self.room = pieces, room
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def of(self, words: set[str]) -> dict[str, bytes]:
        """A mapping that has all of ``words``."""
        if len(self.young) > self.room // 2:
            self.old, self.young = self.young, {}
        missing = words.difference(self.young)
        again = missing.intersection(self.old)
        self.young.update((w, self.old[w]) for w in again)
        new = sorted(missing.difference(again))
        self.young.update(zip(new, self.pieces.encode_sorted(new)))
        return self.young


def _encoded(batches: Iterator[pa.RecordBatch], model: str | None):
    """Steps of rows with their texts, the flat ids of all, and the end of each row in them."""
    pieces = Pieces(model or model_path())
    known = Known(pieces)
    for batch in steps(batches, step_bytes=2 << 20):
        texts = batch.column("text").to_pylist()
        words = [MARKED.findall(" " + t) if t else [] for t in texts]
        ids_of = known.of(set().union(*words))
        parts = [b"".join(map(ids_of.__getitem__, w)) for w in words]
        ends = np.cumsum([len(p) // 4 for p in parts], dtype=np.int64)
        yield batch, texts, np.frombuffer(b"".join(parts), np.int32), ends


def _lists(ids: np.ndarray, ends: np.ndarray, texts: list) -> pa.Array:
    return pa.ListArray.from_arrays(
        pa.array(np.concatenate(([0], ends)).astype(np.int32)), pa.array(ids),
        mask=pa.array([t is None for t in texts], pa.bool_()))


def model_path(name: str = MODEL) -> str:
    """Place of a public tokenizer file on the machine that asks."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _fields(df: DataFrame, keep: tuple[str, ...]) -> str:
    return "".join(f"`{k}` {df.schema[k].dataType.simpleString()}, " for k in keep)


def encode(docs: DataFrame, model: str | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """``(doc_id, *keep, ids)`` with the ids of every whole text, one row for every row of ``docs``.

    A NULL text has NULL ids, an empty one none. ``model`` is a path that every executor has (by
    default the installed public file). Other columns are ignored; NULL and repeated doc_ids stay as
    they are, and an empty table gives no rows.
    """
    def per_task(batches):
        for batch, texts, ids, ends in _encoded(batches, model):
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(batch.column(k) for k in keep), _lists(ids, ends, texts)],
                ["doc_id", *keep, "ids"])

    source = docs.select("doc_id", "text", *(k for k in keep if k != "text"))
    return source.mapInArrow(per_task, f"doc_id long, {_fields(source, keep)}ids array<int>")


def decode(encoded: DataFrame, model: str | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """``(doc_id, *keep, text)`` from ``ids``: the exact texts that were encoded. NULL ids: NULL.

    A leading blank is the mark of the first word and goes; ids that are no valid UTF-8 together are
    decoded with replacement signs.
    """
    def per_task(batches):
        pieces = Pieces(model or model_path())
        for batch in batches:
            for begin in range(0, batch.num_rows, 500):
                part = batch.slice(begin, 500)
                lists = part.column("ids")
                sizes = np.array([len(x) if x.is_valid else 0 for x in lists], np.int64)
                ids = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                texts = [t.decode("utf-8", "replace") if x.is_valid else None
                         for t, x in zip(pieces.decode(ids, np.cumsum(sizes)), lists)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *(part.column(k) for k in keep),
                     pa.array(texts, pa.string())], ["doc_id", *keep, "text"])

    source = encoded.select("doc_id", "ids", *(k for k in keep if k != "ids"))
    return source.mapInArrow(per_task, f"doc_id long, {_fields(source, keep)}text string")


def round_trip(docs: DataFrame, model: str | None = None) -> DataFrame:
    """``(doc_id, n_pieces, round_trip, ids)``: texts encoded, and whether the ids decode to them.

    Encodes and decodes in one pass, with the rules of :func:`encode` and :func:`decode`; a NULL text
    has NULL ``n_pieces`` and ``ids``, and its ``round_trip`` is true.
    """
    def per_task(batches):
        pieces = Pieces(model or model_path())
        for batch, texts, ids, ends in _encoded(batches, model):
            same, begin = [], 0
            while begin < len(texts):  # decoded about a million ids at a time
                first = int(ends[begin - 1]) if begin else 0
                end = max(begin + 1, int(np.searchsorted(ends, first + (1 << 20))))
                found = pieces.decode(ids[first:ends[end - 1]], ends[begin:end] - first)
                same += [f == (t or "").encode() for f, t in zip(found, texts[begin:end])]
                begin = end
            sizes = np.diff(np.concatenate(([0], ends)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"),
                 pa.array(sizes, mask=np.array([t is None for t in texts], bool)),
                 pa.array(same, pa.bool_()), _lists(ids, ends, texts)],
                ["doc_id", "n_pieces", "round_trip", "ids"])

    return docs.select("doc_id", "text").mapInArrow(
        per_task, "doc_id long, n_pieces long, round_trip boolean, ids array<int>")
