"""Token counts as a public BPE vocabulary gives them, by rank-synchronous merging of arrays.

Pre-tokens never hold white space, so a text has as many tokens as its white-space words. The words
a task hasn't met yet are cut into pre-tokens, and those are held as one ragged array of symbols. In
every round each pre-token takes the pair of lowest rank that it holds, at all its places at once;
pre-tokens without a pair that merges leave. The symbols that survive are counted.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tunemill.llm.common import steps

VOCABULARY = "word_bpe_49k.json"
LIMIT = 2048
#: Words whose counts a task keeps.
KEPT = 600_000
#: Separators that Python takes for white space and the vocabulary's patterns do not.
NOT_WHITE = "\x1c\x1d\x1e\x1f"
#: Symbols merged in one array at most, but for a single longer word.
ROOM = 4 << 20


class RankMerger:
    """Counts tokens of words by the merges of a ``tokenizers`` file with byte-level symbols."""

    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.suffix = model.get("end_of_word_suffix") or ""
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        number = dict(model["vocab"])
        for pair in merges:
            for part in (*pair, "".join(pair)):
                number.setdefault(part, len(number))
        self.size = len(number)
        pairs = np.array([number[a] * self.size + number[b] for a, b in merges], np.int64)
        order = np.argsort(pairs, kind="stable")
        self.pairs, self.ranks = pairs[order], order.astype(np.int32)
        self.merged = np.array([number["".join(m)] for m in merges], np.int32)
        letters = self._byte_letters()
        self.inner = np.array([number[c] for c in letters], np.int32)
        self.final = np.array([number[c + self.suffix] for c in letters], np.int32)
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        pattern = split["pattern"]["Regex"].replace(r"\s", r"\p{White_Space}")
        self.find = regex.compile(pattern).findall
        special = [t["content"] for t in spec["added_tokens"] if t["special"]]
        self.special = regex.compile("|".join(map(regex.escape, special)))

    @staticmethod
    def _byte_letters() -> list[str]:
        """The letter that stands for each byte: printable ones for themselves, the rest from 256 on."""
        plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
        others = iter(range(256, 512))
        return [chr(b if b in plain else next(others)) for b in range(256)]

    def pretokens(self, word: str) -> tuple[list[str], int]:
        """Pre-tokens of a word, and how many special tokens stand in it."""
        import unicodedata

        parts = self.special.split(word) if "<|" in word else [word]
        found: list[str] = []
        for part in parts:
            # lower case by character: no special form of sigma at the end of a word
            found += self.find(unicodedata.normalize("NFC", part).replace("Σ", "σ").lower())
        return found, len(parts) - 1

    def merge(self, pretokens: list[str]) -> np.ndarray:
        """Symbols that survive in each of ``pretokens``."""
        data = [p.encode() for p in pretokens]
        sizes = np.fromiter(map(len, data), np.int64, len(data))
        raw = np.frombuffer(b"".join(data), np.uint8)
        symbols = self.inner[raw]
        ends = np.cumsum(sizes)
        symbols[ends - 1] = self.final[raw[ends - 1]]
        owner = np.repeat(np.arange(len(data)), sizes)
        counts = np.zeros(len(data), np.int64)
        none = np.int32(2**31 - 1)
        while len(symbols):
            codes = symbols[:-1].astype(np.int64) * self.size + symbols[1:]
            at = np.minimum(np.searchsorted(self.pairs, codes), len(self.pairs) - 1)
            rank = np.where((self.pairs[at] == codes) & (owner[:-1] == owner[1:]), self.ranks[at], none)
            rank = np.append(rank, none)
            starts = np.concatenate(([0], np.flatnonzero(owner[1:] != owner[:-1]) + 1))
            lowest = np.minimum.reduceat(rank, starts)
            lengths = np.diff(np.append(starts, len(symbols)))
            done = lowest == none
            counts[owner[starts[done]]] = lengths[done]
            least = np.repeat(lowest, lengths)
            hit = (rank == least) & (least != none)
            # of places that overlap (one symbol repeated) every second one counts, from the left
            where = np.flatnonzero(hit)
            if len(where):
                first = np.concatenate(([True], np.diff(where) > 1))
                begin = where[first][np.cumsum(first) - 1]
                where = where[(where - begin) % 2 == 0]
                symbols[where] = self.merged[rank[where]]
            stays = np.repeat(~done, lengths)
            stays[where + 1] = False
            symbols, owner = symbols[stays], owner[stays]
        return counts

    def counts(self, words: list[str]) -> Iterator[int]:
        """Tokens of each word, in order."""
        begin = 0
        while begin < len(words):
            flat: list[str] = []
            owned, extra, end, room = [], [], begin, 0
            while end < len(words) and (room < ROOM or end == begin):
                found, special = self.pretokens(words[end])
                flat += found
                owned.append(len(found))
                extra.append(special)
                room += len(words[end])
                end += 1
            kinds = {p: i for i, p in enumerate(dict.fromkeys(flat))}
            per = self.merge(list(kinds)) if kinds else np.zeros(0, np.int64)
            tokens = per[np.fromiter(map(kinds.__getitem__, flat), np.int64, len(flat))]
            sums = np.concatenate(([0], np.cumsum(tokens)))
            ends = np.cumsum(owned)
            yield from (sums[ends] - sums[ends - owned] + extra).tolist()
            begin = end


def split_words(text: str) -> list[str]:
    """White-space words by the Unicode property."""
    if any(c in text for c in NOT_WHITE):
        import regex

        return regex.split(r"\p{White_Space}+", text)
    return text.split()


def token_counts(docs: DataFrame, vocabulary: str | None = None, limit: int = LIMIT) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)`` for every row of ``docs``, whole texts.

    Special strings in a text count as their one token, nothing is added around it. NULL texts count
    as empty. Other columns are ignored, NULL and repeated doc_ids stay, an empty table gives no rows.
    ``vocabulary`` is a path that every executor has (by default the installed public file).
    """
    def per_task(batches):
        import public_tokenizers

        merger = RankMerger(vocabulary or public_tokenizers.path(VOCABULARY))
        known: dict[str, int] = {}
        for batch in steps(batches, step_bytes=16 << 20):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            words = [split_words(t) for t in texts]
            new = list(set().union(*words).difference(known))
            if len(known) + len(new) > max(KEPT, 2 * len(new)):
                known.clear()
                new = list(set().union(*words))
            known.update(zip(new, merger.counts(new)))
            tokens = np.array([sum(map(known.__getitem__, w)) for w in words], np.int64)
            size = np.array([len(t.encode()) for t in texts], np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(size), pa.array(tokens), pa.array(tokens > limit)],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.select("doc_id", "text").mapInArrow(
        per_task, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
