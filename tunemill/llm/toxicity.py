"""Toxicity behind a noisy channel: disguised words are restored by Viterbi search, then scored.

Every run of signs that has a look-alike, a wildcard, a mark between letters, a letter twice in a row,
or is of single letters set apart, makes a lattice: what each character may stand for, or that it stands
for nothing, each at a cost. The path with the best sum of channel costs and log-probabilities of a
character model (counted over all documents) is the restored word; no path is left out. A mark at an
end of a run may be a letter or nothing, and the word is restored both ways. Plain words are their own
restoration.

Scoring takes the restored words. A word's features are itself and its beginnings; a feature weighs
as much as toxic documents hold it more often than others, less for rare ones. A document's score is
a logistic function of its worst words, their sum and their share, fitted on the labels. Weights are
counted in two halves of the labelled rows, and each half's documents are rated by the other half's
weights for that fit, so that weights that merely remember a document count for nothing.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunemill.llm.charlm import alphabet, count_ngrams, log_probabilities
from tunemill.llm.common import steps
from tunemill.session import written

ORDER = 3
LETTERS = "abcdefghijklmnopqrstuvwxyz"
#: What a sign may stand for.
LOOKS = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "bg", "7": "t", "8": "b", "9": "g",
         "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l", "¡": "i", "§": "s"}
#: Signs that may stand for any letter, and signs set between letters.
ANY = "*#"
BETWEEN = " .-_*~'`,/\\"
#: Costs: a look-alike, a letter kept out, a wildcard, a sign between letters, a repeated letter, another sign.
COST_LOOK, COST_ANY, COST_BETWEEN, COST_REPEAT, COST_LOST = 1.0, 2.0, 0.7, 2.5, 9.0
#: Signs between two kept columns of costs of the search, from which its way back is found again.
PART = 1024
#: Marks before and after a word whose part of the search is kept for all words with the same marks; with
#: more marks a word is searched on its own. Ends kept at most.
MARKS_BEFORE, MARKS_AFTER, KEPT_ENDS = 8, 64, 256

HELD_OUT, FOLDS = 1, 3
THRESHOLD = 0.7
SLOTS = 1 << 18
FEATURE_PREFIXES = range(3, 9)
LEAST_SUPPORT = 3.0
#: Labelled documents of each label that the classifier is fitted on at most.
SAMPLE = 20_000
KEPT = 300_000

#: What opens and closes a word, left out before anything else, and runs of other signs at an end.
TRIMS = ".,;:!?\"'()[]{}<>*#%&|-_+=~`/\\…«»“”‘’¡¿"
#: States of the search: all pairs of last letters, none is ever left out.
BEAM = (len(LETTERS) + 2) ** 2
ODD = re.compile(f"[{re.escape(''.join(LOOKS) + ANY + BETWEEN)}]|([a-z])\\1")
DOUBLED = re.compile(r"([a-z])\1+")
LETTERS_ONLY = re.compile("[a-z]+")
APART = re.compile(r"(?<!\S)(?:\S[ \t.\-_*]){2,}\S(?!\S)")


def held_out(doc_id: Column) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(FOLDS)) == HELD_OUT


class Restorer:
    """Viterbi decoder of disguised words under a character model with two letters of context."""

    def __init__(self, logs: np.ndarray):
        size = len(LETTERS) + 2
        self.size = size
        self.table = np.asarray(logs, np.float64).reshape(size, size, size)
        self.logs = self.table.tolist()
        self.number = {c: i for i, c in enumerate(LETTERS, 1)}
        self.known: dict[str, list] = {}
        self.begun: dict[tuple, dict] = {}
        self.ends: dict[tuple, tuple[list, list]] = {}

    def options(self, sign: str) -> list[tuple[int | None, float]]:
        """Letters that a sign may stand for, with costs; None: for nothing. A blank may end a word."""
        found: list[tuple[int | None, float]] = []
        if sign in self.number:
            found.append((self.number[sign], 0.0))
        found += [(self.number[c], COST_LOOK) for c in LOOKS.get(sign, "")]
        if sign in ANY:
            found += [(i, COST_ANY) for i in self.number.values()]
        if sign == " ":
            found.append((0, 0.0))
        if sign in BETWEEN:
            found.append((None, COST_BETWEEN))
        elif sign not in self.number:
            found.append((None, COST_LOST) if sign.isascii() else (self.size - 1, 0.0))
        return found

    def inside(self, word: str) -> list[tuple[str, list]]:
        """Lattice of a word: its signs with their options."""
        return [(c, self.known.get(c) or self.known.setdefault(c, self.options(c))) for c in word]

    def edge(self, marks: str, forced: str = "") -> list[tuple[str, list]]:
        """Lattice of the marks at an end of a word: letters or, but for those at ``1`` in ``forced``, nothing."""
        found = []
        for sign, must in zip(marks, forced or "0" * len(marks)):
            letters = [o for o in self.options(sign) if sign in LOOKS or sign in ANY if o[0] not in (None, self.size - 1)]
            found.append((sign, letters if must == "1" else [*letters, (None, COST_BETWEEN)]))
        return found

    @staticmethod
    def forced(marks: str, innermost: int) -> list[str]:
        """Which marks at an end are taken as letters: none (nothing), all that may be, and at least the innermost of these."""
        may = [i for i, c in enumerate(marks) if c in LOOKS or c in ANY]
        if not may:
            return [""]
        every = "".join("1" if c in LOOKS or c in ANY else "0" for c in marks)
        one = "".join("1" if i == may[innermost] else "0" for i in range(len(marks)))
        return ["", *dict.fromkeys((every, one))]

    def restore(self, word: str) -> str:
        """The likeliest plain words behind ``word`` (lower case); other letters stay as they are."""
        return self.best(self.inside(word))

    def best(self, lattice: list[tuple[str, list]]) -> str:
        """The reading of least cost, by all states."""
        wide = [len(options) > 4 for _, options in lattice]
        many = len(lattice) > PART or any(x and y for x, y in zip(wide, wide[1:]))
        return self._by_arrays(lattice) if many else self._by_states(lattice)

    def _by_states(self, lattice: list[tuple[str, list]]) -> str:
        """For lattices of few options: states in a dictionary."""
        return self._ended(self._states({(0, 0): (0.0, None)}, lattice))

    def _states(self, states: dict, lattice: list[tuple[str, list]], before: str = "") -> dict:
        """States after more signs. By the last two letters: cost so far, and the letters as a chain from the last."""
        logs, other = self.logs, self.size - 1
        for sign, options in lattice:
            after: dict[tuple[int, int], tuple[float, tuple | None]] = {}
            for (a, b), (cost, chain) in states.items():
                ahead = logs[a][b]
                for letter, price in options:
                    if letter is None:
                        key, total, link = (a, b), cost + price, chain
                    else:
                        key, total = (b, letter), cost + price - ahead[letter]
                        link = (letter if letter < other else sign, chain)
                    if key not in after or total < after[key][0]:
                        after[key] = (total, link)
                    if letter and letter == b and (letter < other or sign == before) and (
                            cost + COST_REPEAT + price < after.get((a, b), (math.inf,))[0]):
                        after[(a, b)] = (cost + COST_REPEAT + price, chain)
            states, before = after, sign
        return states

    def _ended(self, states: dict, end: tuple[list, list] | None = None) -> str:
        """The reading of least cost, with the best way through ``end`` (see :meth:`_end`)."""
        if end is None:
            (a, b), (_, chain) = min(states.items(), key=lambda s: s[1][0] - self.logs[s[0][0]][s[0][1]][0])
            return self._spelled(chain)
        ahead, choices = end
        size = self.size
        (a, b), (_, chain) = min(states.items(), key=lambda s: s[1][0] + ahead[s[0][0] * size + s[0][1]])
        for choice in choices:
            letter = choice[a * size + b]
            if letter != size:
                a, b, chain = b, letter, (letter, chain)
        return self._spelled(chain)

    @staticmethod
    def _spelled(chain: tuple | None) -> str:
        letters = []
        while chain is not None:
            letters.append(chain[0] if isinstance(chain[0], str) else " " if chain[0] == 0 else LETTERS[chain[0] - 1])
            chain = chain[1]
        return "".join(reversed(letters))

    def _end(self, marks: str, forced: str) -> tuple[list, list]:
        """The search from its end through the marks after a word, for all states before them.

        By state: the least cost of what follows, and for each mark the letter that it stands for (``size``: none).
        It depends on nothing before the two last letters, so all words with these marks share it.
        """
        key = (marks, forced)
        if key not in self.ends:
            if len(self.ends) >= KEPT_ENDS:
                self.ends.clear()
            size, choices = self.size, []
            ahead = -self.table[:, :, 0]
            for _, options in reversed(self.edge(marks, forced)):
                best, choice = np.full((size, size), np.inf), np.full((size, size), size, np.uint8)
                for letter, price in options:
                    if letter is None:
                        total, taken = price + ahead, size
                    else:
                        total, taken = price - self.table[:, :, letter] + ahead[:, letter][None, :], letter
                    better = total < best
                    best[better], choice[better] = total[better], taken
                    if letter is not None:
                        again = COST_REPEAT + price + ahead[:, letter]
                        better = again < best[:, letter]
                        best[better, letter], choice[better, letter] = again[better], size
                ahead = best
                choices.append(choice.tobytes())
            self.ends[key] = (ahead.reshape(-1).tolist(), choices[::-1])
        return self.ends[key]

    def readings(self, before: str, bare: str, behind: str) -> Iterator[str]:
        """Readings of a word with marks around it, these as nothing and as letters; a word that isn't odd and its marks
        as nothing is no reading."""
        odd = " " in bare or ODD.search(bare)
        lefts, rights = self.forced(before, -1), self.forced(behind, 0)
        if odd and len(lefts) == len(rights) == 1:
            yield self.doubled(bare) if LETTERS_ONLY.fullmatch(bare) else self.best(self.inside(bare))
            return
        if len(lefts) == len(rights) == 1:
            return
        middle = self.inside(bare)
        wide = [len(options) > 4 for _, options in middle]
        alone = (len(before) > MARKS_BEFORE or len(behind) > MARKS_AFTER or len(bare) > PART
                 or any(x and y for x, y in zip(wide, wide[1:])))
        for left in lefts:
            states = None
            for right in rights:
                if not (odd or left or right):
                    continue
                if alone:
                    yield self.best((self.edge(before, left) if left else []) + middle
                                    + (self.edge(behind, right) if right else []))
                    continue
                if states is None:
                    states = self._states(self._begun(before, left), middle, before[-1:] if left else "")
                yield self._ended(states, self._end(behind, right) if right else None)

    def _begun(self, marks: str, forced: str) -> dict:
        """States after the marks before a word."""
        key = (marks, forced) if forced else ("", "")
        if key not in self.begun:
            if len(self.begun) >= KEPT_ENDS:
                self.begun.clear()
            self.begun[key] = self._states({(0, 0): (0.0, None)}, self.edge(*key))
        return self.begun[key]

    def doubled(self, word: str) -> str:
        """The reading of least cost of a word of letters only, where nothing but repeated letters can go.

        How many of a run of one letter stay changes no log-probability but that of the letters in the run and of the one
        after it, so each run is settled by itself.
        """
        logs, number = self.logs, self.number

        def settled(m: re.Match) -> str:
            begin, end = m.span()
            own = number[m[1]]
            last = number[word[begin - 1]] if begin else 0
            then = number[word[end]] if end < len(word) else 0
            price = logs[last][own][own] + logs[own][own][then]
            ways = [price + (n - 2) * logs[own][own][own] - COST_REPEAT * (end - begin - n) for n in range(end - begin, 1, -1)]
            ways.append(logs[last][own][then] - COST_REPEAT * (end - begin - 1))
            return m[1] * (end - begin - ways.index(max(ways)))

        return DOUBLED.sub(settled, word)

    def _column(self, costs: np.ndarray, options: list, repeats_other: bool) -> tuple[np.ndarray, np.ndarray]:
        """Costs of all states after a sign, and the state before each: below 0 (-1 - state) if no letter came."""
        size = self.size
        after = np.full((size, size), np.inf)
        back = np.zeros((size, size), np.int16)
        letters = [(x, p) for x, p in options if x is not None]
        if letters:
            at = np.array([x for x, _ in letters])
            ways = costs[:, :, None] - self.table[:, :, at]
            first = ways.argmin(axis=0)
            after[:, at] = np.take_along_axis(ways, first[None], 0)[0] + np.array([p for _, p in letters])
            back[:, at] = first * size + np.arange(size)[:, None]
        stay = np.full(size, np.inf)  # price of no letter, by the last letter
        for letter, price in options:
            if letter is None:
                np.minimum(stay, price, out=stay)
            elif letter and (letter < size - 1 or repeats_other):
                stay[letter] = min(stay[letter], COST_REPEAT + price)
        stayed = costs + stay
        same = stayed < after
        after[same] = stayed[same]
        back[same] = -1 - np.arange(size * size, dtype=np.int16).reshape(size, size)[same]
        return after, back.reshape(-1)

    def _by_arrays(self, lattice: list[tuple[str, list]]) -> str:
        """For any lattice: columns of all states. Of a long one the way back is computed again by parts."""
        size = self.size
        again = [False, *(x[0] == y[0] for x, y in zip(lattice, lattice[1:]))]
        costs = np.full((size, size), np.inf)
        costs[0, 0] = 0.0
        kept, backs = [], []
        for i, (_, options) in enumerate(lattice):
            if i % PART == 0:
                kept.append(costs)
                backs = []
            costs, back = self._column(costs, options, again[i])
            backs.append(back)
        state = int((costs - self.table[:, :, 0]).argmin())
        letters = []
        for part in range(len(kept) - 1, -1, -1):
            begin = part * PART
            if part < len(kept) - 1:
                costs, backs = kept[part], []
                for i in range(begin, begin + PART):
                    costs, back = self._column(costs, lattice[i][1], again[i])
                    backs.append(back)
            for i in range(len(backs) - 1, -1, -1):
                came = int(backs[i][state])
                if came < 0:
                    continue
                letter = state % size
                letters.append(" " if letter == 0 else LETTERS[letter - 1] if letter < size - 1 else lattice[begin + i][0])
                state = came
        return "".join(reversed(letters))


def raw_words(text: str) -> Counter:
    """Runs of signs of a text (lower case) and of letters set apart, and how often each stands in it."""
    lower = text.lower()
    counts = Counter(lower.split())
    for run in APART.findall(lower):
        counts[run] += 1
    return counts


def split_marks(raw: str) -> tuple[str, str, str]:
    """Marks before a word, the word, and marks after it."""
    bare = raw.strip(TRIMS)
    begin = len(raw) - len(raw.lstrip(TRIMS))
    return raw[:begin], bare, raw[begin + len(bare):]


def plain_words(raw: str, restorer: Restorer) -> tuple[str, ...]:
    """Words behind a run of signs: as it stands without marks around it, and restored if it is odd.

    Marks around it that may be letters are tried as nothing and as letters. Marks alone are no word.
    """
    if not ODD.search(raw):
        bare = raw.strip(TRIMS)
        return (bare,) if bare else ()
    before, bare, behind = split_marks(raw)
    if not bare:
        return ()
    found = {bare}
    for reading in restorer.readings(before, bare, behind):
        found.update(reading.split())
    return tuple(sorted(w for w in (f.strip(TRIMS) for f in found) if w))


def features(word: str) -> list[int]:
    """Slots of a word: itself, and its beginnings by bytes."""
    crc, data = zlib.crc32, word.encode()
    return [crc(b"=" + data) & (SLOTS - 1)] + [
        crc(data[:k]) & (SLOTS - 1) for k in FEATURE_PREFIXES[:max(0, len(data) - FEATURE_PREFIXES[0])]]


class Kept(dict):
    """What ``make`` gives for keys met before; emptied when it grows over ``KEPT``."""

    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, key):
        if len(self) >= KEPT:
            self.clear()
        value = self[key] = self.make(key)
        return value


def worst_weight(words, weights: list[float]) -> float:
    """Weight of the worst of some words."""
    worst = 0.0
    for word in words:
        own, *begun = [weights[i] for i in features(word)]
        worst = max(worst, own + 0.5 * max(begun, default=0.0))
    return worst


def weigher(restorer: Restorer, weights: list[float]) -> Kept:
    """Weight of a run of signs: that of the worst word it may be."""
    return Kept(lambda raw: worst_weight(plain_words(raw, restorer), weights))


@dataclass
class Model:
    """All that scoring needs; of fixed size."""

    logs: np.ndarray
    weights: np.ndarray
    logistic: np.ndarray

    def score(self, rated: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(design(rated) @ self.logistic, -30, 30)))


RATINGS = 5
#: Words of less weight count for nothing.
BAR = 1.0


def rated(text: str, weight_of: Kept) -> list[float]:
    """What a text's words come to: the three worst, the sum of those above a bar, and their share."""
    counts = raw_words(text)
    return ratings_of(((weight_of[raw], n) for raw, n in counts.items()), counts.total())


def ratings_of(weighed, total_words: int) -> list[float]:
    """Ratings of a text by ``(weight, count)`` of its runs."""
    bad = [(weight, n) for weight, n in weighed if weight > BAR]
    if not bad:
        return [0.0] * RATINGS
    worst = sorted((w for w, _ in bad), reverse=True)[:3]
    total = sum(w * min(n, 3) for w, n in bad)
    return [*worst, *[0.0] * (3 - len(worst)), total, total / (total_words + 20.0)]


def design(ratings: np.ndarray) -> np.ndarray:
    x = ratings.reshape(-1, RATINGS)
    return np.column_stack([np.ones(len(x)), x[:, 0], x[:, 1], x[:, 2], np.log1p(x[:, 3]), np.log1p(20 * x[:, 4])])


def _labelled(docs: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    """Texts of at most ``sample`` documents of each label, those of the least hashes; ``half`` splits them.

    The sampled ids have a bound, so they are broadcast and the texts are not shuffled.
    """
    known = (labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
             .where(~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.when(F.max("toxic") > 0, 1).otherwise(0).alias("toxic"))
             .withColumn("_hash", F.xxhash64("doc_id")))
    kept = [known.where(F.col("toxic") == kind).orderBy("_hash", "doc_id").limit(sample) for kind in (0, 1)]
    chosen = written(kept[0].union(kept[1]).select("doc_id", "toxic"), "label-sample")
    return (docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select(
        "doc_id", "text", "toxic", F.pmod(F.xxhash64("doc_id"), F.lit(2)).cast("int").alias("half")))


def _read(rows: DataFrame, logs: np.ndarray) -> DataFrame:
    """``(half, toxic, words, counts)``: for each run of signs of a text the words that it may be (runs by line, their
    words set apart by blanks), and how often it stands there. So the sample is searched once."""
    sent = rows.sparkSession.sparkContext.broadcast(logs)

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(sent.value)
        words_of = Kept(lambda raw: " ".join(plain_words(raw, restorer)))
        for batch in steps(batches):
            runs = [raw_words(text or "") for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("half"), batch.column("toxic"),
                 pa.array(["\n".join(map(words_of.__getitem__, r)) for r in runs], pa.string()),
                 pa.array([list(r.values()) for r in runs], pa.list_(pa.int32()))],
                ["half", "toxic", "words", "counts"])

    return rows.select("text", "half", "toxic").mapInArrow(
        per_task, "half int, toxic int, words string, counts array<int>")


def _feature_counts(read: DataFrame) -> np.ndarray:
    """Documents that hold each feature slot, by half and label: an array (2, 2, slots + 1)."""
    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots_of = Kept(lambda words: tuple(i for w in words.split(" ") if w for i in features(w)))
        sums = np.zeros((2, 2, SLOTS + 1), np.int64)
        for batch in steps(batches, "words"):
            for words, half, toxic in zip(*(batch.column(c).to_pylist() for c in ("words", "half", "toxic"))):
                slots = set().union(*map(slots_of.__getitem__, words.split("\n")))
                sums[half, toxic, list(slots)] += 1
                sums[half, toxic, SLOTS] += 1
        flat = sums.reshape(-1)
        at = np.flatnonzero(flat)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(flat[at])], ["at", "n"])

    counts = (read.select("words", "half", "toxic")
              .mapInArrow(per_task, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow())
    out = np.zeros(2 * 2 * (SLOTS + 1))
    out[counts.column("at").to_numpy()] = counts.column("n").to_numpy()
    return out.reshape(2, 2, SLOTS + 1)


def feature_weights(counts: np.ndarray) -> np.ndarray:
    """Log ratio of the shares of toxic and other documents, shrunk where toxic ones are few."""
    others, toxic = counts
    ratio = np.log((toxic[:-1] + 0.5) / (toxic[-1] + 1)) - np.log((others[:-1] + 0.5) / (others[-1] + 1))
    return (ratio * toxic[:-1] / (toxic[:-1] + LEAST_SUPPORT) * (toxic[:-1] >= 2)).astype(np.float32)


def _ratings(read: DataFrame, by_half: list[np.ndarray]) -> DataFrame:
    """``(toxic, ratings)`` of each text, by the weights at its ``half``."""
    sent = read.sparkSession.sparkContext.broadcast(by_half)

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight_of = []
        for weights in sent.value:
            own = weights.tolist()
            weight_of.append(Kept(lambda words, own=own: worst_weight(filter(None, words.split(" ")), own)))
        for batch in steps(batches, "words"):
            found = [ratings_of(zip(map(weight_of[half].__getitem__, words.split("\n")), counts), sum(counts))
                     for words, counts, half in zip(*(batch.column(c).to_pylist() for c in ("words", "counts", "half")))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("toxic"), pa.array(found, pa.list_(pa.float64()))], ["toxic", "ratings"])

    return read.mapInArrow(per_task, "toxic int, ratings array<double>")


def restored(docs: DataFrame) -> DataFrame:
    """``(doc_id, text)`` with disguised words as plain ones and all in lower case, by a model of ``docs``.

    White space becomes single blanks; a word that isn't odd stays without the marks around it. NULL
    texts stay NULL.
    """
    sent = docs.sparkSession.sparkContext.broadcast(character_model(docs))

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(sent.value)
        words = Kept(lambda raw: best_words(raw, restorer))
        for batch in steps(batches):
            texts = []
            for text in batch.column("text").to_pylist():
                joined = None if text is None else APART.sub(
                    lambda m: restorer.restore(m[0]).replace(" ", "\0"), text.lower())
                texts.append(None if text is None else " ".join(
                    filter(None, (words[w] for w in joined.split()))).replace("\0", " "))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return docs.select("doc_id", "text").mapInArrow(per_task, "doc_id long, text string")


def best_words(raw: str, restorer: Restorer) -> str:
    """The likeliest reading of a run of signs alone."""
    before, bare, behind = split_marks(raw)
    if not bare or not ODD.search(raw):
        return bare
    return restorer.best(restorer.edge(before) + restorer.inside(bare) + restorer.edge(behind)).strip(TRIMS)


def character_model(docs: DataFrame) -> np.ndarray:
    """Log-probabilities of letters after two others, counted over all documents."""
    table = alphabet(" ".join(LETTERS))
    grams = count_ngrams(docs.select("text", F.lit(0).alias("label")), "label", table, ORDER).toArrow()
    return log_probabilities(grams.column("code").to_numpy(), grams.column("n").to_numpy(),
                             int(table.max()) + 1, ORDER)


def _logistic(ratings: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Weights by Newton steps, with a small penalty."""
    x, w = design(ratings), np.zeros(RATINGS + 1)
    penalty = np.diag([1e-3] + [0.05] * RATINGS)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - labels) + penalty @ w
        w -= np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, gradient)
    return w


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Character model of all documents; feature weights and logistic function of labelled ones."""
    logs = character_model(docs)
    read = written(_read(_labelled(docs, labels, sample), logs), "labelled")
    counts = _feature_counts(read)
    weights = feature_weights(counts.sum(axis=0))
    found = _ratings(read, [feature_weights(counts[1]), feature_weights(counts[0])]).toArrow()
    rows_of = np.array(found.column("ratings").to_pylist(), np.float64).reshape(-1, RATINGS)
    toxic = found.column("toxic").to_numpy()
    kept = [rows_of[toxic == kind] for kind in (0, 1)]
    if min(map(len, kept)) == 0:
        logistic = np.array([-2.0] + [0.0] * RATINGS)
    else:
        logistic = _logistic(np.concatenate(kept), np.repeat([0.0, 1.0], list(map(len, kept))))
    return Model(logs, weights, logistic)


def scored(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, sample: int = SAMPLE,
           carry: bool = False) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for every row of ``docs``.

    Labels count only for documents that are not held out; a document labelled twice counts as toxic
    if one label says so. NULL and empty texts get the score of a text without words. A NULL doc_id
    has a NULL ``held_out`` and teaches nothing. Without labels of both kinds every score is low and
    the same. Other columns are ignored, repeated rows stay, an empty table gives no rows. With
    ``carry`` the columns are those of ``docs`` and, in place of any of that name, ``predicted``.
    """
    model = fit(docs, labels, sample)
    # arrays only: a class in a broadcast would need the package on the executors
    sent = docs.sparkSession.sparkContext.broadcast((model.logs, model.weights, model.logistic))
    if carry:
        rows = docs.drop("predicted")
        fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema]
    else:
        rows = docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out"))
        fields = ["doc_id long", "held_out boolean", "score double"]

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*sent.value)
        weight_of = weigher(Restorer(own.logs), own.weights.tolist())
        for batch in steps(batches):
            ratings = np.array([rated(t or "", weight_of) for t in batch.column("text").to_pylist()], np.float64)
            scores = own.score(ratings) if len(ratings) else np.zeros(0)
            columns = dict(zip(batch.schema.names, batch.columns))
            if not carry:
                columns = {"doc_id": columns["doc_id"], "held_out": columns["held_out"], "score": pa.array(scores)}
            columns["predicted"] = pa.array((scores >= threshold).astype(np.int32))
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return rows.mapInArrow(per_task, ", ".join([*fields, "predicted int"]))
