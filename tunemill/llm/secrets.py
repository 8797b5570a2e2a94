"""Secret scan: patterns, and a character convolutional network over other candidates in context.

The patterns' values are labelled findings. A candidate is a run of key characters; a run that patterns
touch is cut at their spans, and what is left of it is candidates of their own, so nothing goes unjudged
that is eight characters long. A long candidate is seen through overlapping windows with the characters
around them, and its score is their greatest. The network (numpy) learns from a bounded sample of
findings and other candidates, and gives every candidate one score, which is stored; its threshold is set
on the stored scores of all candidates that it didn't learn from: as few others as can be, but ``RECALL``
of the findings. Findings and the sample are also shown without what stands before them and in capitals,
so that a value counts for itself.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunemill.llm.common import mixed, signed, steps
from tunemill.session import written

KINDS = ("assign", "access", "hex", "model")
ASSIGN = re.compile(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
KEYWORDS = ("password", "passwd", "secret", "token", "api_key", "apikey")
#: Characters of a candidate, by code; and the least length of one.
KEY = np.isin(np.arange(256), np.frombuffer(b"+/_.=-0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz", np.uint8))
LEAST_RUN = 8
DIGIT = re.compile(r"[0-9]")
LEAST_VALUE, LEAST_ACCESS = 8, 16

#: Characters the network sees before, of and after a candidate or a part of a long one.
BEFORE, OWN, AFTER = 16, 40, 8
WIDTH = BEFORE + OWN + AFTER
#: Labelled candidates of each kind that the network is fitted on, those of the least hashes.
SAMPLE = 4000
RECALL = 0.98
OTHERS = 0.001
#: Bins of the scores that the threshold is set on.
BINS = 10_000
#: Windows that are gathered and scored at once.
AT_ONCE = 8192
#: Candidates are scored together by their length, in steps of so many characters.
STEP = 2
SEED = 7


def base_spans(text: str) -> list[tuple[str, int, int, int]]:
    """Spans of the patterns, by start and then by kind, each with the start of its value."""
    spans = []
    lower = text.lower()
    if any(k in lower for k in KEYWORDS):
        spans += [("assign", *m.span(), m.start(1)) for m in ASSIGN.finditer(text) if len(m[1]) >= LEAST_VALUE]
    if "AKIA" in text:
        spans += [("access", *m.span(), m.start()) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST_ACCESS]
    if DIGIT.search(text) or HEX.search(text):
        spans += [("hex", *m.span(), m.start()) for m in HEX.finditer(text)]
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


def spans_text(spans) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


class Candidates:
    """All candidates of some texts, as arrays.

    ``data`` holds the texts one after the other, a byte for each character (63 for what isn't ASCII), with zeros between
    them. Candidate ``i`` is ``data[start[i]:end[i]]`` of text ``owner[i]``, whose first character is at
    ``offset[owner[i]]``; ``finding[i]`` says whether a pattern's value covers it. What is covered by a pattern's span but
    isn't its value is no candidate.
    """

    def __init__(self, texts: list[str | None]):
        self.base = [base_spans(t) if t else [] for t in texts]
        gap = b"\0" * WIDTH
        coded = [(t or "").encode("ascii", "replace") for t in texts]
        sizes = np.fromiter(map(len, coded), np.int64, len(coded))
        self.offset = np.cumsum(sizes + WIDTH) - sizes
        self.data = np.frombuffer(gap + gap.join(coded) + gap, np.uint8)
        kind = KEY[self.data].astype(np.uint8)  # 0 no key character, 1 one, 2 in a value, 3 else in a span
        for found, at in zip(self.base, self.offset.tolist()):
            for _, start, end, _ in found:
                inside = kind[at + start:at + end]
                inside[inside == 1] = 3
            for _, _, end, value in found:
                inside = kind[at + value:at + end]
                inside[inside != 0] = 2
        edges = np.flatnonzero(kind[1:] != kind[:-1]) + 1
        edges = np.concatenate(([0], edges, [len(kind)]))
        start, end = edges[:-1], edges[1:]
        keep = ((kind[start] == 1) | (kind[start] == 2)) & (end - start >= LEAST_RUN)
        self.start, self.end = start[keep], end[keep]
        self.finding = kind[self.start] == 2
        self.owner = np.searchsorted(self.offset, self.start, "right") - 1

    def windows(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Windows of all candidates in order, some at a time: candidate of each, and rows of character numbers.

        The windows of a candidate of over ``OWN`` characters overlap and show all of it.
        """
        size = self.end - self.start
        number = np.where(size <= OWN, 1, -(-(size - OWN) // (OWN // 2)) + 1)
        ends = np.cumsum(number)
        total = int(ends[-1]) if len(ends) else 0
        befores, parts, afters = (np.lib.stride_tricks.sliding_window_view(self.data, n) for n in (BEFORE, OWN, AFTER))
        for first in range(0, total, AT_ONCE):
            at = np.arange(first, min(first + AT_ONCE, total))
            of = np.searchsorted(ends, at, "right")
            step = at - (ends[of] - number[of])
            begin = np.minimum(self.start[of] + step * (OWN // 2), np.maximum(self.start[of], self.end[of] - OWN))
            end = np.minimum(begin + OWN, self.end[of])
            own = np.where(np.arange(OWN) < (end - begin)[:, None], parts[begin], 0)
            yield of, np.concatenate([befores[begin - BEFORE], own, afters[end]], axis=1) & 127


def window_hashes(chars: np.ndarray) -> np.ndarray:
    """64-bit hashes of windows."""
    words = np.ascontiguousarray(chars, np.uint8).view(np.uint64)
    out = np.zeros(len(words), np.uint64)
    for k in range(words.shape[1]):
        out = mixed(out ^ words[:, k])
    return out


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which of ``values`` are in the sorted ``known``."""
    if not len(known):
        return np.zeros(len(values), bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def windows(docs: DataFrame, least: int | None = None) -> DataFrame:
    """``(doc_id, start, end, finding, window, hash)``, a row for each window of every candidate.

    With ``least``, of each task only the windows of the least hashes, that many of findings and of others at most, and equal
    ones once: what the whole table's least are among.
    """
    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None
        for batch in steps(batches):
            seen = Candidates(batch.column("text").to_pylist())
            ids = batch.column("doc_id")
            for of, chars in seen.windows():
                hashes, finding = window_hashes(chars), seen.finding[of]
                if kept is not None:
                    hashes, finding = np.concatenate([kept[2], hashes]), np.concatenate([kept[1], finding])
                    chars = np.concatenate([kept[0], chars])
                if least is not None:
                    order = np.lexsort((hashes, finding))
                    first = np.concatenate(([True], (np.diff(hashes[order]) != 0) | np.diff(finding[order])))
                    order = order[first]
                    others = int((~finding[order]).sum())
                    order = np.concatenate([order[:others][:least], order[others:][:least]])
                    kept = (chars[order], finding[order], hashes[order])
                    continue
                offset = seen.offset[seen.owner[of]]
                yield _window_rows(ids.take(pa.array(seen.owner[of])), seen.start[of] - offset, seen.end[of] - offset,
                                   finding, chars, hashes)
        if kept is not None:
            none = pa.nulls(len(kept[0]), pa.int64())
            yield _window_rows(none, none, none, kept[1], kept[0], kept[2])

    return docs.select("doc_id", "text").mapInArrow(
        per_task, "doc_id long, start long, end long, finding boolean, window binary, hash long")


def _window_rows(ids, start, end, finding, chars, hashes) -> pa.RecordBatch:
    joined = np.ascontiguousarray(chars, np.uint8).tobytes()
    return pa.RecordBatch.from_arrays(
        [ids, pa.array(start), pa.array(end), pa.array(finding),
         pa.array([joined[i:i + WIDTH] for i in range(0, len(joined), WIDTH)], pa.binary()), pa.array(signed(hashes))],
        ["doc_id", "start", "end", "finding", "window", "hash"])


class CharNet:
    """Characters to vectors, two convolutions with rectifiers, greatest value by filter, logistic."""

    CHANNELS, FILTERS, SPAN = 8, (16, 16), 5

    def __init__(self, seed: int = SEED):
        rng = np.random.default_rng(seed)
        first, second = self.FILTERS
        draw = lambda *shape: rng.normal(0, (2 / np.prod(shape[:-1])) ** 0.5, shape)
        self.weights = [rng.normal(0, 0.5, (128, self.CHANNELS)), draw(self.SPAN * self.CHANNELS, first),
                        np.zeros(first), draw(self.SPAN * first, second), np.zeros(second),
                        draw(2 * second, 1), np.zeros(1)]

    @staticmethod
    def _unrolled(x: np.ndarray, span: int) -> np.ndarray:
        rows, width, channels = x.shape
        views = np.lib.stride_tricks.sliding_window_view(x, span, axis=1)
        return views.transpose(0, 1, 3, 2).reshape(rows, width - span + 1, span * channels)

    def _forward(self, chars: np.ndarray):
        table, w1, b1, w2, b2, w3, b3 = self.weights
        u1 = self._unrolled(table[chars], self.SPAN)
        h1 = np.maximum(u1 @ w1 + b1, 0)
        u2 = self._unrolled(h1, self.SPAN)
        h2 = np.maximum(u2 @ w2 + b2, 0)
        top = h2.argmax(axis=1)
        pooled = np.concatenate([np.take_along_axis(h2, top[:, None, :], 1)[:, 0], h2.mean(axis=1)], 1)
        return u1, h1, u2, h2, top, pooled, (pooled @ w3 + b3)[:, 0]

    def scores(self, chars: np.ndarray) -> np.ndarray:
        """Probability of a secret for rows of character numbers, in single precision.

        The zeros behind a short candidate give one value at all places that see nothing else. Rows are taken by length, one
        such place is worked out, and the others count for the mean.
        """
        tables = self._tables()
        w3, b3 = (w.astype(np.float32) for w in self.weights[-2:])
        alone = 2 * self.SPAN - 1  # characters that a place sees
        empty = self._places(np.zeros((1, alone), np.uint8), tables)[0, 0]
        own = chars[:, BEFORE:BEFORE + OWN] != 0
        size = np.where(own.any(axis=1), OWN - own[:, ::-1].argmax(axis=1), 0)
        room = np.minimum(-(-size // STEP) * STEP + alone, OWN)
        out = np.zeros(len(chars))
        for kept in np.unique(room).tolist():
            rows, left = np.flatnonzero(room == kept), OWN - kept
            for i in range(0, len(rows), 256):
                at = rows[i:i + 256]
                part = chars[at]
                h2 = self._places(np.concatenate([part[:, :BEFORE + kept], part[:, BEFORE + OWN:]], axis=1), tables)
                mean = (h2.sum(axis=1) + np.float32(left) * empty) / np.float32(h2.shape[1] + left)
                logit = np.concatenate([h2.max(axis=1), mean], 1) @ w3 + b3
                out[at] = 1 / (1 + np.exp(-np.clip(logit[:, 0].astype(np.float64), -30, 30)))
        return out

    def _tables(self) -> tuple:
        """What :meth:`_places` needs: the first convolution as look-ups, by place in the filter and character, the first two
        places by the pair of both; and the filters and bias of the second."""
        table, w1, b1, w2, b2 = (w.astype(np.float32) for w in self.weights[:5])
        first, second = self.FILTERS
        looked = [table @ w1.reshape(self.SPAN, self.CHANNELS, first)[k] for k in range(self.SPAN)]
        pairs = ((looked[0] + b1)[:, None] + looked[1]).reshape(-1, first)
        wide = np.ascontiguousarray(w2.reshape(self.SPAN, first, second).transpose(1, 0, 2).reshape(first, -1))
        return pairs, looked[2:], wide, b2

    def _places(self, chars: np.ndarray, tables: tuple) -> np.ndarray:
        """Values of the second convolution at all places of rows of any width."""
        pairs, looked, wide, b2 = tables
        first, second = self.FILTERS
        at = chars.astype(np.intp)
        width = at.shape[1] - self.SPAN + 1
        h1 = np.take(pairs, at[:, :width] * 128 + at[:, 1:width + 1], axis=0, mode="clip")
        for k, own in enumerate(looked, 2):
            h1 += np.take(own, at[:, k:k + width], axis=0, mode="clip")
        np.maximum(h1, 0, out=h1)
        apart = (h1.reshape(-1, first) @ wide).reshape(len(at), width, self.SPAN, second)
        width -= self.SPAN - 1
        h2 = apart[:, :width, 0] + b2
        for k in range(1, self.SPAN):
            h2 += apart[:, k:k + width, k]
        return np.maximum(h2, 0, out=h2)

    def _gradients(self, chars: np.ndarray, labels: np.ndarray) -> list[np.ndarray]:
        table, w1, b1, w2, b2, w3, b3 = self.weights
        u1, h1, u2, h2, top, pooled, logit = self._forward(chars)
        wrong = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - labels)[:, None] / len(labels)
        into = wrong @ w3.T
        half = h2.shape[2]
        d2 = np.repeat(into[:, None, half:] / h2.shape[1], h2.shape[1], axis=1)
        np.put_along_axis(d2, top[:, None, :], np.take_along_axis(d2, top[:, None, :], 1)
                          + into[:, None, :half], 1)
        d2 *= h2 > 0
        d1 = self._folded(d2 @ w2.T, h1.shape) * (h1 > 0)
        d0 = self._folded(d1 @ w1.T, (*chars.shape, self.CHANNELS))
        letters = np.zeros_like(table)
        np.add.at(letters, chars, d0)
        flat = lambda u, d: u.reshape(-1, u.shape[2]).T @ d.reshape(-1, d.shape[2])
        return [letters, flat(u1, d1), d1.sum((0, 1)), flat(u2, d2), d2.sum((0, 1)),
                pooled.T @ wrong, wrong.sum(0)]

    def _folded(self, unrolled: np.ndarray, shape: tuple) -> np.ndarray:
        out = np.zeros(shape)
        rows, width, channels = shape
        parts = unrolled.reshape(rows, width - self.SPAN + 1, self.SPAN, channels)
        for k in range(self.SPAN):
            out[:, k:k + parts.shape[1]] += parts[:, :, k]
        return out

    def fit(self, chars: np.ndarray, labels: np.ndarray, rounds: int = 4, batch: int = 128) -> None:
        """Adam on the logistic loss, both kinds weighing alike by drawing them equally often."""
        rng = np.random.default_rng(SEED)
        kinds = [np.flatnonzero(labels == k) for k in (0, 1)]
        first = [np.zeros_like(w) for w in self.weights]
        second = [np.zeros_like(w) for w in self.weights]
        for step in range(1, rounds * max(1, len(labels) // batch) + 1):
            rows = np.concatenate([rng.choice(k, batch // 2) for k in kinds])
            for i, g in enumerate(self._gradients(chars[rows], labels[rows])):
                first[i] = 0.9 * first[i] + 0.1 * g
                second[i] = 0.999 * second[i] + 0.001 * g * g
                self.weights[i] -= 0.004 * (first[i] / (1 - 0.9 ** step)) / (
                    np.sqrt(second[i] / (1 - 0.999 ** step)) + 1e-8)


def characters(windows: list[bytes]) -> np.ndarray:
    """Rows of character numbers of windows."""
    return np.frombuffer(b"".join(windows), np.uint8).reshape(-1, WIDTH).astype(np.int64) & 127


def threshold(counts: np.ndarray, recall: float) -> float:
    """Threshold from counts (kind, score bin): no more than ``OTHERS`` of the other candidates pass, and it is no
    less than one half, unless that would find less than ``recall`` of the findings."""
    passing = counts[:, ::-1].cumsum(axis=1)[:, ::-1]  # those at or over the lower edge of a bin
    most = int(np.flatnonzero(passing[1] >= recall * passing[1, 0])[-1])
    low = np.flatnonzero(passing[0] <= OTHERS * passing[0, 0])
    least = int(low[0]) if len(low) else BINS - 1
    return min(most, max(BINS // 2, least)) / BINS


def forms(chars: np.ndarray) -> list[np.ndarray]:
    """Windows as they are, without what stands before, and in capitals."""
    bare = chars.copy()
    bare[:, :BEFORE] = 0
    return [chars, bare, np.where((chars >= 97) & (chars <= 122), chars - 32, chars)]


def train(found: DataFrame, sample: int = SAMPLE) -> tuple[CharNet, np.ndarray] | None:
    """The network, fitted on at most ``sample`` windows of each kind, and the hashes of what it was fitted on.

    ``found`` has the columns finding, window and hash. The sample has the windows of the least hashes, equal ones once; every
    fourth is left aside. Without eight of both kinds there is no network.
    """
    kept = []
    for finding in (False, True):
        rows = (found.where(F.col("finding") == finding)
                .withColumn("at", F.expr("hash ^ (-9223372036854775807L - 1)"))
                .select("at", "hash", "window").distinct().orderBy("at", "window").limit(sample).toArrow())
        kept += [(w, int(finding), i % 4 == 3, h) for i, (w, h) in enumerate(
            zip(rows.column("window").to_pylist(), rows.column("hash").to_pylist()))]
        if rows.num_rows < 8:
            return None
    chars = characters([w for w, _, _, _ in kept])
    labels = np.array([k for _, k, _, _ in kept], np.float64)
    aside = np.array([a for _, _, a, _ in kept])
    shown = forms(chars)
    net = CharNet()
    net.fit(np.concatenate([c[~aside] for c in shown]), np.tile(labels[~aside], len(shown)))
    return net, np.sort(np.array([h for _, _, a, h in kept if not a], np.int64).view(np.uint64))


def scored(docs: DataFrame, net: CharNet | None, taught: np.ndarray) -> DataFrame:
    """``(doc_id, n_assign, n_access, n_hex, base, starts, sizes, bins, found_bins)`` for every row of ``docs``.

    ``base`` is the spans of the patterns as text. ``bins`` has the score bin of each candidate that is no finding, -1 less
    the bin where the network learnt from one of its windows, ``found_bins`` those of the findings it didn't learn from, in
    all three forms. Without a network there are no candidates.
    """
    # arrays only: a class in a broadcast would need the package on the executors
    sent = docs.sparkSession.sparkContext.broadcast((net.weights if net else None, taught))

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, known = sent.value
        judge = CharNet()
        judge.weights = weights
        for batch in steps(batches):
            seen = Candidates(batch.column("text").to_pylist())
            best = np.zeros((3, len(seen.start)))
            learnt = np.zeros(len(seen.start), bool)
            for of, chars in seen.windows() if weights is not None else ():
                np.maximum.at(best[0], of, judge.scores(chars))
                learnt[of[_among(window_hashes(chars), known)]] = True
                named = seen.finding[of]
                if named.any():
                    for k, shown in enumerate(forms(chars[named])[1:], 1):
                        np.maximum.at(best[k], of[named], judge.scores(shown))
            bins = np.minimum((best * BINS).astype(np.int32), BINS - 1)
            others = ~seen.finding if weights is not None else np.zeros(len(seen.start), bool)
            named = seen.finding & ~learnt & (weights is not None)
            offset = seen.offset[seen.owner]
            lists = lambda mask, values, times=1: pa.ListArray.from_arrays(
                pa.array(np.concatenate(([0], np.cumsum(times * np.bincount(seen.owner[mask], minlength=batch.num_rows))))
                         .astype(np.int32)), pa.array(values.astype(np.int32)))
            base = [[s[:3] for s in row] for row in seen.base]
            count = lambda kind: pa.array([sum(s[0] == kind for s in row) for row in base], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), count("assign"), count("access"), count("hex"),
                 pa.array(list(map(spans_text, base)), pa.string()),
                 lists(others, (seen.start - offset)[others]), lists(others, (seen.end - seen.start)[others]),
                 lists(others, np.where(learnt, -1 - bins[0], bins[0])[others]),
                 lists(named, bins[:, named].T.reshape(-1), 3)],
                ["doc_id", "n_assign", "n_access", "n_hex", "base", "starts", "sizes", "bins", "found_bins"])

    return docs.select("doc_id", "text").mapInArrow(per_task, (
        "doc_id long, n_assign long, n_access long, n_hex long, base string, starts array<int>, sizes array<int>, "
        "bins array<int>, found_bins array<int>"))


def score_counts(rows: DataFrame) -> np.ndarray:
    """Candidates by kind (others, findings) and score bin, from :func:`scored`, but for those the network learnt from."""
    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(2 * BINS, np.int64)
        for batch in batches:
            for kind, column in enumerate(("bins", "found_bins")):
                bins = batch.column(column).flatten().to_numpy(zero_copy_only=False)
                counts += np.bincount(kind * BINS + bins[bins >= 0], minlength=2 * BINS)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], ["at", "n"])

    found = (rows.select("bins", "found_bins").mapInArrow(per_task, "at long, n long")
             .groupBy("at").agg(F.sum("n").alias("n")).toArrow())
    out = np.zeros(2 * BINS, np.int64)
    out[found.column("at").to_numpy()] = found.column("n").to_numpy()
    return out.reshape(2, BINS)


def found(docs: DataFrame, sample: int = SAMPLE, recall: float = RECALL) -> DataFrame:
    """``(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_model)`` for every row of ``docs``.

    Spans count code points with the end excluded. Those of the patterns all stay; the network adds
    candidates (kind ``model``), which touch none of them. A NULL text is empty. Other columns are
    ignored, NULL and repeated doc_ids stay, an empty table gives no rows. The network adds nothing
    where the table has fewer than eight findings or eight other candidates to learn from.
    """
    taught = train(written(windows(docs, sample), "least-windows"), sample)
    net, hashes = taught or (None, np.zeros(0, np.uint64))
    rows = written(scored(docs, net, hashes), "scored-candidates")
    counts = score_counts(rows)
    least = round(threshold(counts, recall) * BINS) if counts[1].any() else BINS

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins = batch.column("bins")
            flat = bins.flatten().to_numpy(zero_copy_only=False)
            flat = np.where(flat < 0, -1 - flat, flat)
            starts, sizes = (batch.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("starts", "sizes"))
            ends = np.cumsum(pc.list_value_length(bins).to_numpy(zero_copy_only=False).astype(np.int64))
            passed = np.flatnonzero(flat >= least)
            owner = np.searchsorted(ends, passed, "right")
            base = batch.column("base").to_pylist()
            spans, added = list(base), np.bincount(owner, minlength=batch.num_rows)
            more: dict[int, list] = {}
            for row, start, size in zip(owner.tolist(), starts[passed].tolist(), sizes[passed].tolist()):
                more.setdefault(row, []).append(("model", start, start + size))
            for row, extra in more.items():
                own = [(k, int(s), int(e)) for k, s, e in (span.split(":") for span in base[row].split(",") if span)]
                spans[row] = spans_text(sorted(own + extra, key=lambda s: (s[1], KINDS.index(s[0]))))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "n_assign", "n_access", "n_hex")),
                 pa.array([hashlib.sha256(b.encode()).hexdigest() for b in base], pa.string()),
                 pa.array(spans, pa.string()), pa.array(added.astype(np.int64))],
                ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_model"])

    return rows.mapInArrow(per_task, "doc_id long, n_assign long, n_access long, n_hex long, "
                                     "base_sha256 string, spans string, n_model long")
