"""URL filter: rules by host and path, and where no rule fits, the ratio of two character models.

The models are Markov models of accepted and of rejected URLs, learnt from the URLs that a rule
judges. They read all of a URL after its ``://``, also query and fragment. A URL's score is the difference of its
log-likelihoods by character. Four of five labelled URLs (by a hash) count for the models, the fifth is scored to find the threshold:
the one with the best mean of both classes' shares of right verdicts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunemill.llm.charlm import alphabet, codes, count_ngrams, log_probabilities
from tunemill.llm.common import steps, utf8

#: The rules, as verdict, host and path.
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/"))
ORDER = 4
SIGNS = "a b c d e f g h i j k l m n o p q r s t u v w x y z 0123456789 . - _ / = & % + ~ : @ , ;"
FOLDS = 5
#: Scores are counted in bins of this width within plus and minus ``REACH`` to set the threshold.
BIN, REACH = 0.01, 12.0
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def parts(url: Column) -> tuple[Column, Column, Column]:
    """Host (A-Z in lower case), path, and all that follows of a URL, empty without ``://`` or for NULL."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.char_length(url))).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.char_length(host) + 1, F.char_length(url)), "^[^?#]*", 0)
    tail = F.substring(rest, F.char_length(host) + F.char_length(path) + 1, F.char_length(url))
    return F.translate(host, _UPPER, _LOWER), F.coalesce(path, F.lit("")), F.coalesce(tail, F.lit(""))


def _rule(host: Column, path: Column, rules) -> Column:
    """Position of the longest rule that fits, from 0, else NULL."""
    ordered = sorted(range(len(rules)), key=lambda i: -len(rules[i][1] + rules[i][2]))
    found = F.lit(None).cast("int")
    for i in reversed(ordered):
        _, rule_host, rule_path = rules[i]
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        found = F.when(fits, i).otherwise(found)
    return found


class RatioModel:
    """Log-likelihood ratio of every n-gram (positive: accepted), and the threshold on scores."""

    def __init__(self, ratio: np.ndarray, table: np.ndarray, order: int, threshold: float):
        self.ratio, self.table, self.order, self.threshold = ratio, table, order, threshold

    def score(self, text: bytes) -> float:
        """Mean log ratio over the characters of a text and its end."""
        classes = self.table[np.frombuffer(text + b" ", np.uint8)]
        return float(self.ratio[codes(classes, int(self.table.max()) + 1, self.order)].mean())


def scored(urls: DataFrame, model: RatioModel) -> DataFrame:
    """``urls`` (columns ``page_id, host, path, tail, rule_at``) with the score that the model gives the whole URL after
    its ``://``."""
    # arrays and numbers only: a class in a broadcast would need the package on the executors
    sent = urls.sparkSession.sparkContext.broadcast((model.ratio, model.table, model.order, model.threshold))

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ratio = RatioModel(*sent.value)
        for batch in steps(batches, "path"):
            found = [ratio.score(b"".join(url)) for url in zip(*(utf8(batch.column(c)) for c in ("host", "path", "tail")))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.float64())],
                                             [*batch.schema.names, "score"])

    return urls.mapInArrow(per_task, "page_id long, host string, path string, tail string, rule_at int, score double")


def fit(urls: DataFrame, rules=RULES, order: int = ORDER) -> RatioModel:
    """Models of all URLs that a rule judges; with one class missing all scores are 0."""
    table = alphabet(SIGNS)
    size = int(table.max()) + 1
    allowed = F.array(*(F.lit(int(v == "allow")) for v, _, _ in rules))
    labelled = (urls.where("rule_at IS NOT NULL")
                .withColumn("label", F.get(allowed, F.col("rule_at")))
                .withColumn("fold", F.pmod(F.xxhash64("host", "path", "tail"), F.lit(FOLDS))))
    texts = labelled.where("fold > 0").select("label", F.concat("host", "path", "tail").alias("text"))
    counts = count_ngrams(texts, "label", table, order).toArrow()
    kinds = counts.column("label").to_numpy()
    if len(np.unique(kinds)) < 2:
        return RatioModel(np.zeros(size ** order, np.float32), table, order, 0.0)
    by = [log_probabilities(counts.column("code").to_numpy()[kinds == k],
                            counts.column("n").to_numpy()[kinds == k], size, order) for k in (0, 1)]
    model = RatioModel(by[1] - by[0], table, order, 0.0)
    held = labelled.where("fold = 0").select("page_id", "host", "path", "tail", "rule_at")
    place = F.floor(F.least(F.greatest(F.col("score"), F.lit(-REACH)), F.lit(REACH)) / BIN).cast("int")
    bins = (scored(held, model).groupBy(place.alias("bin"), F.get(allowed, F.col("rule_at")).alias("label"))
            .count().toArrow())
    at = bins.column("bin").to_numpy() + int(REACH / BIN)
    label, n = bins.column("label").to_numpy(), bins.column("count").to_numpy()
    sums = np.zeros((2, int(2 * REACH / BIN) + 2))
    np.add.at(sums, (label, at), n)
    if (sums.sum(axis=1) > 0).all():
        # at bin k everything from k on is allowed
        right_block = np.concatenate(([0], np.cumsum(sums[0])))[:-1] / sums[0].sum()
        right_allow = 1 - np.concatenate(([0], np.cumsum(sums[1])))[:-1] / sums[1].sum()
        best = np.flatnonzero(right_block + right_allow >= (right_block + right_allow).max() - 1e-12)
        model.threshold = float((best[len(best) // 2] - int(REACH / BIN)) * BIN)
    return model


def judged(pages: DataFrame, rules=RULES, order: int = ORDER) -> DataFrame:
    """``(page_id, host, path, rule, verdict, score)`` for every row of ``pages``.

    A rule's verdict stands; other URLs are allowed if their score reaches the threshold. NULL URLs
    and URLs without ``://`` have an empty host and path. ``rule`` is host and path of the rule, NULL
    where none fits. Other columns are ignored, NULL and repeated page_ids stay, an empty table gives
    no rows; where rules label URLs of one kind only, all others are allowed.
    """
    host, path, tail = parts(F.coalesce("url", F.lit("")))
    urls = pages.select("page_id", host.alias("host"), path.alias("path"), tail.alias("tail")).withColumn(
        "rule_at", _rule(F.col("host"), F.col("path"), rules))
    model = fit(urls, rules, order)
    names = F.array(*(F.lit(h + p) for _, h, p in rules))
    verdicts = F.array(*(F.lit(v) for v, _, _ in rules))
    by_model = F.when(F.col("score") >= model.threshold, "allow").otherwise("block")
    return scored(urls, model).select(
        "page_id", "host", "path", F.get(names, F.col("rule_at")).alias("rule"),
        F.coalesce(F.get(verdicts, F.col("rule_at")), by_model).alias("verdict"), "score")
