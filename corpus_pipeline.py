"""Cleaning of a training corpus in five stages, each written as Parquet and read again by the next.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows that the one before kept. All but
the last return the columns of ``documents``; the last returns the encoded documents. The session's
Python tasks get batches of a few megabytes from the first stage on: 10,000 whole texts are some 30 MB,
which JVM and worker would both hold several times over.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tunemill.llm import contain, lines, pieces, simhash, toxicity
from tunemill.llm.common import bound_batches, read_table
from tunemill.session import written


def _bounded(stage: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """A stage whose Python tasks get small batches."""
    @wraps(stage)
    def run_bounded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        bound_batches(spark)
        return stage(spark, docs, sf_dir)

    return run_bounded


@_bounded
def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go. Rows that repeat a doc_id go together."""
    scores = toxicity.scored(docs, read_table(spark, sf_dir, "labels"), carry=True)
    return scores.where("predicted = 0").select(*docs.columns)


@_bounded
def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines similar to an earlier one go, and documents of which nothing is left."""
    return lines.clean(docs, least_words=1)


@_bounded
def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document of the least id stays. Rows without id stay."""
    found = simhash.near_duplicates(docs)
    gone = written(found.where("doc_id <> component_id").select("doc_id").distinct(), "near-duplicates")
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


@_bounded
def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a test item to 0.8 or more go. Rows without id stay."""
    held = contain.contained(docs, read_table(spark, sf_dir, "benchmark"))
    gone = written(held.select("doc_id").distinct(), "contaminated")
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


@_bounded
def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document, and whether they decode to its very text."""
    return pieces.round_trip(docs)


STAGES = [
    ("toxicity", toxicity_stage),
    ("line dedup", line_stage),
    ("SimHash near-dedup", near_duplicate_stage),
    ("benchmark decontamination", decontamination_stage),
    ("SentencePiece encoding and decoding", encoding_stage),
]

#: Models and segmentations have no SQL; the tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the result of the last is not stored."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-").lower())
    return STAGES[-1][1](spark, docs, sf_dir)
