"""Frames and plain models that the tests of this folder share."""

from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType())])


def docs_of(spark, texts, extra=()):
    """A documents table of ``texts`` (or of pairs of id and text), with odd extra columns."""
    rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(
        [(i, t, "en", "src0", None if t is None else len(t)) for i, t in rows], DOCS)
    for name in extra:
        df = df.selectExpr("*", f"'x' AS `{name}`")
    return df
