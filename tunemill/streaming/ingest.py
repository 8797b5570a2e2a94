"""From message envelopes to lake rows. The same functions serve batch and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tunemill import schemas
from tunemill.functions.text import decode_text
from tunemill.functions.time import epoch_ms_to_ts, time_parts, with_slot

CORRUPT = "_corrupt_record"


def payload(df: DataFrame) -> DataFrame:
    """The message text."""
    return df.select(F.col("value").cast("string").alias("value"))


def parse_json(df: DataFrame, schema: T.StructType, keep_corrupt: bool = False) -> DataFrame:
    """The text as a typed struct ``data``. Text that is no JSON gives NULL fields.

    With ``keep_corrupt`` the struct also carries the text of unreadable
    messages, see :func:`corrupt_messages`.
    """
    options = {}
    if keep_corrupt:
        schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
        options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    return df.select(F.from_json("value", schema, options).alias("data"))


def flatten(df: DataFrame) -> DataFrame:
    return df.select("data.*")


def corrupt_messages(df: DataFrame, topic: str) -> DataFrame:
    """Messages that could not be read, for a side output."""
    parsed = flatten(parse_json(payload(df), schemas.WIRE[topic], keep_corrupt=True))
    return parsed.where(F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias("value"))


def fix_encoding(df: DataFrame, cols: tuple[str, ...]) -> DataFrame:
    return df.withColumns({c: decode_text(c) for c in cols}) if cols else df


def to_lake(parsed: DataFrame, topic: str) -> DataFrame:
    """Parsed fields to lake rows with their partition columns."""
    return (parsed.withColumn("ts", epoch_ms_to_ts(F.col("ts")))
            .transform(time_parts)
            .transform(with_slot)
            .transform(fix_encoding, schemas.TEXT_REPAIR[topic]))


def ingest(df: DataFrame, topic: str) -> DataFrame:
    """Messages of ``topic`` to lake rows with their partition columns."""
    return (df.transform(payload)
            .transform(parse_json, schemas.WIRE[topic])
            .transform(flatten)
            .transform(to_lake, topic))


def ingest_checked(df: DataFrame, topic: str) -> DataFrame:
    """As :func:`ingest`, with :data:`CORRUPT`: what stands in the way of landing a message, else NULL.

    That is the text of a message which is no JSON of the topic's types, has no value, or has no time (it
    would land in a partition that no load reads).
    """
    fields = schemas.WIRE[topic]
    with_text = T.StructType([*fields.fields, T.StructField(CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = payload(df).select(
        F.from_json("value", with_text, options).alias("data"), F.coalesce("value", F.lit("")).alias("_text"))
    rows = parsed.select("data.*", "_text")
    bad = F.when(F.col(CORRUPT).isNotNull() | F.col("ts").isNull(), F.col("_text"))
    return to_lake(rows.withColumn(CORRUPT, bad).drop("_text"), topic)
