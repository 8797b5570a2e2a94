"""Loading the song catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tunemill import schemas
from tunemill.sources.files import csv_to_parquet


def load_songs(spark: SparkSession, csv: str, parquet: str) -> DataFrame:
    """CSV catalogue to a Parquet table, returned as read back."""
    csv_to_parquet(spark, csv, parquet, schemas.SONGS)
    return spark.read.schema(schemas.SONGS).parquet(parquet)
