"""Staging projections: fixed columns, typed, with defaults in place of NULL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tunemill import schemas


def _default(field: T.StructField) -> Column | None:
    if isinstance(field.dataType, T.StringType):
        return F.lit(schemas.TEXT_DEFAULT)
    if field.name in schemas.DEFAULTS:
        return F.lit(schemas.DEFAULTS[field.name])
    return None


def _staged(field: T.StructField, decimals: bool) -> Column:
    value = F.col(field.name)
    if decimals and field.name in ("lon", "lat"):
        value = value.cast("decimal(38,9)")
    value = value.cast(field.dataType)
    default = _default(field)
    if default is not None:
        value = F.coalesce(value, default.cast(field.dataType))
    return value.alias(field.name)


def stage(df: DataFrame, topic: str) -> DataFrame:
    """Columns of the staging table of ``topic``, in its order."""
    decimals = topic == schemas.AUTH
    return df.select(*[_staged(f, decimals) for f in schemas.STAGING[topic].fields])


def stg_listen_events(df: DataFrame) -> DataFrame:
    return stage(df, schemas.LISTEN)


def stg_page_view_events(df: DataFrame) -> DataFrame:
    return stage(df, schemas.PAGE_VIEW)


def stg_auth_events(df: DataFrame) -> DataFrame:
    """As the other two, with coordinates rounded to nine decimals on the way."""
    return stage(df, schemas.AUTH)


def known_users(df: DataFrame) -> DataFrame:
    return df.where(F.col("userId") != 0)


def special_users(df: DataFrame, special_ids: tuple[int, ...] = (0, 1)) -> DataFrame:
    return df.where(F.col("userId").isin(*special_ids))


def drop_duplicate_events(df: DataFrame) -> DataFrame:
    """Whole-row dedup. Copies meet in the map-side combine before the shuffle."""
    return df.dropDuplicates()


def drop_duplicate_events_stream(df: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Stream form: copies further apart than ``delay`` are not recognised."""
    return df.withWatermark("ts", delay).dropDuplicatesWithinWatermark(df.columns)


def ride_projection(df: DataFrame) -> DataFrame:
    """Eight typed fields of a ride row; the pick-up time is the time of sending."""
    return df.select(
        F.col("VendorID").cast("int").alias("vendorId"),
        F.col("passenger_count").cast("int").alias("passenger_count"),
        F.col("trip_distance").cast("double").alias("trip_distance"),
        F.col("PULocationID").cast("int").alias("pickup_location"),
        F.col("DOLocationID").cast("int").alias("dropoff_location"),
        F.col("payment_type").cast("int").alias("payment_type"),
        F.col("total_amount").cast("double").alias("total_amount"),
        F.current_timestamp().alias("pickup_datetime"),
    )
