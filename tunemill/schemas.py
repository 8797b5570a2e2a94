"""Wire, lake and staging schemas, and the NULL defaults of staging."""

from __future__ import annotations

from pyspark.sql import types as T

LISTEN, PAGE_VIEW, AUTH = "listen_events", "page_view_events", "auth_events"
TOPICS = (LISTEN, PAGE_VIEW, AUTH)

# Only these topics carry escaped text in ``song`` and ``artist``.
TEXT_REPAIR = {LISTEN: ("song", "artist"), PAGE_VIEW: ("song", "artist"), AUTH: ()}


_TYPES = {
    "string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType(),
    "float": T.FloatType(), "double": T.DoubleType(), "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
}


def _struct(columns: str) -> T.StructType:
    """``"name type, ..."`` to a schema; unlike ``fromDDL`` it needs no session."""
    pairs = [column.split() for column in columns.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# Field names, order and types of the JSON messages.
WIRE = {
    LISTEN: _struct(
        "artist string, song string, duration double, ts bigint, sessionid int, auth string, "
        "level string, itemInSession int, city string, zip int, state string, userAgent string, "
        "lon double, lat double, userId bigint, lastName string, firstName string, "
        "gender string, registration bigint"),
    PAGE_VIEW: _struct(
        "ts bigint, sessionId int, page string, auth string, method string, status int, "
        "level string, itemInSession int, city string, zip int, state string, userAgent string, "
        "lon double, lat double, userId int, lastName string, firstName string, gender string, "
        "registration bigint, artist string, song string, duration double"),
    AUTH: _struct(
        "ts bigint, sessionId int, level string, itemInSession int, city string, zip int, "
        "state string, userAgent string, lon double, lat double, userId int, lastName string, "
        "firstName string, gender string, registration bigint, success boolean"),
}

# Column order and types of the staging tables.
STAGING = {
    LISTEN: _struct(
        "artist string, song string, duration double, ts timestamp, auth string, level string, "
        "city string, state string, userAgent string, lon double, lat double, userId bigint, "
        "lastName string, firstName string, gender string, registration bigint"),
    PAGE_VIEW: _struct(
        "ts timestamp, page string, auth string, method string, status bigint, level string, "
        "city string, state string, userAgent string, lon double, lat double, userId bigint, "
        "lastName string, firstName string, gender string, registration bigint, artist string, "
        "song string, duration double"),
    AUTH: _struct(
        "ts timestamp, level string, city string, state string, userAgent string, lon double, "
        "lat double, userId bigint, lastName string, firstName string, gender string, "
        "registration bigint, success boolean"),
}

# What staging puts in place of NULL. Text columns get TEXT_DEFAULT.
TEXT_DEFAULT = "NA"
DEFAULTS = {
    "duration": -1.0,
    "lon": 0.0,
    "lat": 0.0,
    "userId": 0,
    "registration": 9999999999999,
    "status": 0,
    "success": False,
}

# Directory levels of the lake.
LAKE_PARTS = ("year", "month", "day", "hour", "five_minute_interval")
LAKE_PART_TYPES = _struct(
    "year int, month int, day int, hour int, five_minute_interval string")

# Partition levels of the staging tables.
STAGING_PARTS = ("ts_hour", "slot")

STATE_CODES = _struct("stateCode string, stateName string")

SONGS = _struct(
    "song_id string, artist_name string, artist_id string, artist_latitude double, "
    "artist_longitude double, artist_location string, duration double, key int, "
    "key_confidence double, loudness double, song_hotttnesss double, tempo double, "
    "title string, year int")

# Columns of the ride rows (all text in the file) and of the ride message.
RIDE_CSV = _struct(
    "VendorID string, tpep_pickup_datetime string, tpep_dropoff_datetime string, "
    "passenger_count string, trip_distance string, RatecodeID string, store_and_fwd_flag string, "
    "PULocationID string, DOLocationID string, payment_type string, fare_amount string, "
    "extra string, mta_tax string, tip_amount string, tolls_amount string, "
    "improvement_surcharge string, total_amount string, congestion_surcharge string")
RIDE = _struct(
    "vendorId string, passenger_count int, trip_distance float, pickup_location int, "
    "dropoff_location int, payment_type int, total_amount float, pickup_datetime timestamp")


def lake_schema(topic: str) -> T.StructType:
    """Columns of the lake files: the message with a real timestamp, then the partitions."""
    fields = [T.StructField(f.name, T.TimestampType() if f.name == "ts" else f.dataType)
              for f in WIRE[topic].fields]
    return T.StructType(fields + LAKE_PART_TYPES.fields)


def staging_table_schema(topic: str) -> T.StructType:
    """Staging columns plus the two partition columns of the stored table."""
    parts = [T.StructField(name, T.StringType()) for name in STAGING_PARTS]
    return T.StructType(STAGING[topic].fields + parts)
