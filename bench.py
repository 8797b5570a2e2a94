"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the table folder, BENCH_CPUS the number of local threads.
Every query runs to the end into a sink that stores nothing. ``row_udf_ingest``
is no query of this library: it is the same ingest with the text repair as a
row-at-a-time Python function, for comparison.
"""

from __future__ import annotations

import json
import os
import re
import time

from pyspark.sql import functions as F

from tunemill import schemas
from tunemill.functions.time import epoch_ms_to_ts, time_parts, with_slot
from tunemill.registry import QUERIES
from tunemill.session import get_session
from tunemill.sources.given_tables import GivenTables
from tunemill.streaming.ingest import flatten, ingest, parse_json, payload

HEADLINE = (
    "stg_listen_events", "scd2_level_history", "dim_users", "plays_per_level_and_day",
    "fact_streams", "wide_streams", "song_trends", "user_engagement", "auth_success_rate",
    "song_vocabulary", "user_sequences", "training_pairs", "next_track_model", "recommend_next",
    "decode_text", "ingest_listen_events",
)
RUNS = 2


# Fixed values, from Python's table of string escapes.
SINGLE = {"a": 7, "b": 8, "f": 12, "n": 10, "r": 13, "t": 9, "v": 11, "\\": 92, "'": 39, '"': 34}
HEX_DIGITS = {"x": 2, "u": 4, "U": 8}


def scan_repair(text):
    """Text repair of one value as a scanner over the escape grammar; the tests use it as their model."""
    found, at = bytearray(), 0
    while at < len(text or ""):
        sign, after = text[at], text[at + 1:at + 2]
        code, used = ord(sign), 1
        if sign == "\\":
            octal = re.match("[0-7]{1,3}", text[at + 1:at + 4])
            if octal:
                code, used = int(octal[0], 8), 1 + octal.end()
            elif after in SINGLE:
                code, used = SINGLE[after], 2
            elif after == "\n":
                code, used = None, 2
            elif after in HEX_DIGITS:
                width = HEX_DIGITS[after]
                digits = re.fullmatch("[0-9a-fA-F]{%d}" % width, text[at + 2:at + 2 + width])
                code, used = (int(digits[0], 16), 2 + width) if digits else (256, 0)
            elif after in ("", "N"):
                code = 256
        if code is not None:
            if code > 255:
                return text
            found.append(code)
        at += used
    try:
        return found.decode().strip('"') if text else text
    except UnicodeDecodeError:
        return text


def row_udf_ingest(spark, sf_dir):
    repair = F.udf(scan_repair)
    rows = (GivenTables(spark, sf_dir).envelope(schemas.LISTEN).transform(payload)
            .transform(parse_json, schemas.WIRE[schemas.LISTEN]).transform(flatten)
            .withColumn("ts", epoch_ms_to_ts(F.col("ts")))
            .transform(time_parts).transform(with_slot))
    return rows.withColumns({"song": repair("song"), "artist": repair("artist")})


def native_ingest(spark, sf_dir):
    return ingest(GivenTables(spark, sf_dir).envelope(schemas.LISTEN), schemas.LISTEN)


def seconds(build, spark, sf_dir) -> float:
    begin = time.perf_counter()
    build(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - begin


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session("bench", f"local[{cpus}]", conf={
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    seconds(native_ingest, spark, sf_dir)  # starts the JVM's compilers and the readers
    times = {name: round(min(seconds(QUERIES[name], spark, sf_dir) for _ in range(RUNS)), 3)
             for name in HEADLINE}
    compare = {f.__name__: round(min(seconds(f, spark, sf_dir) for _ in range(RUNS)), 3)
               for f in (native_ingest, row_udf_ingest)}
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "compare": compare, "sf": os.path.basename(sf_dir.rstrip("/"))}))
    spark.stop()


if __name__ == "__main__":
    main()
