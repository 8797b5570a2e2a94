"""Loading the lake into staging, one five-minute slot at a time."""

from __future__ import annotations

import uuid
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tunemill import schemas
from tunemill.functions.time import five_minute_interval
from tunemill.functions.time import slot_for as slot_column
from tunemill.operators.staging import stage
from tunemill.session import written
from tunemill.sources.files import lake_scan, lake_slice
from tunemill.sources.tables import append_staging, clear_slots, drop_slice, ensure_table, register_view
from tunemill.streaming.keyed import manifest, read_state, upsert

SLOT = timedelta(minutes=5)
# One row for every slot of a topic that was loaded, found empty included.
LEDGER = "topic string, slot string, state string, n bigint, loads bigint"
LOADED, EMPTY = "loaded", "empty"


def slot_for(run_time: datetime) -> datetime:
    """Start of the slot a run at ``run_time`` loads: the last one that is complete."""
    floor = run_time.replace(minute=run_time.minute - run_time.minute % 5,
                             second=0, microsecond=0)
    return floor - SLOT


def missing_slots(runs: DataFrame, loaded: DataFrame, ts: str = "ts") -> DataFrame:
    """Slots that the runs in ``runs`` should have loaded and ``loaded`` lacks."""
    wanted = runs.select(slot_column(F.col(ts)).alias("slot")).distinct()
    return wanted.join(loaded.select("slot").distinct(), "slot", "left_anti")


def load_slot(spark: SparkSession, lake: str, staging: str, slot: datetime,
              topics: tuple[str, ...] = schemas.TOPICS, mode: str = "replace_slot") -> None:
    """Stage one slot of each topic: ``lake/<topic>`` to ``staging/<topic>``."""
    for topic in topics:
        name = f"{topic}_{slot:%Y%m%d%H%M}_{uuid.uuid4().hex[:8]}"  # two loads never share a view
        register_view(lake_slice(spark, f"{lake}/{topic}", topic, slot), name)
        ensure_table(spark, f"{staging}/{topic}", topic)
        append_staging(stage(spark.table(name), topic), f"{staging}/{topic}", topic, mode)
        drop_slice(spark, name)


def load_range(lake_rows: DataFrame, staging: str, topic: str, mode: str = "replace_slot") -> None:
    """Stage many slots in one job, for a backfill; ``lake_rows`` may be filtered by partition."""
    append_staging(stage(lake_rows, topic), f"{staging}/{topic}", topic, mode)


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """What was loaded so far: ``topic, slot, state, n, loads`` (rows, and how often the slot was loaded)."""
    return read_state(spark, ledger, spark.createDataFrame([], LEDGER))


def pending_slots(wanted: DataFrame, ledger: DataFrame, topics: tuple[str, ...] = schemas.TOPICS) -> DataFrame:
    """``(topic, slot)`` of the slots in ``wanted`` that the ledger doesn't have."""
    every = wanted.select("slot").distinct().select(F.explode(F.array(*map(F.lit, topics))).alias("topic"), "slot")
    return every.join(ledger.select("topic", "slot"), ["topic", "slot"], "left_anti")


def load_slots(spark: SparkSession, lake: str, staging: str, ledger: str, wanted: DataFrame,
               topics: tuple[str, ...] = schemas.TOPICS) -> None:
    """Stage all ``wanted`` slots (column ``slot``) of each topic, one job a topic, and note it in the ledger.

    A slot is replaced as a whole; one that the lake has no longer loses its staged rows. The ledger is
    written last and at once, so a load that was lost on the way leaves its slots pending, and loading
    them again gives the same table.
    """
    slots = written(wanted.select("slot").distinct(), "wanted")
    for topic in topics:
        path = f"{staging}/{topic}"
        ensure_table(spark, path, topic)
        rows = (lake_scan(spark, f"{lake}/{topic}", topic)
                .join(slots.withColumnRenamed("slot", "five_minute_interval"), "five_minute_interval", "left_semi")
                .drop(*schemas.LAKE_PARTS))
        staged = written(stage(rows, topic), "slot-rows")
        append_staging(staged, path, topic, "replace_slot")
        found = staged.groupBy(five_minute_interval(F.col("ts")).alias("slot")).agg(F.count(F.lit(1)).alias("n"))
        before = read_ledger(spark, ledger).where(F.col("topic") == topic).select(
            "slot", F.col("n").alias("_n"), F.col("loads").alias("_loads"))
        entries = written(
            slots.join(found, "slot", "left").join(before, "slot", "left").select(
                F.lit(topic).alias("topic"), "slot",
                F.when(F.col("n") > 0, LOADED).otherwise(EMPTY).alias("state"),
                F.coalesce("n", F.lit(0)).alias("n"), (F.coalesce("_loads", F.lit(0)) + 1).alias("loads"),
                ((F.col("_n") > 0) & F.col("n").isNull()).alias("_gone")), "ledger-entries")
        clear_slots(spark, path, entries.where("_gone").select("slot"))
        number = manifest(spark, ledger)["applied"].get(topic, -1) + 1
        upsert(entries.drop("_gone"), ledger, ("topic", "slot"), topic, number)
