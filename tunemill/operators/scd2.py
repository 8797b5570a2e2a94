"""History of a user's level as type-2 rows.

Everything here goes along the events of a user, and one user may own a third of all events and change
level on every one of them. So no window is over a user: rows are cut into segments of bounded size, and
what one segment owes the next (the last level, the number of changes, the first day) is carried over
summaries of one row per segment.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tunemill import schemas
from tunemill.operators.segments import PART, Segments, in_segments, local, with_carry
from tunemill.operators.staging import known_users, special_users

USER = ("userId", "firstName", "lastName", "gender")
# Equal times are ordered by these, so that every engine agrees.
ORDER = ("date", "level", "registration")
# Order of the runs of a user.
RUN_ORDER = ("run", "firstDay", "registration", "level")
# Fixed value: a row that is still valid ends on this day.
OPEN_END = date(9999, 12, 31)


def distinct_user_states(events: DataFrame) -> DataFrame:
    """Distinct state of each known user at each time."""
    return (known_users(events)
            .select(*USER, "registration", "level", F.col("ts").alias("date")).distinct())


def _with_changes(rows: DataFrame, placed: Segments) -> DataFrame:
    """Add ``changed`` to ``rows``, which may be fewer than those of the segments in ``placed``."""
    rows = with_carry(
        rows, placed, USER, lambda r: r.groupBy(PART, *USER).agg(F.max_by("level", F.struct(*ORDER)).alias("_end")),
        {"_before": ("string", lambda w: F.lag("_end").over(w))})
    here = local(USER).orderBy(*ORDER)
    before = F.when(F.row_number().over(here) == 1, F.coalesce("_before", F.lit(schemas.TEXT_DEFAULT))) \
              .otherwise(F.lag("level").over(here))
    return rows.withColumn("changed", F.when(before != F.col("level"), 1).otherwise(0)).drop("_before")


def _with_runs(flagged: DataFrame, placed: Segments, changes: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Add ``run`` to rows with ``changed``; ``changes`` adds that column to rows of ``placed``."""
    rows = with_carry(
        flagged, placed, USER, lambda r: changes(r).groupBy(PART, *USER).agg(F.sum("changed").alias("_sum")),
        {"_before": ("bigint", lambda w: F.sum("_sum").over(w.rowsBetween(Window.unboundedPreceding, -1)))})
    here = local(USER).orderBy("date")
    return rows.withColumn("run", F.coalesce("_before", F.lit(0)) + F.sum("changed").over(here)).drop("_before")


def level_change_flag(states: DataFrame) -> DataFrame:
    """Add ``changed``: 1 where the level differs from the user's previous row, else 0.

    A user's first row is compared with ``'NA'``. The first row of a segment is compared with the last
    level of the user's segment before.
    """
    placed = in_segments(states, USER, "date")
    return _with_changes(placed.rows, placed).drop(PART)


def level_run_number(flagged: DataFrame) -> DataFrame:
    """Add ``run``: the changes so far; rows of equal time share the total."""
    placed = in_segments(flagged, USER, "date")
    return _with_runs(placed.rows, placed, lambda rows: rows).drop(PART)


def level_runs(numbered: DataFrame) -> DataFrame:
    """First day of each run of one level."""
    return (numbered.groupBy(*USER, "registration", "level", "run")
            .agg(F.min("date").cast("date").alias("firstDay")))


def run_starts(placed: DataFrame) -> DataFrame:
    """The few rows in segments that decide the runs; every other row changes nothing.

    Kept are the first row of each segment, rows whose level or registration differs from the row before,
    and rows at a time with several levels. Changes, runs and first days over these equal those over all.
    """
    here = local(USER).orderBy(*ORDER)
    at_once = local(USER).orderBy("date").rangeBetween(0, 0)
    keep = ((F.row_number().over(here) == 1)
            | ~F.lag("level").over(here).eqNullSafe(F.col("level"))
            | ~F.lag("registration").over(here).eqNullSafe(F.col("registration"))
            | (F.min("level").over(at_once) != F.max("level").over(at_once)))
    return placed.withColumn("_keep", keep).where("_keep").drop("_keep")


def _with_expiration(runs: Segments) -> DataFrame:
    """Add ``rowExpirationDate`` to runs in segments."""
    rows = with_carry(
        runs.rows, runs, USER,
        lambda r: r.groupBy(PART, *USER).agg(F.min_by("firstDay", F.struct(*RUN_ORDER)).alias("_first")),
        {"_next": ("date", lambda w: F.lead("_first").over(w))})
    after = F.lead(F.struct("firstDay")).over(local(USER).orderBy(*RUN_ORDER))
    return rows.withColumn("rowExpirationDate", F.when(after.isNotNull(), after["firstDay"])
                           .otherwise(F.coalesce("_next", F.lit(OPEN_END)))).drop("_next")


def _with_current(rows: DataFrame, runs: Segments) -> DataFrame:
    """Add ``currentRow`` to ``rows``, which are those of ``runs``."""
    rows = with_carry(
        rows, runs, USER, lambda r: r.groupBy(PART, *USER).agg(F.max("run").alias("_top")),
        {"_last": ("bigint", lambda w: F.max("_top").over(
            w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))})
    last = F.coalesce("_last", F.max("run").over(local(USER)))
    return rows.withColumn("currentRow", F.when(F.col("run") == last, 1).otherwise(0)).drop("_last")


def row_expiration(runs: DataFrame) -> DataFrame:
    """Add ``rowExpirationDate``: first day of the user's next run, or the open end."""
    return _with_expiration(in_segments(runs, USER, "run")).drop(PART)


def current_row_flag(runs: DataFrame) -> DataFrame:
    """Add ``currentRow``: 1 for the last run of a user, else 0."""
    placed = in_segments(runs, USER, "run")
    return _with_current(placed.rows, placed).drop(PART)


def _runs_in_segments(numbered: DataFrame) -> DataFrame:
    """Runs of numbered rows in segments, each placed where the first row of its number is.

    Numbers rise along the segments, so the runs of later segments come after those of earlier ones.
    """
    runs = numbered.groupBy(*USER, "registration", "level", "run").agg(
        F.min("date").cast("date").alias("firstDay"), F.min(PART).alias(PART))
    return runs.withColumn(PART, F.min(PART).over(Window.partitionBy(*USER, "run")))


def scd2_level_history(events: DataFrame) -> DataFrame:
    """Type-2 rows of all known users.

    The narrow event rows are placed once, in segments; one exchange brings each segment together, finds
    its run starts, changes and runs. The runs keep their segments for the steps that look ahead.
    """
    rows = known_users(events).select(*USER, "registration", "level", F.col("ts").alias("date"))
    placed = in_segments(rows, USER, "date")
    flagged = _with_changes(run_starts(placed.rows), placed)
    numbered = _with_runs(flagged, placed, lambda rows: _with_changes(rows, placed))
    runs = placed.of(_runs_in_segments(numbered), "level-runs")
    return _with_current(_with_expiration(runs), runs).select(
        F.col("userId").cast("bigint"), "firstName", "lastName", "gender", "level",
        F.col("registration").cast("bigint"), F.col("firstDay").alias("rowActivationDate"),
        "rowExpirationDate", "currentRow")


def special_user_rows(events: DataFrame, special_ids: tuple[int, ...] = (0, 1)) -> DataFrame:
    """One open-ended row per level of the special users."""
    return (special_users(events, special_ids)
            .groupBy(*USER, "level", "registration")
            .agg(F.min("ts").cast("date").alias("rowActivationDate"))
            .select(F.col("userId").cast("bigint"), "firstName", "lastName", "gender", "level",
                    F.col("registration").cast("bigint"), "rowActivationDate",
                    F.lit(OPEN_END).alias("rowExpirationDate"),
                    F.lit(1).alias("currentRow")))


def users_with_special(events: DataFrame, special_ids: tuple[int, ...] = (0, 1)) -> DataFrame:
    """History of known users plus the rows of the special ones.

    With the default ids, user 1 appears in both parts; ``special_ids=(0,)``
    keeps the parts apart.
    """
    return scd2_level_history(events).unionByName(special_user_rows(events, special_ids))
