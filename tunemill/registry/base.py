"""Registration of queries, and assembly of the SQL they are checked against."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tunemill.registry.ctes import CTES
from tunemill.sources.given_tables import GivenTables

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

_STORED: dict[tuple[str, str, str], object] = {}


def stored_once(g: GivenTables, name: str, build: Callable[[], object]) -> object:
    """What ``build`` stored, built once per application and table folder.

    Several queries read the same lake, staging table or star; it is written by
    the first of them.
    """
    key = (g.spark.sparkContext.applicationId, g.sf_dir, name)
    if key not in _STORED:
        _STORED[key] = build()
    return _STORED[key]


def with_ctes(sql: str) -> str:
    """Put the common table expressions that ``sql`` names in front of it."""
    wanted: set[str] = set()
    text = [sql]
    for name in reversed(CTES):
        if any(re.search(rf"\b{name}\b", t) for t in text):
            wanted.add(name)
            text.append(CTES[name])
    parts = [f"{name} AS (\n{CTES[name].strip()}\n)" for name in CTES if name in wanted]
    return f"WITH {', '.join(parts)}\n{sql.strip()}" if parts else sql.strip()


def query(name: str, sql: str | None = None):
    """Register a function of the given tables under ``name``, with its SQL if it has one."""
    def register(build: Callable[[GivenTables], DataFrame]) -> Callable[[GivenTables], DataFrame]:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return build(GivenTables(spark, sf_dir))

        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = with_ctes(sql)
        return build
    return register
