"""Every registered query against its SQL in DuckDB, on the smallest tables."""

import re

import pytest

import check
from __spark_entry__ import entry, oracle_sql, queries
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def duck():
    return check.connect(SMALL)


def test_every_sql_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_every_query_has_sql():
    """All but those of the training-data part, whose own tests ask for SQL or a plain model."""
    own = {name for name in queries() if name != "pipeline" and not re.match(r"op\d+_", name)}
    assert own <= set(oracle_sql())


def test_entry_has_rows(spark):
    rows = entry(spark)
    assert rows.columns == ["userId", "level", "day", "plays"]
    assert rows.count() > 0


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, duck, name):
    good, note = check.compare(spark, duck, name, SMALL)
    assert good, note
    assert "types" not in note
