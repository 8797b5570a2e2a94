"""All registered queries and the SQL they are checked against."""

from tunemill.registry import scalars, sequences, star, storage, streams  # noqa: F401
from tunemill.registry.base import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
