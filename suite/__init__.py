"""The library's queries over the supplied tables, each with an equivalent SQL statement."""

from suite import basic, files, ranking, relational, warehouse  # noqa: F401  (register queries)
from suite.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
