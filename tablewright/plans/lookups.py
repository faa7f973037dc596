"""A table with columns of others beside it, from a description.

    {"fact": "orders",
     "joins": [{"table": "users", "key": "user_id", "columns": {"city": "user_city"}}],
     "derive": {"order_day": "to_date(order_date)"},
     "columns": ["order_id", "user_id", "user_city", "order_day"]}

Every join is a left join on one key that both tables have. ``columns`` of a join maps columns of
its table to their names in the result; ``aggregate`` instead maps names to aggregate expressions
per key, which are computed first, so that the join meets one row per key. ``defaults`` holds
values for keys the table does not have. ``"unique": true`` declares that the key is one of its
table: a join then starts no search for keys that hold a large share of the rows. Otherwise the
joins are those of ``join_dataframes``, with its care for such keys; keys of aggregates and of
tables without duplicates are known to be unique from their plans.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.operators.joins import join_dataframes

_KEY = "__tw_lookup"


def check_lookups(description: Any, aliases) -> Mapping[str, Any] | None:
    """The description, if there is one; ValueError if it is not whole."""
    if description is None:
        return None
    if not isinstance(description, Mapping):
        raise ValueError("transformation.lookups must be an object")
    joins = description.get("joins", [])
    if not isinstance(joins, list) or not description.get("columns"):
        raise ValueError("transformation.lookups needs a list of joins, and columns")
    for join in joins:
        if not isinstance(join, Mapping) or not join.get("key"):
            raise ValueError("each join of transformation.lookups needs a table and a key")
        if not (join.get("columns") or join.get("aggregate")):
            raise ValueError("each join of transformation.lookups needs columns or aggregate")
    unknown = {description.get("fact"), *[join.get("table") for join in joins]} - set(aliases)
    if unknown:
        raise ValueError(f"transformation.lookups names unknown inputs: {sorted(map(str, unknown))}")
    return description


def joined_lookups(frames: Mapping[str | None, DataFrame], description: Mapping[str, Any]) -> DataFrame:
    """The table the description asks for."""
    result = frames[description["fact"]]
    for join in description.get("joins", []):
        result = _joined(result, frames[join["table"]], join)
    derived = {name: F.expr(text) for name, text in description.get("derive", {}).items()}
    return result.withColumns(derived).select(*description["columns"])


def _joined(fact: DataFrame, table: DataFrame, join: Mapping[str, Any]) -> DataFrame:
    key = F.col(join["key"]).alias(_KEY)
    if join.get("aggregate"):
        sums = [F.expr(text).alias(name) for name, text in join["aggregate"].items()]
        table = table.groupBy(key).agg(*sums)
    else:
        table = table.select(key, *[F.col(c).alias(name) for c, name in join["columns"].items()])
    sides = () if join.get("unique") else None
    result = join_dataframes(fact, table, join["key"], _KEY, "left", hot_sides=sides).drop(_KEY)
    filled = {name: F.coalesce(F.col(name), F.lit(value)) for name, value in join.get("defaults", {}).items()}
    return result.withColumns(filled)
