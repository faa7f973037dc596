"""Duplicate removal."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablewright.arguments import SortKey, as_list, sort_columns, sort_keys

_RANK = "__tw_first"


def drop_duplicates(
    df: DataFrame,
    subset: str | Sequence[str] | None = None,
    order_by: Sequence[SortKey] | None = None,
) -> DataFrame:
    """Distinct rows, or one row per ``subset`` value.

    Without ``order_by`` the survivor of a key is any of its rows. With it, the first row in
    that order survives. Both forms reduce every key to one row per map task before the
    shuffle (partial aggregation, or Spark's group limit below ``row_number() = 1``), so a key
    held by a large share of the rows moves only a handful of them.
    """
    keys = as_list(subset)
    if not keys:
        return df.distinct()
    if order_by is None:
        return df.dropDuplicates(keys)
    window = Window.partitionBy(*keys).orderBy(*sort_columns(sort_keys(order_by)))
    numbered = df.withColumn(_RANK, F.row_number().over(window))
    return numbered.where(F.col(_RANK) == 1).drop(_RANK)
