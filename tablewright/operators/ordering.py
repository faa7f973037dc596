"""Global sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.arguments import as_list, sort_columns
from tablewright.keys import is_scan
from tablewright.staging import stage

_PLACE = "__tw_place"


def sort_rows(
    df: DataFrame,
    columns: str | Sequence[str],
    ascending: bool | Sequence[bool] = True,
) -> DataFrame:
    """Sort over all partitions; ascending puts NULLs first, descending puts them last.

    Rows with equal sort values may be any share of the table, copies of one row too, so the place
    of a row in the scan it comes from is the last sort column: range partitioning can then cut
    anywhere, and equal rows keep their order. Places must be the same whenever a task runs again
    and for the sampling before the sort, so an input that is more than a scan is written first; it
    would be computed twice otherwise.
    """
    names = as_list(columns)
    flags = [ascending] * len(names) if isinstance(ascending, bool) else list(ascending)
    if len(flags) != len(names):
        raise ValueError("ascending needs one flag per sort column")
    order = sort_columns(list(zip(names, flags)))
    source = df if is_scan(df) else stage(df, "rows")
    return source.withColumn(_PLACE, F.monotonically_increasing_id()).orderBy(*order, _PLACE).drop(_PLACE)
