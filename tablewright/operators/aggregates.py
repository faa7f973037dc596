"""Grouped aggregation, pivot and one-row totals."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.arguments import as_list
from tablewright.keys import is_scan, is_unique
from tablewright.operators.windows import numbered_in_ranges
from tablewright.sizing import HOT_GROUP_ROWS, broadcast_if_small, hot_groups
from tablewright.staging import null_safe_match, stage

# Aggregates that Spark reduces on the map side to a state of fixed size per group.
COMBINABLE = frozenset(
    [
        "any_value", "approx_count_distinct", "avg", "bit_and", "bit_or", "bit_xor", "bool_and",
        "bool_or", "count", "count_distinct", "countDistinct", "count_if", "every", "first",
        "first_value", "kurtosis", "last", "last_value", "max", "mean", "min", "product",
        "skewness", "some", "std", "stddev", "stddev_pop", "stddev_samp", "sum", "sumDistinct",
        "sum_distinct", "try_avg", "try_sum", "var_pop", "var_samp", "variance",
    ]
)

_ALL, _ROWS, _VALUE, _CELL = "__tw_all", "__tw_rows", "__tw_value", "__tw_cell"
_LOW, _HIGH, _BELOW, _INSIDE = "__tw_low", "__tw_high", "__tw_below", "__tw_inside"

# A summary of a group is right to one in so many rows, and the middle is looked for twice as far.
SUMMARY_ACCURACY = 10_000

# Aggregates whose state grows with the group; these have their own two-step plans.
GROWING = frozenset({"median", "mode"})


def _check(name: str) -> str:
    if name not in COMBINABLE | GROWING:
        known = ", ".join(sorted(COMBINABLE | GROWING))
        raise ValueError(f"unsupported aggregate {name!r}; available: {known}")
    return name


def aggregate_data(
    df: DataFrame,
    group_by: str | Sequence[str] | None,
    aggregations: Mapping[str, str | Sequence[str]],
    hot_rows: int | None = None,
) -> DataFrame:
    """Aggregate per group; results are named ``<column>_<function>``.

    ``aggregations`` maps a column to one function name or several. No groups means one row.
    """
    keys = as_list(group_by)
    wanted = [(c, _check(f)) for c, names in aggregations.items() for f in as_list(names)]
    if not wanted:
        raise ValueError("aggregate_data needs at least one aggregation")
    names = [f"{c}_{f}" for c, f in wanted]
    simple = [
        getattr(F, f)(F.col(c)).alias(f"{c}_{f}") for c, f in wanted if f in COMBINABLE
    ]
    growing = [(c, f) for c, f in wanted if f in GROWING]
    if not growing:
        return df.groupBy(*keys).agg(*simple)

    # Every group has a row here, the whole table too when it is empty.
    result = df.groupBy(*keys).agg(*simple, F.count(F.lit(1)).alias(_ROWS))
    if not keys:
        df, result = df.withColumn(_ALL, F.lit(0)), result.withColumn(_ALL, F.lit(0))
    groups = keys or [_ALL]
    for c, f in growing:
        name = f"{c}_{f}"
        if f == "median":
            part = _median(df, groups, c, name, hot_rows)
        else:
            part = _mode(df, groups, c, name)
        result = _attached(result, part, groups)
    return result.select(*keys, *names)


def _attached(rows: DataFrame, per_group: DataFrame, keys: list[str]) -> DataFrame:
    """Left join with a table of one row per group; NULL is a group."""
    names = [f"__tw_{i}" for i in range(len(keys))]
    values = [c for c in per_group.columns if c not in keys]
    other = per_group.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], *values)
    same = null_safe_match([rows[k] for k in keys], [other[n] for n in names])
    return rows.join(other, same, "left").drop(*names)


def _median(df: DataFrame, keys: list[str], c: str, name: str, hot_rows: int | None) -> DataFrame:
    """Spark's median holds a group's distinct values in one task; those of big groups are selected."""
    narrow = df.select(*dict.fromkeys([*keys, c]))
    plain = F.median(c).alias(name)
    if is_unique(narrow, keys):
        return narrow.groupBy(*keys).agg(plain)
    hot = hot_groups(narrow, keys, HOT_GROUP_ROWS if hot_rows is None else hot_rows)
    if hot is None:
        return narrow.groupBy(*keys).agg(plain)
    rows = narrow if is_scan(narrow) else stage(narrow, "median")
    big = broadcast_if_small(hot.select(*[F.col(f"k{i}").alias(f"__tw_{i}") for i in range(len(keys))]))
    same = null_safe_match([rows[k] for k in keys], [big[f"__tw_{i}"] for i in range(len(keys))])
    others = rows.join(big, same, "left_anti").groupBy(*keys).agg(plain)
    return others.union(_selected_median(rows.join(big, same, "left_semi"), keys, c, name))


def _selected_median(df: DataFrame, keys: list[str], c: str, name: str) -> DataFrame:
    """Mean of the one or two middle values of each group, without sorting the group.

    A mergeable summary brackets the middle within a few ten-thousandths of the rows, an exact count
    of the rows below and inside checks that, and only the rows inside are ranked, over many tasks.
    A bracket that misses the middle is opened to the whole group, so the result is always exact.
    """
    filled = df.select(*keys, F.col(c).cast("double").alias(_VALUE)).where(F.col(_VALUE).isNotNull())
    # NaN is the largest value; the summary takes it for infinity.
    point = F.when(F.isnan(_VALUE), F.lit(float("inf"))).otherwise(F.col(_VALUE))
    below, inside = point < F.col(_LOW), point.between(F.col(_LOW), F.col(_HIGH))
    spread = 2 / SUMMARY_ACCURACY
    fences = F.percentile_approx(point, [0.5 - spread, 0.5 + spread], SUMMARY_ACCURACY)
    summary = filled.groupBy(*keys).agg(F.count(F.lit(1)).alias(_ROWS), fences.alias("__tw_fences"))
    brackets = summary.withColumns({_LOW: F.col("__tw_fences")[0], _HIGH: F.col("__tw_fences")[1]})
    brackets = stage(brackets.select(*keys, _ROWS, _LOW, _HIGH), "brackets")

    counted = _attached(filled, broadcast_if_small(brackets), keys).groupBy(*keys).agg(
        F.count_if(below).alias(_BELOW), F.count_if(inside).alias(_INSIDE)
    )
    checked = _attached(brackets, counted, keys)
    # Places from 1 of the one or two middle rows.
    first, last = F.expr(f"({_ROWS} + 1) DIV 2"), F.expr(f"{_ROWS} DIV 2 + 1")
    missed = (F.col(_BELOW) >= first) | (F.col(_BELOW) + F.col(_INSIDE) < last)
    exact = checked.select(
        *keys, _ROWS,
        F.when(missed, F.lit(float("-inf"))).otherwise(F.col(_LOW)).alias(_LOW),
        F.when(missed, F.lit(float("inf"))).otherwise(F.col(_HIGH)).alias(_HIGH),
        F.when(missed, F.lit(0)).otherwise(F.col(_BELOW)).alias(_BELOW),
    )
    near = _attached(filled, broadcast_if_small(stage(exact, "brackets")), keys).where(inside)
    numbered = numbered_in_ranges(near, keys, [(_VALUE, True)], "__tw_row", "__tw_near")
    middle = (F.col("__tw_row") + F.col(_BELOW)).between(first, last)
    return numbered.where(middle).groupBy(*keys).agg(F.avg(_VALUE).alias(name))


def _mode(df: DataFrame, keys: list[str], c: str, name: str) -> DataFrame:
    """Most frequent value, the largest among equals: count values first, then compare."""
    narrow = df.select(*dict.fromkeys([*keys, c]))
    counted = narrow.groupBy(*dict.fromkeys([*keys, c])).agg(
        F.count(c).alias("__tw_n")
    )
    best = F.max(F.when(F.col(c).isNotNull(), F.struct("__tw_n", F.col(c).alias("v"))))
    return counted.groupBy(*keys).agg(best["v"].alias(name))


def pivot_data(
    df: DataFrame,
    group_by: str | Sequence[str],
    pivot_column: str,
    value_column: str,
    agg_func: str = "sum",
    values: Sequence | None = None,
) -> DataFrame:
    """One column per pivot value; combinations without rows are NULL.

    Values not listed are looked up first. That is a pass over the pivot column of a scan. Anything
    more than a scan is aggregated to the long form and written, which gives the values and the
    cells, so its upstream runs once. More values than ``spark.sql.pivotMaxValues`` are an error;
    ``pivot_long`` has no such limit.
    """
    if _check(agg_func) in GROWING:
        raise ValueError(f"{agg_func!r} can not be pivoted; aggregate first")
    keys = as_list(group_by)
    cell = getattr(F, agg_func)(F.col(value_column))
    if values is not None or is_scan(df):
        pivoted = df.groupBy(*keys).pivot(pivot_column, list(values) if values is not None else None)
        return pivoted.agg(cell)
    cells = stage(df.groupBy(*dict.fromkeys([*keys, pivot_column])).agg(cell.alias(_CELL)), "cells")
    most = int(df.sparkSession.conf.get("spark.sql.pivotMaxValues"))
    found = cells.select(pivot_column).distinct().sort(pivot_column).limit(most + 1).collect()
    if len(found) > most:
        raise ValueError(f"{pivot_column!r} has more than {most} values; use pivot_long")
    return cells.groupBy(*keys).pivot(pivot_column, [row[0] for row in found]).agg(F.first(_CELL))


def pivot_long(
    df: DataFrame,
    group_by: str | Sequence[str],
    pivot_column: str,
    value_column: str,
    agg_func: str = "sum",
    hot_rows: int | None = None,
) -> DataFrame:
    """A row per group and pivot value, named as by ``aggregate_data``, for any number of values.

    NULL is a pivot value; combinations without rows have no row.
    """
    keys = dict.fromkeys([*as_list(group_by), pivot_column])
    return aggregate_data(df, list(keys), {value_column: agg_func}, hot_rows)


def _total(
    df: DataFrame, columns: str | Sequence[str], function: Callable[[Column], Column], name: str
) -> DataFrame:
    return df.agg(*[function(F.col(c)).alias(f"{c}_{name}") for c in as_list(columns)])


def total_sum(df: DataFrame, sum_columns: str | Sequence[str]) -> DataFrame:
    """One row with ``<column>_sum``."""
    return _total(df, sum_columns, F.sum, "sum")


def total_avg(df: DataFrame, avg_columns: str | Sequence[str]) -> DataFrame:
    """One row with ``<column>_avg``."""
    return _total(df, avg_columns, F.avg, "avg")


def total_min(df: DataFrame, min_column: str | Sequence[str]) -> DataFrame:
    """One row with ``<column>_min``."""
    return _total(df, min_column, F.min, "min")


def total_max(df: DataFrame, max_column: str | Sequence[str]) -> DataFrame:
    """One row with ``<column>_max``."""
    return _total(df, max_column, F.max, "max")
