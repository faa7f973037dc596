"""Window functions that hold when one window partition is a large share of the table.

A plain Spark window sends each window partition to one task. Here that is done only where no
group has more than ``hot_rows`` rows. If one has, and for windows with no partitioning at all,
the rows of all groups are laid out in sorted ranges instead, so that the input is read once for
it and no row can be missed or doubled when it gives other rows each time it is read:

1. rows are range-partitioned and sorted by (group, order, place), each with its position; this
   layout is staged, since range limits come from sampling and must not be drawn twice;
2. each (range, group) is a *segment*; a small table holds what precedes every segment;
3. numbers inside a segment plus the segment's offset are the numbers over the whole group. Values
   of earlier or later rows come from inside the segment too, but for its first or last few rows:
   those get them from a table of the edges, a few rows for each range.

The place of a row, its number in the scan it comes from, cuts ranges anywhere in a run of equal
values, copies of one row included. An input that is more than a scan is written first, which also
spares the sampling a second run of it. Row numbers and ranks are ``bigint`` throughout.

Several functions over the same groups and order share one layout:

    WindowLayout(df, ["day"], ["shop"]).row_number().lag("sales").rank("place").result()
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from copy import copy
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewright.arguments import SortKey, as_list, sort_columns, sort_keys
from tablewright.keys import is_scan
from tablewright.sizing import broadcast_if_small, has_hot_group
from tablewright.staging import null_safe_match, stage

_PLACE = "__twin_place"
_POSITION = "__twin_position"
_RANGE = "__twin_range"
_LOCAL = "__twin_local"
_LOCAL_DENSE = "__twin_local_dense"
# monotonically_increasing_id keeps the partition above this many bits of row position.
_POSITION_BITS = 33

Keys = list[str]
Order = list[tuple[str, bool]]


# --- public operators -------------------------------------------------------------------


class WindowLayout:
    """Window functions over the same groups and order; each method adds a column, last ``result``.

    All are computed from the columns of ``df``, so a target may take the name of one of them.
    """

    def __init__(
        self,
        df: DataFrame,
        order_by: Sequence[SortKey],
        partition_by: Sequence[str] | None = None,
        hot_rows: int | None = None,
    ):
        self.df, self.order, self.keys = df, sort_keys(order_by), as_list(partition_by)
        self.ranged = not self.keys or has_hot_group(df, self.keys, hot_rows)
        self.functions: dict[str, _Function] = {}

    def _with(self, target: str, function: _Function) -> WindowLayout:
        added = copy(self)
        added.functions = {**self.functions, target: function}
        return added

    def row_number(self, target_column: str = "row_number") -> WindowLayout:
        """1, 2, 3, ... per window partition."""
        return self._with(target_column, _Function("row_number"))

    def rank(self, target_column: str = "rank") -> WindowLayout:
        """Equal rows share a rank; the next value skips ahead."""
        return self._with(target_column, _Function("rank"))

    def dense_rank(self, target_column: str = "dense_rank") -> WindowLayout:
        """Equal rows share a rank; ranks have no gaps."""
        return self._with(target_column, _Function("dense_rank"))

    def ntile(self, num_buckets: int = 4, target_column: str = "ntile") -> WindowLayout:
        """Bucket 1..n; bucket sizes differ by at most one row, the bigger ones first."""
        return self._with(target_column, _Function("ntile", num_buckets))

    def lag(
        self, source_column: str, offset: int = 1, default_value: Any | None = None, target_column: str | None = None
    ) -> WindowLayout:
        """Value ``offset`` rows earlier, or the default; named ``<source>_lag_<offset>``."""
        target = target_column or f"{source_column}_lag_{offset}"
        return self._with(target, _Function("shift", offset, source_column, default_value))

    def lead(
        self, source_column: str, offset: int = 1, default_value: Any | None = None, target_column: str | None = None
    ) -> WindowLayout:
        """Value ``offset`` rows later, or the default; named ``<source>_lead_<offset>``."""
        target = target_column or f"{source_column}_lead_{offset}"
        return self._with(target, _Function("shift", -offset, source_column, default_value))

    def result(self) -> DataFrame:
        """The rows of ``df`` with all columns asked for."""
        if self.ranged:
            return _ranged(self.df, self.keys, self.order, self.functions)
        window = Window.partitionBy(*self.keys).orderBy(*sort_columns(self.order))
        return self.df.withColumns({target: one.plain(window) for target, one in self.functions.items()})


@dataclass(frozen=True)
class _Function:
    """``number`` is the buckets of an ntile, or the rows a shift looks back."""

    name: str
    number: int = 0
    source: str | None = None
    default: Any | None = None

    def plain(self, window) -> Column:
        if self.name == "shift":
            return F.lag(self.source, self.number, self.default).over(window)
        value = F.ntile(self.number) if self.name == "ntile" else getattr(F, self.name)()
        return value.over(window).cast("bigint")


def lag(
    df: DataFrame,
    source_column: str,
    order_by: Sequence[SortKey],
    partition_by: Sequence[str] | None = None,
    offset: int = 1,
    default_value: Any | None = None,
    target_column: str | None = None,
    hot_rows: int | None = None,
) -> DataFrame:
    """Value ``offset`` rows earlier, or the default; named ``<source>_lag_<offset>``."""
    layout = WindowLayout(df, order_by, partition_by, hot_rows)
    return layout.lag(source_column, offset, default_value, target_column).result()


def lead(
    df: DataFrame,
    source_column: str,
    order_by: Sequence[SortKey],
    partition_by: Sequence[str] | None = None,
    offset: int = 1,
    default_value: Any | None = None,
    target_column: str | None = None,
    hot_rows: int | None = None,
) -> DataFrame:
    """Value ``offset`` rows later, or the default; named ``<source>_lead_<offset>``."""
    layout = WindowLayout(df, order_by, partition_by, hot_rows)
    return layout.lead(source_column, offset, default_value, target_column).result()


def row_number(
    df: DataFrame,
    order_by: Sequence[SortKey],
    partition_by: Sequence[str] | None = None,
    target_column: str = "row_number",
    hot_rows: int | None = None,
) -> DataFrame:
    """1, 2, 3, ... per window partition."""
    return WindowLayout(df, order_by, partition_by, hot_rows).row_number(target_column).result()


def rank(
    df: DataFrame,
    order_by: Sequence[SortKey],
    partition_by: Sequence[str] | None = None,
    target_column: str = "rank",
    hot_rows: int | None = None,
) -> DataFrame:
    """Equal rows share a rank; the next value skips ahead."""
    return WindowLayout(df, order_by, partition_by, hot_rows).rank(target_column).result()


def dense_rank(
    df: DataFrame,
    order_by: Sequence[SortKey],
    partition_by: Sequence[str] | None = None,
    target_column: str = "dense_rank",
    hot_rows: int | None = None,
) -> DataFrame:
    """Equal rows share a rank; ranks have no gaps."""
    return WindowLayout(df, order_by, partition_by, hot_rows).dense_rank(target_column).result()


def ntile(
    df: DataFrame,
    order_by: Sequence[SortKey],
    partition_by: Sequence[str] | None = None,
    num_buckets: int = 4,
    target_column: str = "ntile",
    hot_rows: int | None = None,
) -> DataFrame:
    """Bucket 1..n; bucket sizes differ by at most one row, the bigger ones first."""
    return WindowLayout(df, order_by, partition_by, hot_rows).ntile(num_buckets, target_column).result()


def numbered_in_ranges(
    df: DataFrame, keys: Keys, order: Order, number: str, group_rows: str
) -> DataFrame:
    """Row number and row count of the group, by the ranged layout whatever the group sizes."""
    laid = _laid_out(df, keys, order)
    numbered = _with_segments(laid, _segments(laid, keys, order, ties=False), keys)
    named = numbered.withColumns({number: _number(), group_rows: F.col("__twin_s_group_rows")})
    return named.drop(*[name for name in named.columns if name.startswith("__twin_")])


# --- the ranged layout ------------------------------------------------------------------


def _ranged(df: DataFrame, keys: Keys, order: Order, functions: Mapping[str, _Function]) -> DataFrame:
    """All functions from one layout. Ranks and shifts take one exchange by segment together."""
    laid = _laid_out(df, keys, order)
    ties = any(one.name in ("rank", "dense_rank") for one in functions.values())
    frame = _with_segments(laid, _segments(laid, keys, order, ties), keys)
    values = {}
    # Shifts come first: their sort by position also is the order that ranks need.
    shifts = [target for target, one in functions.items() if one.name == "shift"]
    for i, target in enumerate(shifts):
        frame, values[target] = _shifted(frame, keys, order, functions[target], i)
    if ties:
        inside = Window.partitionBy(_RANGE, *keys).orderBy(*sort_columns(order))
        frame = frame.withColumns({_LOCAL: F.rank().over(inside), _LOCAL_DENSE: F.dense_rank().over(inside)})
    for target, one in functions.items():
        if one.name != "shift":
            values[target] = _numeric(one).cast("bigint")
    return frame.withColumns(values).select(*_result_columns(df, functions))


def _result_columns(df: DataFrame, functions: Mapping[str, _Function]) -> list[Column]:
    return [F.col(f"`{name}`") for name in [*df.columns, *[t for t in functions if t not in df.columns]]]


def _number() -> Column:
    """Row number over the whole group."""
    return F.col("__twin_s_rows_before") + F.col(_POSITION) - F.col("__twin_s_start") + 1


def _numeric(function: _Function) -> Column:
    """Row numbers, buckets and ranks from the facts of a segment."""
    if function.name == "row_number":
        return _number()
    if function.name == "rank":
        continues = F.col("__twin_s_continues") & (F.col(_LOCAL) == 1)
        counted = F.col("__twin_s_rows_before") + F.col(_LOCAL)
        return F.when(continues, F.col("__twin_s_rank_before")).otherwise(counted)
    if function.name == "dense_rank":
        return F.col("__twin_s_dense_before") + F.col(_LOCAL_DENSE)
    row, buckets = _number() - 1, F.lit(function.number).cast("bigint")
    large = F.pmod(F.col("__twin_s_group_rows"), buckets)
    size = ((F.col("__twin_s_group_rows") - large) / buckets).cast("bigint")
    in_large = large * (size + 1)
    bucket = F.when(row < in_large, F.floor(row / (size + 1))).otherwise(
        large + F.floor((row - in_large) / F.greatest(size, F.lit(1)))
    )
    return bucket + 1


def _shifted(
    frame: DataFrame, keys: Keys, order: Order, function: _Function, i: int
) -> tuple[DataFrame, Column]:
    """The frame with what the value needs, and the value ``function.number`` rows back.

    The edges are the last rows of the segments that another one goes on from, or their first ones
    where the shift looks ahead: at most that many rows of each range.
    """
    back, distance = function.number >= 0, abs(function.number)
    local, edge, number = f"__twin_local_{i}", f"__twin_edge_{i}", f"__twin_edge_number_{i}"
    kind = frame.schema[function.source].dataType
    at = F.col(_POSITION) - F.col("__twin_s_start") + 1
    left = F.col("__twin_s_rows") - at
    begins, ends = F.col("__twin_s_rows_before") == 0, F.col("__twin_s_after") == 0
    at_edge = (~ends & (left < distance)) if back else (~begins & (at <= distance))
    names = [f"__twin_edge_key_{i}_{j}" for j in range(len(keys))]
    edges = frame.where(at_edge).select(
        *[F.col(f"`{key}`").alias(name) for key, name in zip(keys, names)],
        (_number() + function.number).alias(number),
        F.col(f"`{function.source}`").alias(edge),
    )
    edges = broadcast_if_small(stage(edges, "edges"))
    inside = Window.partitionBy(_RANGE, *keys).orderBy(*sort_columns(order), _POSITION)
    frame = frame.withColumn(local, F.lag(function.source, function.number).over(inside))
    same = null_safe_match([frame[key] for key in keys], [edges[name] for name in names])
    frame = frame.join(edges, same & (_number() == edges[number]), "left").drop(*names, number)
    outside = (_number() <= distance) if back else (_number() + distance > F.col("__twin_s_group_rows"))
    within = (at > distance) if back else (left >= distance)
    value = F.when(outside, F.lit(function.default).cast(kind)).when(within, F.col(local))
    return frame, value.otherwise(F.col(edge))


def _laid_out(df: DataFrame, keys: Keys, order: Order) -> DataFrame:
    """Rows in sorted ranges, staged, with their range and their position inside it."""
    source = df if is_scan(df) else stage(df, "rows")
    sorting = [*[F.col(k).asc() for k in keys], *sort_columns(order), F.col(_PLACE).asc()]
    laid = (
        source.withColumn(_PLACE, F.monotonically_increasing_id())
        .repartitionByRange(*sorting)
        .sortWithinPartitions(*sorting)
        .drop(_PLACE)
        .withColumn(_POSITION, F.monotonically_increasing_id())
    )
    return stage(laid, "ranges").withColumn(_RANGE, F.shiftright(_POSITION, _POSITION_BITS))


def _segment_windows(keys: Keys):
    """Windows over the segments of a group, in range order.

    The segment table has at most one row per range and one more per group: without keys it
    is as long as the number of shuffle partitions, so one task is plenty. With keys it can be
    as long as the number of groups.
    """
    ordered = Window.partitionBy(*keys).orderBy(_RANGE)
    earlier = ordered.rowsBetween(Window.unboundedPreceding, -1)
    so_far = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return ordered, earlier, so_far


def _with_segments(laid: DataFrame, segments: DataFrame, keys: Keys) -> DataFrame:
    """Attach the segment table, broadcast where its measured size allows it.

    Otherwise both are shuffled by range and group, and a segment is never more than a range.
    """
    names = [_RANGE, *keys]
    values = [c for c in segments.columns if c.startswith("__twin_s_")]
    renamed = segments.select(
        *[F.col(c).alias(f"__twin_k_{i}") for i, c in enumerate(names)], *values
    )
    # Without keys there is one row per range.
    renamed = broadcast_if_small(stage(renamed, "segments")) if keys else F.broadcast(renamed)
    matched = null_safe_match(
        [laid[c] for c in names], [renamed[f"__twin_k_{i}"] for i in range(len(names))]
    )
    joined = laid.join(renamed, matched, "left")
    return joined.drop(*[f"__twin_k_{i}" for i in range(len(names))])


def _segments(laid: DataFrame, keys: Keys, order: Order, ties: bool) -> DataFrame:
    """What precedes and follows every segment of a group, as columns ``__twin_s_...``.

    With ``ties`` also the rank reached before it, for runs of equal values that cross range limits;
    those are collapsed on the map side first, and only they make up the table.
    """
    ordered, earlier, so_far = _segment_windows(keys)
    rows = {"__twin_s_rows": F.count(F.lit(1)), "__twin_s_start": F.min(_POSITION)}
    if not ties:
        segments = laid.groupBy(_RANGE, *keys).agg(*[one.alias(name) for name, one in rows.items()])
        return segments.withColumns(_neighbours(keys, earlier))
    names = [name for name, _ in order]
    value, start = F.struct(*names), F.col("__twin_start")
    runs = laid.groupBy(*dict.fromkeys([_RANGE, *keys, *names])).agg(
        F.count(F.lit(1)).alias("__twin_n"), F.min(_POSITION).alias("__twin_start")
    )
    return (
        runs.groupBy(_RANGE, *keys)
        .agg(
            F.sum("__twin_n").alias("__twin_s_rows"),
            F.min(start).alias("__twin_s_start"),
            (F.max(start) - F.min(start) + 1).alias("__twin_last_rank"),
            F.count(F.lit(1)).alias("__twin_values"),
            F.min_by(value, start).alias("__twin_first_value"),
            F.max_by(value, start).alias("__twin_last_value"),
        )
        .withColumns(_neighbours(keys, earlier))
        .withColumn("__twin_previous_last", F.lag("__twin_last_value").over(ordered))
        .withColumn("__twin_has_previous", F.lag(F.lit(True), 1, False).over(ordered))
        .withColumn(
            "__twin_s_continues",
            F.col("__twin_has_previous")
            & F.col("__twin_first_value").eqNullSafe(F.col("__twin_previous_last")),
        )
        .withColumn(
            "__twin_s_dense_before",
            F.coalesce(F.sum("__twin_values").over(earlier), F.lit(0))
            - F.sum(F.col("__twin_s_continues").cast("int")).over(so_far),
        )
        # The rank of a segment's last value is known unless the whole segment is one run
        # that began earlier; then the latest known one holds.
        .withColumn(
            "__twin_known_rank",
            F.when(
                ~(F.col("__twin_s_continues") & (F.col("__twin_values") == 1)),
                F.col("__twin_s_rows_before") + F.col("__twin_last_rank"),
            ),
        )
        .withColumn(
            "__twin_s_rank_before", F.last("__twin_known_rank", ignorenulls=True).over(earlier)
        )
    )


def _neighbours(keys: Keys, earlier) -> dict[str, Column]:
    """Rows of the group, and those before and after the segment."""
    before = F.coalesce(F.sum("__twin_s_rows").over(earlier), F.lit(0))
    whole = F.sum("__twin_s_rows").over(Window.partitionBy(*keys))
    after = whole - before - F.col("__twin_s_rows")
    return {"__twin_s_rows_before": before, "__twin_s_group_rows": whole, "__twin_s_after": after}
