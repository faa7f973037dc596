"""Size checks: what may be broadcast, and which groups are too big for one task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.keys import is_unique
from tablewright.staging import rename_all, stage

# Largest side, in bytes, that an operator will ask Spark to broadcast.
BROADCAST_BYTES = 64 * 1024 * 1024

# Largest group, in rows, that an operator will hand to a single task.
HOT_GROUP_ROWS = 5_000_000

# Keys a sketch of frequent keys follows in each task.
SKETCH_KEYS = 20_000

_VARIABLE_WIDTH = (T.StringType, T.BinaryType, T.VarcharType, T.CharType)
_NESTED = (T.ArrayType, T.MapType, T.StructType)


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate; it needs no job and rises with the files read."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def measured_bytes(df: DataFrame) -> int:
    """Bytes of all rows, from one aggregation over the frame."""
    named = rename_all(df, "c")
    width = F.lit(16 * len(named.columns)).cast("bigint")
    for field in named.schema.fields:
        column = F.col(field.name)
        if isinstance(field.dataType, _NESTED):
            column = F.to_json(F.struct(column))
        elif not isinstance(field.dataType, _VARIABLE_WIDTH):
            continue
        width = width + F.coalesce(F.octet_length(column), F.lit(0))
    return named.agg(F.sum(width)).head()[0] or 0


def broadcast_if_small(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Hint ``df`` for broadcast only when its size is known to be within ``max_bytes``.

    A frame the optimizer already thinks too big is left alone without a job. The others are
    small scans, so they are measured; compressed files can hide a much larger frame. Without
    the hint Spark shuffles both sides, and AQE may still switch once it sees real sizes.
    """
    if estimated_bytes(df) > max_bytes or measured_bytes(df) > max_bytes:
        return df
    return F.broadcast(df)


class KeySummary(NamedTuple):
    """Rows, rows with a null part in their key, and hashes of the keys that may be frequent."""

    rows: int
    null_rows: int
    frequent: list[tuple[int, int]]


def key_summary(df: DataFrame, keys: Sequence[str], hot_rows: int = 0) -> KeySummary:
    """One pass over the key columns, with nothing shuffled but a sketch from each task.

    No key can have more than ``hot_rows`` rows where the table has not, so the rows are counted
    first, which reads no column of a plain scan. Then there are neither keys nor NULLs to report.
    ``approx_top_k`` is a bounded heavy-hitter summary: its counts are never too low, and a key with
    more than about a ``SKETCH_KEYS / 4``-th of all rows is always among them.
    """
    rows = df.count() if hot_rows else None
    if rows is not None and rows <= hot_rows:
        return KeySummary(rows, 0, [])
    null = reduce(or_, [F.col(k).isNull() for k in keys])
    coded = df.select(F.xxhash64(*keys).alias("key"), null.alias("null"))
    found = coded.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if("null").alias("null_rows"),
        F.expr(f"approx_top_k(key, {SKETCH_KEYS // 4}, {SKETCH_KEYS})").alias("top"),
    ).head()
    return KeySummary(found["rows"], found["null_rows"], [(one["item"], one["count"]) for one in found["top"]])


def hot_groups(
    df: DataFrame, keys: Sequence[str], hot_rows: int, summary: KeySummary | None = None
) -> DataFrame | None:
    """Key values with more than ``hot_rows`` rows as columns ``k0.., n``, or None.

    Only keys the summary holds for frequent are counted exactly, and only if there are any. They
    are a quarter of ``SKETCH_KEYS`` at most. They are written, so that their size is known and a
    join with them needs no shuffle of the rows by group.
    """
    summary = summary or key_summary(df, keys, hot_rows)
    codes = [code for code, count in summary.frequent if count > hot_rows]
    if not codes:
        return None
    some = df.where(F.xxhash64(*keys).isin(codes))
    named = some.groupBy(*keys).agg(F.count(F.lit(1))).toDF(*[f"k{i}" for i in range(len(keys))], "n")
    hot = stage(named.where(F.col("n") > hot_rows), "hot")
    return None if hot.isEmpty() else hot


def has_hot_group(df: DataFrame, keys: Sequence[str], hot_rows: int | None = None) -> bool:
    """Whether a value of ``keys`` has more than ``hot_rows`` rows; NULL is a value too.

    Rows are counted, whatever the size of the files: millions of equal keys compress to nothing. A
    plan that shows the keys to be unique needs no count.
    """
    if is_unique(df, keys):
        return False
    return hot_groups(df, keys, HOT_GROUP_ROWS if hot_rows is None else hot_rows) is not None
