"""Joins.

All are equi-joins on the AND of ``left key = right key``: NULL keys match nothing, and the
result holds the key columns of both sides. Spark picks hash or sort-merge.

A key may hold a large share of the rows. AQE splits such a partition at run time on the sides
it can: both for inner joins, the preserved one for left, right, semi and anti joins. The other
sides are seen to here. One whose keys the plan shows to be unique (after an aggregation or a
removal of duplicates) can have no hot key, and no job is run for it. Of any other, one pass over
the key columns makes a bounded summary of frequent keys. If a key has more than ``hot_rows`` rows,
or rows with a NULL key on a side whose unmatched rows are kept are as many, they are spread over
tasks. For that the side is written as a table, so that the position of a row and the join see the
same rows. A side that is more than a scan is written before its summary, and not computed twice;
address the columns of the result by name. Repeated right keys of a semi or anti join change
nothing and go before the join.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.arguments import as_list
from tablewright.keys import is_scan, is_unique
from tablewright.sizing import (
    BROADCAST_BYTES,
    HOT_GROUP_ROWS,
    broadcast_if_small,
    has_hot_group,
    hot_groups,
    key_summary,
)
from tablewright.staging import null_safe_match, stage

# Join types which can be run with the right side broadcast.
_RIGHT_BUILDABLE = {"inner", "cross", "left", "leftouter", "leftsemi", "semi", "leftanti", "anti"}
_LEFT_ONLY = {"leftsemi", "semi", "leftanti", "anti"}
_BOTH = ("left", "right")
# Sides whose partitions AQE can not split; semi and anti joins are seen to apart.
_UNSPLITTABLE = {
    "left": ("right",), "leftouter": ("right",), "right": ("left",), "rightouter": ("left",),
    "full": _BOTH, "outer": _BOTH, "fullouter": _BOTH,
}
_KEEPS_RIGHT = {"right", "rightouter", "full", "outer", "fullouter"}
_KEEPS_LEFT = {"left", "leftouter", "full", "outer", "fullouter"}


def _kind(join_type: str) -> str:
    return join_type.lower().replace("_", "")


def _key_pairs(left_keys, right_keys) -> list[tuple[str, str]]:
    left = as_list(left_keys)
    right = as_list(right_keys) or left
    if not left:
        raise ValueError("a join needs at least one key")
    if len(left) != len(right):
        raise ValueError("left_keys and right_keys differ in length")
    return list(zip(left, right))


def _keys_equal(left: DataFrame, right: DataFrame, pairs, aliases=None) -> Column:
    """Keys are found by alias where there is one, as both sides may be the same table."""
    if aliases:
        names = [tuple(f"{alias}.`{k}`" for alias, k in zip(aliases, pair)) for pair in pairs]
        return reduce(and_, [F.col(a) == F.col(b) for a, b in names])
    return reduce(and_, [left[a] == right[b] for a, b in pairs])


def join_dataframes(
    left_df: DataFrame,
    right_df: DataFrame,
    left_keys: str | Sequence[str],
    right_keys: str | Sequence[str] | None = None,
    join_type: str = "inner",
    suffixes: tuple[str, str] | None = None,
    hot_rows: int = HOT_GROUP_ROWS,
    hot_sides: Sequence[str] | None = None,
) -> DataFrame:
    """Equi-join on one or more keys, which may be named differently on the two sides.

    ``suffixes`` renames columns found on both sides. ``hot_sides`` names the sides checked for
    hot keys, ``left`` or ``right``; by default those that AQE can not split.
    """
    pairs = _key_pairs(left_keys, right_keys)
    if suffixes and _kind(join_type) not in _LEFT_ONLY:
        left_df, right_df, pairs = _with_suffixes(left_df, right_df, pairs, suffixes)
    return _equi_join(left_df, right_df, pairs, join_type, hot_rows, hot_sides)


def _equi_join(
    left: DataFrame,
    right: DataFrame,
    pairs: list[tuple[str, str]],
    join_type: str,
    hot_rows: int = HOT_GROUP_ROWS,
    hot_sides: Sequence[str] | None = None,
    aliases: tuple[str, str] | None = None,
) -> DataFrame:
    kind = _kind(join_type)
    if kind in _LEFT_ONLY:
        right = _lookup_keys(right, [b for _, b in pairs], hot_rows)
        right = right.alias(aliases[1]) if aliases else right
    if hot_sides is None:
        hot_sides = _UNSPLITTABLE.get(kind, ())
    hot_sides = [
        side for side in hot_sides
        if not is_unique(*((left, [a for a, _ in pairs]) if side == "left" else (right, [b for _, b in pairs])))
    ]
    if hot_sides:
        spread = _spread_join(left, right, pairs, join_type, hot_rows, hot_sides, aliases)
        if spread is not None:
            return spread
    return left.join(right, _keys_equal(left, right, pairs, aliases), join_type)


def _lookup_keys(right: DataFrame, keys: list[str], hot_rows: int) -> DataFrame:
    """The right keys of a semi or anti join, without NULLs, which match nothing.

    AQE splits the left side of such a join as long as both sides come straight from a shuffle
    or a scan. So repeated keys are left in, unless one is hot; then the distinct keys are
    written first.
    """
    found = right.select(*keys).where(reduce(and_, [F.col(k).isNotNull() for k in keys]))
    return stage(found.distinct(), "keys") if has_hot_group(found, keys, hot_rows) else found


def _with_suffixes(left, right, pairs, suffixes):
    shared = set(left.columns) & set(right.columns)
    rename_left = {c: c + suffixes[0] for c in shared}
    rename_right = {c: c + suffixes[1] for c in shared}
    left = left.toDF(*[rename_left.get(c, c) for c in left.columns])
    right = right.toDF(*[rename_right.get(c, c) for c in right.columns])
    return left, right, [(rename_left.get(a, a), rename_right.get(b, b)) for a, b in pairs]


def broadcast_join_dataframes(
    left_df: DataFrame,
    right_df: DataFrame,
    left_keys: str | Sequence[str],
    right_keys: str | Sequence[str] | None = None,
    join_type: str = "inner",
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Join with the right side broadcast if its measured size allows, else a plain join."""
    hinted = right_df
    if _kind(join_type) in _RIGHT_BUILDABLE:
        hinted = broadcast_if_small(right_df, max_bytes)
    if hinted is right_df:
        return join_dataframes(left_df, right_df, left_keys, right_keys, join_type)
    matched = _keys_equal(left_df, right_df, _key_pairs(left_keys, right_keys))
    return left_df.join(hinted, matched, join_type)


def cross_join_dataframes(
    left_df: DataFrame, right_df: DataFrame, max_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Cartesian product; a right side small enough is broadcast, so the left is not moved."""
    return left_df.crossJoin(broadcast_if_small(right_df, max_bytes))


def join_with_aliases(
    left_df: DataFrame,
    right_df: DataFrame,
    left_alias: str,
    right_alias: str,
    left_keys: str | Sequence[str],
    right_keys: str | Sequence[str] | None = None,
    join_type: str = "inner",
    hot_rows: int = HOT_GROUP_ROWS,
    hot_sides: Sequence[str] | None = None,
) -> DataFrame:
    """Equi-join whose columns are addressed as ``<alias>.<column>``."""
    return _equi_join(
        left_df.alias(left_alias),
        right_df.alias(right_alias),
        _key_pairs(left_keys, right_keys),
        join_type,
        hot_rows,
        hot_sides,
        (left_alias, right_alias),
    )


def self_join(
    df: DataFrame, keys: str | Sequence[str], join_type: str = "inner"
) -> DataFrame:
    """A table joined with itself; the sides are addressed as ``left`` and ``right``."""
    return join_with_aliases(df, df, "left", "right", keys, join_type=join_type)


# --- spreading hot keys -----------------------------------------------------------------


def _spread_join(
    left: DataFrame,
    right: DataFrame,
    pairs: list[tuple[str, str]],
    join_type: str,
    hot_rows: int,
    sides: Sequence[str],
    aliases: tuple[str, str] | None,
) -> DataFrame | None:
    """Exact join of any type in which no task gets a whole hot key; None without hot keys.

    A full join is made in pieces, see ``_full_join_in_pieces``. Of the others:

    A key with ``a`` parts on the left and ``b`` on the right, 1 where it is not hot, has
    ``a * b`` buckets. A left row belongs to one of the ``a`` parts by its position in the
    written table and goes into the ``b`` buckets of that part; right rows alike. Each pair of
    rows meets in one bucket. A repeated row of an outer side finds no partner in some bucket
    although its key, being hot on the other side, has partners; those rows are removed. Rows
    with a NULL key have parts, but are never repeated.
    """
    kind = _kind(join_type)
    if kind in _LEFT_ONLY:
        return None
    left_keys, right_keys = [a for a, _ in pairs], [b for _, b in pairs]
    frames, hot, nulls, written = {"left": left, "right": right}, {}, {}, set()
    for side, keys, keeps in (("left", left_keys, _KEEPS_LEFT), ("right", right_keys, _KEEPS_RIGHT)):
        hot[side], nulls[side] = None, 0
        if side in sides:
            if not is_scan(frames[side]):
                frames[side] = _written(frames[side], aliases and aliases[side == "right"])
                written.add(side)
            summary = key_summary(frames[side], keys, hot_rows)
            hot[side] = hot_groups(frames[side].where(~_null_key(keys)), keys, hot_rows, summary)
            # AQE splits a kept side of a left or right join, with its NULLs.
            nulls[side] = summary.null_rows if kind in keeps else 0
    if hot["left"] is None and hot["right"] is None and max(nulls.values()) <= hot_rows:
        if not written:
            return None
        matched = _keys_equal(frames["left"], frames["right"], pairs, aliases)
        return frames["left"].join(frames["right"], matched, join_type)

    keys_of = {"left": left_keys, "right": right_keys}
    for side in _BOTH:
        if side not in written and (hot[side] is not None or nulls[side] > hot_rows):
            frames[side] = _written(frames[side], aliases and aliases[side == "right"], "spread")
            written.add(side)
    if kind in _KEEPS_LEFT & _KEEPS_RIGHT and _key_types(left, left_keys) == _key_types(right, right_keys):
        for side in _BOTH:
            if side not in written and not is_scan(frames[side]):
                frames[side] = _written(frames[side], aliases and aliases[side == "right"])
        return _full_join_in_pieces(frames, keys_of, pairs, hot, hot_rows, aliases)

    spread = {}
    for side, other in (("left", "right"), ("right", "left")):
        df, keys = frames[side], keys_of[side]
        parts = _bucketed(df, keys, hot[side], hot[other], nulls[side], hot_rows, side)
        spread[side] = parts.alias(aliases[side == "right"]) if aliases else parts
    same_bucket = F.col("__tw_left_bucket") == F.col("__tw_right_bucket")
    matched = _keys_equal(spread["left"], spread["right"], pairs, aliases) & same_bucket
    joined = spread["left"].join(spread["right"], matched, join_type)
    alone = []
    if kind in _KEEPS_LEFT:
        alone.append(F.col("__tw_left_repeated") & F.col("__tw_right_bucket").isNull())
    if kind in _KEEPS_RIGHT:
        alone.append(F.col("__tw_right_repeated") & F.col("__tw_left_bucket").isNull())
    if alone:
        joined = joined.where(~F.coalesce(reduce(or_, alone), F.lit(False)))
    return joined.drop(*[c for c in joined.columns if c.startswith("__tw_")])


def _null_key(keys: list[str]) -> Column:
    """A key with a NULL part matches nothing."""
    return reduce(or_, [F.col(k).isNull() for k in keys])


def _key_types(df: DataFrame, keys: list[str]) -> list:
    return [field.dataType for field in df.select(*keys).schema.fields]


def _written(df: DataFrame, alias: str | None, label: str = "side") -> DataFrame:
    table = stage(df, label)
    return table.alias(alias) if alias else table


def _full_join_in_pieces(
    frames: dict[str, DataFrame],
    keys: dict[str, list[str]],
    pairs: list[tuple[str, str]],
    hot: dict[str, DataFrame | None],
    hot_rows: int,
    aliases: tuple[str, str] | None,
) -> DataFrame:
    """Full join with the pairs of hot keys made by an inner join.

    A hot key can have very many pairs, and a full join compares and marks each of them. The rows of
    hot keys are counted on both sides first, so it is known which of these keys have partners.
    Rows without a partner and those with a NULL key need no join, the other keys a plain one.
    """
    parts, sides = len(pairs), {side: _keyed(frames[side], keys[side], side) for side in _BOTH}
    known = [f"k{i}" for i in range(parts)]
    found = [table.select(*known) for table in hot.values() if table is not None]
    rest, pieces = dict(frames), []
    if found:
        table = broadcast_if_small(_met(sides, broadcast_if_small(reduce(DataFrame.union, found).distinct()), hot_rows))
        for side in _BOTH:
            same = reduce(and_, [frames[side][k] == table[n] for k, n in zip(keys[side], known)])
            rest[side] = frames[side].join(table, same, "left_anti")
    for side in _BOTH:
        rest[side] = rest[side].where(~_null_key(keys[side]))
        if aliases:
            rest[side] = rest[side].alias(aliases[side == "right"])
    joined = rest["left"].join(rest["right"], _keys_equal(rest["left"], rest["right"], pairs, aliases), "full")

    values = {side: [c for c in sides[side].columns if "_key" not in c] for side in _BOTH}
    absent = {
        side: [F.lit(None).cast(field.dataType) for field in frames[side].schema.fields] for side in _BOTH
    }
    alone = {side: sides[side].where(_null_key(_key_names(side, parts))) for side in _BOTH}
    if found:
        own, other = F.col("left_parts"), F.col("right_parts")
        dealt, tasks = {}, int(frames["left"].sparkSession.conf.get("spark.sql.shuffle.partitions"))
        for side, mine, theirs in (("left", own, other), ("right", other, own)):
            # The place of the row in the table it is read from; consecutive ones differ in the row.
            placed = sides[side].withColumn("__tw_place", F.monotonically_increasing_id())
            held = placed.join(table, _same_keys(side, table, parts)).drop(*known)
            part = F.pmod(F.xxhash64("__tw_place"), mine).cast("int")
            # The buckets of a part: of the left a row of the grid, of the right a column.
            first, step = (part * other, F.lit(1)) if side == "left" else (part, other)
            buckets = F.sequence(first, first + (theirs - 1) * step, step)
            names, bucket = _key_names(side, parts), f"__tw_{side}_bucket"
            rows = held.where("met").select(*names, *values[side], F.explode(buckets).alias(bucket))
            # Few rows make many pairs: adaptive execution would put small partitions together.
            dealt[side] = rows.repartition(tasks, *names, bucket)
            alone[side] = alone[side].union(held.where("NOT met").select(*sides[side].columns))
        same = zip([*_key_names("left", parts), "__tw_left_bucket"], [*_key_names("right", parts), "__tw_right_bucket"])
        matched = dealt["left"].join(dealt["right"], reduce(and_, [F.col(a) == F.col(b) for a, b in same]))
        pieces.append(matched.select(*values["left"], *values["right"]))
    pieces.append(alone["left"].select(*values["left"], *absent["right"]))
    pieces.append(alone["right"].select(*absent["left"], *values["right"]))
    return reduce(DataFrame.union, pieces, joined)


def _key_names(side: str, parts: int) -> list[str]:
    return [f"__tw_{side}_key{i}" for i in range(parts)]


def _keyed(df: DataFrame, keys: list[str], side: str) -> DataFrame:
    """The keys and then all columns, by names found on no other side."""
    found = df.select(*[F.col(k).alias(f"__tw_{i}") for i, k in enumerate(keys)], "*")
    return found.toDF(*_key_names(side, len(keys)), *[f"__tw_{side}{i}" for i in range(len(df.columns))])


def _same_keys(side: str, table: DataFrame, parts: int) -> Column:
    return reduce(and_, [F.col(name) == table[f"k{i}"] for i, name in enumerate(_key_names(side, parts))])


def _met(sides: dict[str, DataFrame], hot: DataFrame, hot_rows: int) -> DataFrame:
    """Per hot key: its parts on either side, and whether both sides have it."""
    known = hot.columns
    for side in _BOTH:
        names = _key_names(side, len(known))
        rows = sides[side].join(hot, _same_keys(side, hot, len(known)), "left_semi").groupBy(*names)
        counted = stage(rows.agg(F.count(F.lit(1)).alias(f"{side}_rows")), "hot")
        same = _same_keys(side, hot, len(known))
        hot = hot.join(broadcast_if_small(counted), same, "left").drop(*names)
    parts = {f"{side}_parts": _parts_of(F.coalesce(f"{side}_rows", F.lit(1)), hot_rows) for side in _BOTH}
    met = F.col("left_rows").isNotNull() & F.col("right_rows").isNotNull()
    return stage(hot.select(*known, met.alias("met"), *[one.alias(name) for name, one in parts.items()]), "hot")


def _parts_of(rows: Column, hot_rows: int) -> Column:
    return F.ceil(rows / F.lit(max(hot_rows, 1))).cast("int")


def _bucketed(
    df: DataFrame,
    keys: list[str],
    own_hot: DataFrame | None,
    other_hot: DataFrame | None,
    null_rows: int,
    hot_rows: int,
    side: str,
) -> DataFrame:
    """Add ``__tw_<side>_bucket`` and ``__tw_<side>_repeated``."""
    bucket, repeated = f"__tw_{side}_bucket", f"__tw_{side}_repeated"
    # Taken before any join: the place of the row in the table it is read from.
    df = df.withColumn("__tw_place", F.monotonically_increasing_id())
    for hot, name in ((own_hot, "__tw_own"), (other_hot, "__tw_other")):
        if hot is None:
            df = df.withColumn(name, F.lit(1))
            continue
        table = hot.select(
            *[F.col(f"k{i}").alias(f"__tw_{side}{name}{i}") for i in range(len(keys))],
            _parts_of(F.col("n"), hot_rows).alias(name),
        )
        names = table.columns[:-1]
        same = null_safe_match([df[k] for k in keys], [table[c] for c in names])
        df = df.join(broadcast_if_small(table), same, "left").drop(*names)
        df = df.withColumn(name, F.coalesce(name, F.lit(1)))
    # Consecutive places differ in the row, distant ones in the partition as well.
    place = F.xxhash64("__tw_place")
    own = F.pmod(place, F.col("__tw_own")).cast("int")
    repeats = F.sequence(F.lit(0), F.col("__tw_other") - 1)
    if side == "left":
        buckets = F.transform(repeats, lambda other: own * F.col("__tw_other") + other)
    else:
        buckets = F.transform(repeats, lambda other: other * F.col("__tw_own") + own)
    null_parts = F.pmod(place, _parts_of(F.lit(max(null_rows, 1)), hot_rows)).cast("int")
    buckets = F.when(_null_key(keys), F.array(null_parts)).otherwise(buckets)
    return (
        df.withColumn(repeated, ~_null_key(keys) & (F.col("__tw_other") > 1))
        .withColumn(bucket, F.explode(buckets))
        .drop("__tw_own", "__tw_other", "__tw_place")
    )
