"""String operators. Those over several columns make one projection."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.arguments import as_list
from tablewright.functions import text as text_functions
from tablewright.sizing import broadcast_if_small

# Mappings up to this many entries become a literal; bigger ones become a joined table.
LITERAL_MAP_ENTRIES = 500


def _replace_each(
    df: DataFrame, columns: str | Sequence[str], change: Callable[[Column], Column]
) -> DataFrame:
    return df.withColumns({name: change(F.col(name)) for name in as_list(columns)})


def trim(df: DataFrame, columns: str | Sequence[str]) -> DataFrame:
    """Remove spaces at both ends."""
    return _replace_each(df, columns, F.trim)


def lowercase(df: DataFrame, columns: str | Sequence[str]) -> DataFrame:
    """Lower case."""
    return _replace_each(df, columns, F.lower)


def uppercase(df: DataFrame, columns: str | Sequence[str]) -> DataFrame:
    """Upper case."""
    return _replace_each(df, columns, F.upper)


def rename_values(df: DataFrame, column: str, rename_map: Mapping) -> DataFrame:
    """Replace values found in ``rename_map``; all others, NULL included, stay."""
    if len(rename_map) <= LITERAL_MAP_ENTRIES:
        return df.withColumn(column, text_functions.looked_up(F.col(column), rename_map))
    # Keys are compared in the type, and the result has the type, that the literal form gives; both
    # are found on one entry of each kind.
    some = dict({(_kind(k), _kind(v)): (k, v) for k, v in rename_map.items()}.values())
    compared = F.array(F.col(column), *[F.lit(key) for key in some])
    literal = text_functions.looked_up(F.col(column), some)
    key_type, result_type = (df.select(c).schema[0].dataType for c in (compared[0], literal))
    numeric = isinstance(key_type, T.NumericType)
    given = T.StringType() if numeric else key_type
    entries = df.sparkSession.createDataFrame(
        [(str(k) if numeric else k, None if v is None else str(v)) for k, v in rename_map.items()],
        T.StructType([T.StructField("__key", given), T.StructField("__value", T.StringType())]),
    ).withColumns({"__key": F.col("__key").cast(key_type), "__mapped": F.lit(True)})
    joined = df.join(_bounded_map(entries, rename_map), df[column] == F.col("__key"), "left")
    value = F.when(F.col("__mapped"), F.col("__value").cast(result_type))
    return joined.withColumn(column, value.otherwise(F.col(column).cast(result_type))).drop("__key", "__value", "__mapped")


def _kind(value) -> tuple:
    """What the SQL type of a value as a literal depends on."""
    if isinstance(value, Decimal):
        digits = value.as_tuple()
        return Decimal, len(digits.digits), digits.exponent
    if isinstance(value, int) and not isinstance(value, bool):
        return int, -(1 << 31) <= value < 1 << 31, -(1 << 63) <= value < 1 << 63
    return (type(value),)


def _bounded_map(entries: DataFrame, rename_map: Mapping) -> DataFrame:
    """Broadcast a mapping whose text, counted here, is within the broadcast bound."""
    from tablewright.sizing import BROADCAST_BYTES

    size = sum(4 * (len(str(k)) + len(str(v))) + 32 for k, v in rename_map.items())
    return F.broadcast(entries) if size <= BROADCAST_BYTES else entries


def replace_substring(df: DataFrame, column: str, pattern: str, replacement: str) -> DataFrame:
    """Replace every match of a regular expression in place."""
    return df.withColumn(column, F.regexp_replace(column, pattern, replacement))


def regex_extract_column(
    df: DataFrame, source_column: str, target_column: str, pattern: str
) -> DataFrame:
    """First capture group; ``''`` where nothing matches."""
    return df.withColumn(target_column, F.regexp_extract(source_column, pattern, 1))


def substring_column(
    df: DataFrame, source_column: str, target_column: str, start: int, length: int
) -> DataFrame:
    """``length`` characters from 1-based ``start``; a negative start counts from the end."""
    return df.withColumn(target_column, F.substring(source_column, start, length))


def split_column(
    df: DataFrame,
    source_column: str,
    target_columns: str | Sequence[str],
    separator: str = " ",
    literal: bool = False,
) -> DataFrame:
    """One column per part; a missing part is NULL. ``literal`` quotes the separator."""
    source = F.col(source_column)
    return df.withColumns(
        {
            target: text_functions.split_part_at(source, separator, i, literal)
            for i, target in enumerate(as_list(target_columns))
        }
    )


def concat_columns(
    df: DataFrame,
    source_columns: str | Sequence[str],
    target_column: str,
    separator: str = " ",
) -> DataFrame:
    """Columns joined by a separator; NULLs are skipped."""
    return df.withColumn(target_column, F.concat_ws(separator, *as_list(source_columns)))


def mask_column(
    df: DataFrame,
    source_column: str,
    target_column: str,
    mask_char: str = "*",
    unmasked_length: int = 4,
) -> DataFrame:
    """Hide all but the last ``unmasked_length`` characters."""
    hidden = text_functions.masked(F.col(source_column), mask_char, unmasked_length)
    return df.withColumn(target_column, hidden)


def remove_special_characters_column(
    df: DataFrame, source_column: str, target_column: str
) -> DataFrame:
    """Keep ASCII letters and digits only."""
    kept = F.regexp_replace(source_column, text_functions.KEEP_ALPHANUMERIC, "")
    return df.withColumn(target_column, kept)
