"""Null handling."""

from __future__ import annotations

import re
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


_TRUTH_WORDS = {"t", "true", "y", "yes", "1", "f", "false", "n", "no", "0"}


def _readable_as(kind: T.DataType, text: str) -> bool:
    """Whether Spark can cast ``text`` to a number or boolean type without failing."""
    text = text.strip()
    if isinstance(kind, T.BooleanType):
        return text.lower() in _TRUTH_WORDS
    if isinstance(kind, T.IntegralType):
        return re.fullmatch(r"[+-]?\d+", text) is not None
    if isinstance(kind, T.NumericType):
        try:
            float(text)
        except ValueError:
            return False
    return True


def fill_null(df: DataFrame, column: str, value: Any) -> DataFrame:
    """Replace NULL, and NaN in floating columns, by a constant cast to the column's type."""
    kind = df.select(column).schema[0].dataType
    if isinstance(value, str) and not _readable_as(kind, value):
        raise ValueError(f"{value!r} can not fill column {column!r} of type {kind.simpleString()}")
    return df.fillna({column: value})


def drop_null(df: DataFrame, column: str) -> DataFrame:
    """Remove rows with NULL, or NaN in a floating column."""
    return df.dropna(subset=[column])


def coalesce_column(df: DataFrame, target_column: str, *source_columns: str) -> DataFrame:
    """First non-NULL value of the source columns."""
    if not source_columns:
        raise ValueError("coalesce_column needs at least one source column")
    return df.withColumn(target_column, F.coalesce(*source_columns))


def ifnull_column(
    df: DataFrame, target_column: str, column: str, default_value: Any
) -> DataFrame:
    """The source value, or the default where it is NULL."""
    return df.withColumn(target_column, F.ifnull(F.col(column), F.lit(default_value)))
