"""Casts that yield NULL for values that do not fit, whatever the session's ANSI setting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_INTEGRAL_NAMES = {
    "tinyint", "byte", "smallint", "short", "int", "integer", "bigint", "long",
}
_DECIMAL_TEXT = r"^\s*[+-]?\d*\.\d*\s*$"


def tolerant_cast(
    column: Column, source: T.DataType, target: str, pattern: str | None = None
) -> Column:
    """Cast to the DDL type ``target``; ``pattern`` applies to text read as date or timestamp."""
    name = target.strip()
    kind = "timestamp" if name.lower() == "datetime" else name.lower()
    is_text = isinstance(source, T.StringType)
    if pattern and is_text and kind == "timestamp":
        return F.try_to_timestamp(column, F.lit(pattern))
    if pattern and is_text and kind == "date":
        return F.try_to_date(column, pattern)
    if is_text and kind in _INTEGRAL_NAMES:
        return _text_to_integral(column, kind)
    return column.try_cast("timestamp" if kind == "timestamp" else name)


def _text_to_integral(column: Column, kind: str) -> Column:
    """``'3.7'`` reads as 3: a decimal point truncates, an exponent does not parse."""
    truncated = column.try_cast("decimal(38,18)").try_cast(kind)
    return F.coalesce(
        column.try_cast(kind), F.when(column.rlike(_DECIMAL_TEXT), truncated)
    )
