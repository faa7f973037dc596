"""String expressions."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the characters a cleaned string may keep.
KEEP_ALPHANUMERIC = "[^a-zA-Z0-9]"


def masked(text: Column, mask: str, visible: int) -> Column:
    """All but the last ``visible`` characters replaced; short text is left as it is."""
    text = text.cast("string")
    hidden = F.greatest(F.length(text) - visible, F.lit(0))
    return F.concat(F.repeat(F.lit(mask), hidden), F.right(text, F.lit(visible)))


def split_part_at(text: Column, separator: str, index: int, literal: bool) -> Column:
    """The part at 0-based ``index`` or NULL; the separator is a regular expression."""
    return F.get(F.split(text, re.escape(separator) if literal else separator), index)


def looked_up(column: Column, mapping: Mapping) -> Column:
    """Mapped value where the mapping has the key, otherwise the value itself."""
    if not mapping:
        return column
    table = F.create_map(*[F.lit(part) for entry in mapping.items() for part in entry])
    return F.when(F.map_contains_key(table, column), table[column]).otherwise(column)


def blank(column: Column) -> Column:
    """True for NULL and for the empty string, never NULL itself."""
    return F.coalesce(column.cast("string") == "", F.lit(True))
