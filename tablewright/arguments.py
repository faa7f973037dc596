"""Argument shapes shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

SortKey = str | tuple[str, bool] | list


def as_list(value) -> list:
    """None -> [], a single string -> [string], anything else -> list."""
    if value is None:
        return []
    return [value] if isinstance(value, str) else list(value)


def sort_keys(order_by: SortKey | Sequence[SortKey]) -> list[tuple[str, bool]]:
    """Normalize ``"c"``, ``("c", False)`` or ``["c", False]`` items to (name, ascending)."""
    keys = []
    for item in as_list(order_by):
        if isinstance(item, str):
            keys.append((item, True))
        elif (
            isinstance(item, (tuple, list))
            and len(item) == 2
            and isinstance(item[0], str)
            and isinstance(item[1], bool)
        ):
            keys.append((item[0], item[1]))
        else:
            raise ValueError(f"order_by takes names or (name, ascending) pairs, not {item!r}")
    if not keys:
        raise ValueError("order_by needs at least one column")
    return keys


def sort_columns(keys: Sequence[tuple[str, bool]]) -> list[Column]:
    return [F.col(name).asc() if ascending else F.col(name).desc() for name, ascending in keys]
