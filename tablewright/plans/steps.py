"""Named steps: every one-input operator, callable from configuration."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame

from tablewright.operators import (
    aggregates,
    columns,
    dedup,
    filters,
    nulls,
    ordering,
    text,
    windows,
)
from tablewright.sources.writers import with_audit_columns

_BY_MODULE = {
    columns: [
        "select", "drop_columns", "add_column", "rename_column", "rename_columns",
        "standardize_column_names", "convert_column", "cast_column", "cast_columns",
    ],
    filters: [
        "filter_rows", "starts_with", "ends_with", "contains_substring_column",
        "starts_with_column", "ends_with_column", "is_null_or_empty_column",
    ],
    nulls: ["fill_null", "drop_null", "ifnull_column"],
    text: [
        "trim", "lowercase", "uppercase", "rename_values", "replace_substring",
        "regex_extract_column", "substring_column", "split_column", "concat_columns",
        "mask_column", "remove_special_characters_column",
    ],
    aggregates: [
        "aggregate_data", "pivot_data", "pivot_long", "total_sum", "total_avg", "total_min", "total_max",
    ],
    windows: ["lag", "lead", "row_number", "rank", "dense_rank", "ntile"],
    dedup: ["drop_duplicates"],
    ordering: ["sort_rows"],
}


def _coalesce_step(df: DataFrame, target_column: str, source_columns: Sequence[str]) -> DataFrame:
    """coalesce_column with the sources as one list, as JSON has no variable arguments."""
    return nulls.coalesce_column(df, target_column, *source_columns)


STEPS = {
    name: getattr(module, name) for module, names in _BY_MODULE.items() for name in names
} | {"coalesce_column": _coalesce_step}


def step_function(name: str):
    """The operator behind a step name."""
    try:
        return STEPS[name.strip()]
    except KeyError:
        known = ", ".join(sorted(STEPS))
        raise ValueError(f"unsupported step {name!r}; available: {known}") from None


def apply_steps(df: DataFrame, steps: Sequence[Mapping[str, Any]]) -> DataFrame:
    """Apply ``{"name": ..., **parameters}`` steps in order."""
    for step in steps:
        parameters = {key: value for key, value in step.items() if key != "name"}
        df = df.transform(step_function(str(step["name"])), **parameters)
    return df


def apply_transformation_steps(
    df: DataFrame, steps: Sequence[Mapping[str, Any]], run_id: str | None = None
) -> DataFrame:
    """Steps, then the audit columns."""
    return with_audit_columns(apply_steps(df, steps), run_id)
