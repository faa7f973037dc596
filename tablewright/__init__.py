"""Layered analytics tables on Spark DataFrames."""

from tablewright.operators.aggregates import (
    aggregate_data,
    pivot_data,
    pivot_long,
    total_avg,
    total_max,
    total_min,
    total_sum,
)
from tablewright.operators.columns import (
    add_column,
    cast_column,
    cast_columns,
    col,
    convert_column,
    drop_columns,
    rename_column,
    rename_columns,
    select,
    standardize_column_names,
    type_of,
)
from tablewright.operators.dedup import drop_duplicates
from tablewright.operators.filters import (
    contains_substring_column,
    ends_with,
    ends_with_column,
    filter_rows,
    is_null_or_empty_column,
    starts_with,
    starts_with_column,
)
from tablewright.operators.joins import (
    broadcast_join_dataframes,
    cross_join_dataframes,
    join_dataframes,
    join_with_aliases,
    self_join,
)
from tablewright.operators.nulls import coalesce_column, drop_null, fill_null, ifnull_column
from tablewright.operators.ordering import sort_rows
from tablewright.operators.text import (
    concat_columns,
    lowercase,
    mask_column,
    regex_extract_column,
    remove_special_characters_column,
    rename_values,
    replace_substring,
    split_column,
    substring_column,
    trim,
    uppercase,
)
from tablewright.operators.windows import WindowLayout, dense_rank, lag, lead, ntile, rank, row_number
from tablewright.plans.run import run_pipeline, transform_frames
from tablewright.plans.steps import apply_transformation_steps
from tablewright.plans.warehouse import run_warehouse
from tablewright.sources.readers import list_files, read_dataset, read_parquet
from tablewright.sources.tables import create_gold_tables, sync_partitions
from tablewright.sources.writers import with_audit_columns, write_parquet
from tablewright.staging import clear_staged

# The short names of the one-row totals shadow builtins, so they exist only as attributes here.
sum, avg, min, max = total_sum, total_avg, total_min, total_max
