"""Running one configured build: read, transform, write."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tablewright.plans.config import Build, Input, check_config, load_config
from tablewright.plans.lookups import joined_lookups
from tablewright.plans.sql import run_sql
from tablewright.plans.steps import apply_steps
from tablewright.sources.readers import read_dataset, with_source_path
from tablewright.sources.writers import safe_run_id, with_audit_columns, write_parquet


@dataclass(frozen=True)
class RunResult:
    """Where the rows went, and the row counts observed while they were written.

    Counts are None under mode ``ignore``, which may skip the write.
    """

    path: str
    output_rows: int | None
    input_rows: Mapping[str | None, int | None] = field(default_factory=dict)


def located(base_path: str | None, path: str) -> str:
    """``path`` below ``base_path``, or as it is when it is absolute or a URI."""
    if "://" in path or path.startswith(("/", "file:")) or not base_path:
        return path.rstrip("/")
    return f"{base_path.rstrip('/')}/{path}".rstrip("/")


def extract(spark: SparkSession, source: Input, base_path: str | None = None) -> DataFrame:
    """Read one input and mark every row with the input path."""
    path = located(base_path, source.path)
    frame = read_dataset(
        spark, path, source.format, source.options, source.extensions, source.schema
    )
    return with_source_path(frame, path)


def transform(
    spark: SparkSession, build: Build, frames: Mapping[str | None, DataFrame]
) -> DataFrame:
    """The SQL statement or the lookups, if there are any, and then the steps."""
    if build.sql:
        base = run_sql(spark, frames, build.sql)
    elif build.lookups:
        base = joined_lookups(frames, build.lookups)
    else:
        base = frames[None]
    return apply_steps(base, build.steps)


def transform_frames(
    spark: SparkSession,
    config: str | Path | Mapping[str, Any],
    frames: Mapping[str | None, DataFrame],
) -> DataFrame:
    """The transformation of a configuration over frames at hand, without reading or writing."""
    return transform(spark, check_config(load_config(config)), frames)


def run_pipeline(
    spark: SparkSession,
    config: str | Path | Mapping[str, Any],
    base_path: str | None = None,
    run_id: str | None = None,
    default_partition_cols: list[str] | None = None,
    count_inputs: bool = False,
) -> RunResult:
    """Build one table from its configuration.

    Rows are counted by the write job itself. ``count_inputs`` counts the input rows the same
    way; it is optional because a count ahead of a filter keeps the filter out of the scan.
    """
    build = check_config(load_config(config), default_partition_cols)
    run_id = safe_run_id(run_id)
    target = located(base_path, build.output)
    if build.mode == "overwrite" and not build.unique_run:
        for source in build.inputs.values():
            if _overlap(located(base_path, source.path), target):
                raise ValueError(f"a build can not overwrite its own input: {target}")

    frames = {alias: extract(spark, source, base_path) for alias, source in build.inputs.items()}
    counters: dict[str | None, Observation] = {}
    if count_inputs:
        for alias, frame in frames.items():
            frames[alias], counters[alias] = _counted(frame)
    result, written = _counted(with_audit_columns(transform(spark, build, frames), run_id))
    # A shuffle ahead of the write would undo a sort asked for as the last step.
    sorted_last = bool(build.steps) and str(build.steps[-1]["name"]).strip() == "sort_rows"
    path = write_parquet(
        result,
        target,
        mode=build.mode,
        unique_run=build.unique_run,
        run_id=run_id,
        partition_cols=build.partition_cols,
        partition_overwrite=build.partition_overwrite,
        rebalance=not sorted_last,
    )
    if build.mode == "ignore":
        return RunResult(path, None, dict.fromkeys(counters))
    return RunResult(
        path,
        written.get.get("rows"),
        {alias: counter.get.get("rows") for alias, counter in counters.items()},
    )


def _overlap(one: str, other: str) -> bool:
    """Whether one path is, or lies below, the other."""
    a, b = (path.rstrip("/") + "/" for path in (one, other))
    return a.startswith(b) or b.startswith(a)


def _counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    observation = Observation()
    return df.observe(observation, F.count(F.lit(1)).alias("rows")), observation
