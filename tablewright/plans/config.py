"""Checking a build configuration before Spark does any work."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

from tablewright.plans.lookups import check_lookups
from tablewright.plans.sql import sql_text
from tablewright.plans.steps import step_function
from tablewright.sources.readers import normalize_read_format


@dataclass(frozen=True)
class Input:
    """One source. A DDL schema spares JSON, and CSV with inferSchema, a pass for inference."""

    path: str
    format: str = "parquet"
    options: Mapping[str, Any] = field(default_factory=dict)
    extensions: list[str] = field(default_factory=list)
    schema: str | None = None


@dataclass(frozen=True)
class Build:
    """A checked configuration. A single unnamed input has the key ``None``."""

    inputs: Mapping[str | None, Input]
    sql: str | None
    lookups: Mapping[str, Any] | None
    steps: list[Mapping[str, Any]]
    output: str
    partition_cols: list[str]
    mode: str
    unique_run: bool
    partition_overwrite: str


def load_config(source: str | Path | Mapping[str, Any]) -> dict[str, Any]:
    """A configuration from a mapping, JSON text, or the path of a JSON file."""
    if isinstance(source, Mapping):
        return dict(source)
    text = str(source)
    if not text.lstrip().startswith(("{", "[")):
        text = Path(source).read_text(encoding="utf-8")
    config = json.loads(text)
    if not isinstance(config, dict):
        raise ValueError("a configuration must be a JSON object")
    return config


def get_config_section(config: Mapping[str, Any], section: str) -> Mapping[str, Any]:
    """A section of the configuration; a missing or null one is empty."""
    value = config.get(section)
    if value is None:
        return {}
    if not isinstance(value, Mapping):
        raise ValueError(f"configuration section {section!r} must be an object")
    return value


def get_string_list(value: Any, name: str) -> list[str]:
    """A list from a list or from comma-separated text, blanks dropped."""
    if value is None:
        return []
    items = value.split(",") if isinstance(value, str) else value
    if not isinstance(items, list):
        raise ValueError(f"{name} must be a list or comma-separated text")
    return [text for item in items if (text := str(item).strip())]


def get_transform_steps(config: Mapping[str, Any]) -> list[Mapping[str, Any]]:
    """The checked step list; names must be known."""
    steps = get_config_section(config, "transformation").get("steps")
    if steps is None:
        return []
    if not isinstance(steps, list):
        raise ValueError("transformation.steps must be a list")
    for number, step in enumerate(steps):
        if not isinstance(step, Mapping):
            raise ValueError(f"step {number} must be an object")
        if not step.get("name"):
            raise ValueError(f"step {number} has no name")
        step_function(str(step["name"]))
    return steps


def _input(config: Mapping[str, Any], where: str) -> Input:
    path = str(config.get("input_prefix") or "").strip()
    if not path:
        raise ValueError(f"{where}.input_prefix is missing")
    options = config.get("options") or {}
    if not isinstance(options, Mapping):
        raise ValueError(f"{where}.options must be an object")
    extensions = get_string_list(config.get("file_extensions"), f"{where}.file_extensions")
    schema = config.get("schema")
    if schema is not None and not isinstance(schema, str):
        raise ValueError(f"{where}.schema must be DDL text")
    return Input(path, normalize_read_format(config.get("format")), options, extensions, schema)


def _inputs(extraction: Mapping[str, Any]) -> dict[str | None, Input]:
    listed = extraction.get("inputs")
    if listed is None:
        return {None: _input(extraction, "extraction")}
    if not isinstance(listed, list) or not listed:
        raise ValueError("extraction.inputs must be a non-empty list")
    named: dict[str | None, Input] = {}
    for number, entry in enumerate(listed):
        where = f"extraction.inputs[{number}]"
        if not isinstance(entry, Mapping):
            raise ValueError(f"{where} must be an object")
        alias = str(entry.get("alias") or "").strip()
        if not alias:
            raise ValueError(f"{where} has no alias")
        if alias in named:
            raise ValueError(f"duplicate input alias: {alias}")
        named[alias] = _input(entry, where)
    return named


def check_config(
    config: Mapping[str, Any], default_partition_cols: list[str] | None = None
) -> Build:
    """Turn a configuration into a ``Build`` or raise ValueError."""
    loading = get_config_section(config, "loading")
    inputs = _inputs(get_config_section(config, "extraction"))
    statement = sql_text(get_config_section(config, "transformation").get("sql")) or None
    if statement and not statement.strip():
        raise ValueError("transformation.sql is empty")
    lookups = check_lookups(get_config_section(config, "transformation").get("lookups"), inputs)
    if statement and lookups:
        raise ValueError("transformation has either sql or lookups")
    if not (statement or lookups) and None not in inputs:
        raise ValueError("several inputs need transformation.sql or transformation.lookups")
    if statement and None in inputs:
        raise ValueError("transformation.sql needs extraction.inputs")
    output = str(loading.get("output_prefix") or "").strip()
    if not output:
        raise ValueError("loading.output_prefix is missing")
    partitions = loading.get("partition_cols", default_partition_cols or ["etl_run_date"])
    return Build(
        inputs=inputs,
        sql=statement,
        lookups=lookups,
        steps=get_transform_steps(config),
        output=output,
        partition_cols=get_string_list(partitions, "loading.partition_cols"),
        mode=str(loading.get("mode") or "overwrite").strip(),
        unique_run=bool(loading.get("unique_run", True)),
        partition_overwrite=str(loading.get("partition_overwrite") or "static").strip(),
    )
