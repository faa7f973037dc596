"""Query registration."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Tables:
    """The supplied Parquet tables of one scale factor, by name."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def __getitem__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``build(tables)`` as a query; ``sql`` is the same query for DuckDB."""

    def register(build: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = lambda spark, folder: build(Tables(spark, folder))
        if sql is not None:
            ORACLE[name] = sql
        return build

    return register


def plain_timestamps(df: DataFrame) -> DataFrame:
    """Timestamps without a zone, as the supplied tables and DuckDB have them."""
    zoned = [name for name, kind in df.dtypes if kind == "timestamp"]
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in zoned})


def rounded(df: DataFrame, digits: int, *names: str) -> DataFrame:
    return df.withColumns({name: F.round(name, digits) for name in names})
