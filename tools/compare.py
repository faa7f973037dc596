"""Run queries in Spark and their SQL in DuckDB and compare the rows.

    python tools/compare.py [--sf 0.01] [name ...]
"""

from __future__ import annotations

import argparse
import collections
import datetime
import decimal
import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import suite  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def local_session(cpus: str = "8") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tablewright-suite")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def duckdb_views(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')"
        )
    return connection


def plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float) and value == 0:
        return 0.0
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def bag(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return collections.Counter(tuple(plain(row[i]) for i in order) for row in rows)


def check(spark, connection, name, folder) -> str | None:
    """None when Spark and DuckDB agree, otherwise what differs."""
    frame = suite.QUERIES[name](spark, folder)
    rows = frame.collect()
    if name not in suite.ORACLE:
        return None if rows else "no rows"
    result = connection.execute(suite.ORACLE[name])
    names = [column[0] for column in result.description]
    if sorted(names) != sorted(frame.columns):
        return f"columns {frame.columns} and {names}"
    ours, theirs = bag(frame.columns, rows), bag(names, result.fetchall())
    if ours != theirs:
        only_ours, only_theirs = ours - theirs, theirs - ours
        return (
            f"{sum(ours.values())} and {sum(theirs.values())} rows; "
            f"only Spark: {list(only_ours)[:3]}; only DuckDB: {list(only_theirs)[:3]}"
        )
    return None


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="0.01")
    parser.add_argument("names", nargs="*")
    arguments = parser.parse_args()
    folder = f"/root/testdata/sf{arguments.sf}"
    spark, connection = local_session(), duckdb_views(folder)
    failed = 0
    for name in arguments.names or suite.QUERIES:
        start = time.monotonic()
        try:
            problem = check(spark, connection, name, folder)
        except Exception as error:  # report and go on with the other queries
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{name:28s} {time.monotonic() - start:6.2f}s {problem or 'ok'}", flush=True)
    print(f"{failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
