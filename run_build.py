"""Run one configured build: ``spark-submit run_build.py build.json --base-path s3a://bucket``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from tablewright import clear_staged, run_pipeline


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("config", help="path of a JSON file, or JSON text")
    parser.add_argument("--base-path", help="folder or bucket the prefixes are below")
    parser.add_argument("--run-id")
    parser.add_argument("--count-inputs", action="store_true")
    given = parser.parse_args(arguments)
    spark = SparkSession.builder.appName("tablewright").getOrCreate()
    result = run_pipeline(
        spark, given.config, given.base_path, given.run_id, count_inputs=given.count_inputs
    )
    clear_staged(spark)
    counts = dict(result.input_rows)
    print(f"wrote {result.output_rows} rows to {result.path}; input rows: {counts}")


if __name__ == "__main__":
    main()
