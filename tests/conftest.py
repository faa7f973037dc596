import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tablewright-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """frame(rows, ddl): a small DataFrame."""
    return lambda rows, ddl: spark.createDataFrame(rows, ddl)


@pytest.fixture
def no_coalescing(spark):
    """Keep small shuffle partitions apart, so their sizes can be looked at."""
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    yield
    spark.conf.unset(key)


def rows(df):
    """All rows as sorted tuples, NULLs first."""
    def order(row):
        return [(value is not None, str(value)) for value in row]

    return sorted((tuple(r) for r in df.collect()), key=order)


def column(df, name):
    return [r[name] for r in df.select(name).collect()]


def plan(df):
    """The optimized and physical plans as text."""
    return df._jdf.queryExecution().toString()
