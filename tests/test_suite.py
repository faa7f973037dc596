"""Every registered query against DuckDB on the smallest tables, and its plan."""

import pytest

import __spark_entry__ as entry_points
import suite
from tests.conftest import plan
from tools.compare import check, duckdb_views

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return duckdb_views(FOLDER)


@pytest.mark.parametrize("name", list(suite.QUERIES))
def test_query_agrees_with_duckdb(spark, duck, name):
    assert check(spark, duck, name, FOLDER) is None


def test_entry_points(spark):
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
    assert "product_id" in entry_points.entry(spark).columns


@pytest.mark.parametrize("name", ["gold_product_performance", "silver_products", "str_mask"])
def test_plans_stay_in_the_jvm(spark, name):
    text = plan(suite.QUERIES[name](spark, FOLDER))
    assert "Python" not in text and "Pandas" not in text
