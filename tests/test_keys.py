import pytest
from pyspark.sql import functions as F

import tablewright as tw
from tablewright import sizing
from tablewright.keys import is_scan, is_unique
from tablewright.operators import joins
from tablewright.plans.lookups import joined_lookups
from tests.conftest import rows


@pytest.fixture
def events(spark):
    return spark.range(0, 3000, 1, 8).selectExpr("id", "id % 10 AS k", "if(id % 3 = 0, NULL, id % 7) AS j", "id * 2.5 AS x")


@pytest.fixture
def jobs(spark):
    """jobs(call): the number of jobs that the call starts."""

    def count(call):
        spark.sparkContext.setJobGroup("counted", "")
        before = len(spark.sparkContext.statusTracker().getJobIdsForGroup("counted"))
        result = call()
        after = len(spark.sparkContext.statusTracker().getJobIdsForGroup("counted"))
        return after - before, result

    return count


def test_unique_keys_are_read_off_the_plan(events):
    sums = events.groupBy("k").agg(F.sum("x").alias("total"))
    assert is_unique(sums, ["k"]) and is_unique(sums, ["k", "total"]) and not is_unique(sums, ["total"])
    renamed = sums.where("total > 1").select(F.col("k").alias("key"), "total")
    assert is_unique(renamed, ["key"])
    assert is_unique(events.dropDuplicates(["k", "j"]), ["j", "k"]) and not is_unique(events.dropDuplicates(["k", "j"]), ["k"])
    assert is_unique(events.select("k").distinct(), ["k"])
    assert not is_unique(events, ["id"]) and not is_unique(sums.union(sums), ["k"]) and not is_unique(sums, [])
    assert not is_unique(sums.join(events.select("k"), "k"), ["k"])
    assert not is_unique(sums.select((F.col("k") % 2).alias("k")), ["k"])


def test_first_rows_of_an_order_are_unique(events):
    first = tw.drop_duplicates(events, ["k"], [("id", False)])
    assert is_unique(first, ["k"]) and is_unique(first, ["k", "x"]) and not is_unique(first, ["id"])
    assert is_unique(first.where("x > 3").select(F.col("k").alias("a"), "id").withColumn("y", F.lit(1)), ["a"])
    assert not is_unique(first.select((F.col("k") % 2).alias("k")), ["k"])
    numbered = tw.row_number(events, ["id"], ["k"])
    assert not is_unique(numbered.where("row_number = 2 OR row_number = 1"), ["k"]) and not is_unique(numbered, ["k"])
    assert not is_unique(first.crossJoin(events.limit(2).select(F.col("j").alias("z"))), ["k"])


def test_scans(spark, events, tmp_path):
    events.write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    assert is_scan(table) and is_scan(events.where("x > 1").select("k")) and is_scan(table.union(table))
    assert not is_scan(table.groupBy("k").count()) and not is_scan(table.repartition(3)) and not is_scan(table.join(table, "k"))


def test_joins_with_unique_keys_start_no_job(events, jobs):
    aggregate = {"total": "sum(x)", "rows_seen": "count(*)"}
    description = {
        "fact": "facts", "columns": ["id", "total", "rows_seen", "last"],
        "joins": [
            {"table": "events", "key": "k", "aggregate": aggregate, "defaults": {"rows_seen": 0}},
            {"table": "latest", "key": "k", "columns": {"id": "last"}},
        ],
    }
    latest = tw.drop_duplicates(events, ["k"], [("id", False)])
    frames = {"facts": events.select("id", "k"), "events": events, "latest": latest}
    started, joined = jobs(lambda: joined_lookups(frames, description))
    assert started == 0 and joined.count() == 3000
    assert rows(joined.limit(1)) and joined.where("rows_seen <> 300 OR last <= 2989 OR total IS NULL").count() == 0
    started, _ = jobs(lambda: tw.join_dataframes(events, events.select("k").distinct(), "k", join_type="full"))
    assert 0 < started <= 2  # one aggregation over the left side alone
    declared = {**description, "joins": [{"table": "users", "key": "k", "columns": {"x": "total"}, "unique": True}]}
    declared["columns"] = ["id", "total"]
    started, _ = jobs(lambda: joined_lookups({"facts": frames["facts"], "users": events.limit(5)}, declared))
    assert started == 0


def test_summary_of_keys(events, jobs):
    started, summary = jobs(lambda: sizing.key_summary(events, ["k", "j"]))
    assert 0 < started <= 2 and (summary.rows, summary.null_rows) == (3000, 1000)
    exact = {r["h"]: r["n"] for r in events.groupBy(F.xxhash64("k", "j").alias("h")).agg(F.count("*").alias("n")).collect()}
    for code, count in summary.frequent:
        assert count >= exact[code]
    hot = sizing.hot_groups(events, ["j"], 500)
    assert rows(hot) == [(None, 1000)]
    assert sizing.hot_groups(events, ["j"], 1000) is None and not sizing.has_hot_group(events, ["j"], 1000)
    assert sizing.hot_groups(events.limit(0), ["j"], 1) is None


def test_frequent_keys_among_very_many(spark):
    """More distinct keys than a sketch follows; the hot ones are counted exactly."""
    df = spark.range(0, 400_000, 1, 8).selectExpr("if(id % 50 = 0, -1, if(id % 90 = 1, -2, id)) AS k", "cast(id AS string) AS j")
    hot = sizing.hot_groups(df, ["k"], 1000)
    expected = df.groupBy("k").count().where("count > 1000")
    assert rows(hot) == rows(expected) and hot.count() == 2


def test_the_size_of_hot_groups_is_known(spark):
    """So that they are broadcast, and no rows are shuffled by group to meet them."""
    df = spark.range(0, 9000, 1, 8).selectExpr("if(id % 3 = 0, NULL, id % 2) AS k")
    hot = sizing.hot_groups(df, ["k"], 500)
    assert rows(hot) == [(None, 3000), (0, 3000), (1, 3000)]
    assert sizing.estimated_bytes(hot) < sizing.BROADCAST_BYTES
    assert sizing.broadcast_if_small(hot) is not hot


def test_a_side_that_is_no_scan_is_computed_once(events, monkeypatch):
    staged = []

    def counted(df, label):
        staged.append(label)
        return stage(df, label)

    stage = joins.stage
    monkeypatch.setattr(joins, "stage", counted)
    other = events.groupBy("id", "k").agg(F.max("x").alias("most")).where("k < 9")
    joined = tw.join_dataframes(events.select("id", "j"), other, "j", "k", "left", hot_rows=100_000)
    assert staged == ["side"]
    plain = events.select("id", "j").join(other, F.col("j") == F.col("k"), "left")
    assert rows(joined.groupBy("j", "k").count()) == rows(plain.groupBy("j", "k").count())
    staged.clear()
    spread = tw.join_dataframes(events.select("id", "j"), other, "j", "k", "left", hot_rows=100)
    assert staged == ["side"]
    assert rows(spread.groupBy("j", "k").count()) == rows(plain.groupBy("j", "k").count())
    staged.clear()
    tw.join_dataframes(events, events, "k", join_type="inner")
    assert staged == []
