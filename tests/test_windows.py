import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

import tablewright as tw
from tablewright.arguments import sort_columns, sort_keys
from tablewright.operators import windows
from tablewright.staging import stage
from tests.conftest import column, plan, rows

SALES = [
    ("A", "2026-01-01", 100), ("A", "2026-01-02", 110), ("A", "2026-01-03", 120),
    ("A", "2026-01-03", 120), ("B", "2026-01-01", 200), ("B", "2026-01-02", 210),
    ("B", "2026-01-03", 215),
]


@pytest.fixture
def sales(frame):
    return frame(SALES, "user_id string, date string, amount long")


@pytest.mark.parametrize("hot_rows", [1_000_000, 2])
def test_lag_and_lead_of_the_sales_table(sales, hot_rows):
    before = tw.lag(sales, "amount", ["date"], ["user_id"], target_column="prev", hot_rows=hot_rows)
    assert rows(before.select("user_id", "amount", "prev")) == sorted(
        [("A", 100, None), ("A", 110, 100), ("A", 120, 110), ("A", 120, 120),
         ("B", 200, None), ("B", 210, 200), ("B", 215, 210)], key=lambda r: (r[0], str(r[1]), str(r[2] or "")))
    after = tw.lead(sales, "amount", [("date", False)], ["user_id"], target_column="next", hot_rows=hot_rows)
    assert rows(after.where("user_id = 'B'").select("amount", "next")) == [(200, None), (210, 200), (215, 210)]


def test_names_defaults_and_errors(sales):
    assert tw.lag(sales, "amount", "date", ["user_id"], 2).columns[-1] == "amount_lag_2"
    assert tw.lead(sales, "amount", "date").columns[-1] == "amount_lead_1"
    assert tw.ntile(sales, ["date"], ["user_id"]).columns[-1] == "ntile"
    for call in (tw.row_number, tw.rank, tw.dense_rank, tw.ntile):
        with pytest.raises(ValueError):
            call(sales, [])
    with pytest.raises(ValueError):
        tw.rank(sales, [("date", "desc")])


def _mixed(spark, seed):
    """Rows with NULL keys, ties, a key with a third of the rows and a third of exact copies."""
    pick = random.Random(seed)
    data = []
    for i in range(600):
        key = pick.choice(["hot", "hot", "a", "b", "c", None])
        data.append((key, pick.choice([None, 1, 2, 3, 4, 5]), float(pick.randint(0, 3)), i))
    data += [("hot", 2, 1.0, -1)] * 300
    return spark.createDataFrame(data, "k string, v int, x double, i long").repartition(7)


FUNCTIONS = {
    "row_number": (tw.row_number, F.row_number),
    "rank": (tw.rank, F.rank),
    "dense_rank": (tw.dense_rank, F.dense_rank),
    "ntile": (lambda *a, **k: tw.ntile(*a, num_buckets=11, **k), lambda: F.ntile(11)),
}


@pytest.mark.parametrize("name", FUNCTIONS)
@pytest.mark.parametrize("keys", [[], ["k"], ["k", "x"]])
def test_ranked_in_ranges_equals_plain_window(spark, no_coalescing, name, keys):
    ours, theirs = FUNCTIONS[name]
    df = _mixed(spark, len(name) + len(keys))
    order = [("v", False), ("x", True)]
    if name in ("row_number", "ntile"):
        order.append("i")  # ties in an order give no fixed row numbers
    window = Window.partitionBy(*keys).orderBy(*sort_columns(sort_keys(order)))
    expected = df.withColumn("r", theirs().over(window).cast("bigint"))
    got = ours(df, order, keys, target_column="r", hot_rows=40)
    assert got.columns == expected.columns and got.dtypes == expected.dtypes
    assert rows(got) == rows(expected)


@pytest.mark.parametrize("distance", [1, 3, 50, -2])
@pytest.mark.parametrize("keys", [[], ["k"]])
def test_shifted_in_ranges_equals_plain_window(spark, no_coalescing, distance, keys):
    df = _mixed(spark, 99).where("i >= 0")
    window = Window.partitionBy(*keys).orderBy("v", "i")
    expected = df.withColumn("s", F.lag("x", distance, -9.0).over(window))
    got = tw.lag(df, "x", ["v", "i"], keys, distance, -9.0, "s", hot_rows=40)
    assert rows(got) == rows(expected)
    expected = df.withColumn("s", F.lead("v", distance).over(window))
    assert rows(tw.lead(df, "v", ["v", "i"], keys, distance, target_column="s", hot_rows=40)) == rows(expected)


def test_hot_groups_are_found_by_rows_not_bytes(spark, monkeypatch, tmp_path):
    """Many equal keys make a tiny file."""
    path = str(tmp_path / "equal")
    spark.range(200_000).selectExpr("1 AS k", "id").write.parquet(path)
    monkeypatch.setattr("tablewright.sizing.HOT_GROUP_ROWS", 100_000)
    equal = spark.read.parquet(path)
    assert "__twin_" in plan(tw.row_number(equal, ["id"], ["k"]))
    assert "__twin_" not in plan(tw.row_number(equal.where("id < 1000"), ["id"], ["k"]))


@pytest.mark.parametrize("call", [tw.row_number, tw.rank, tw.dense_rank, tw.ntile])
def test_rows_that_differ_on_each_reading_are_kept_once(spark, call):
    df = spark.range(0, 20_000, 1, 8).selectExpr("id", "cast(rand() * 4 AS int) AS k")
    got = call(df, ["id"], ["k"], hot_rows=4_990)
    assert sorted(column(got, "id")) == list(range(20_000))


def test_all_rows_tied(spark, no_coalescing):
    df = spark.range(0, 4000, 1, 16).selectExpr("1 AS v")
    assert set(column(tw.rank(df, "v"), "rank")) == {1}
    assert set(column(tw.dense_rank(df, "v"), "dense_rank")) == {1}
    assert sorted(column(tw.row_number(df, "v"), "row_number")) == list(range(1, 4001))


def test_ranges_split_copies_evenly(spark, no_coalescing):
    df = spark.range(0, 32_000, 1, 16).selectExpr("if(id % 3 = 0, -1, id) AS v")
    for frame in (df, df.repartition(8, "v")):
        laid = windows._laid_out(frame, [], [("v", True)])
        sizes = column(laid.groupBy(windows._RANGE).count(), "count")
        assert sum(sizes) == 32_000 and max(sizes) < 32_000 / 4


def test_half_of_the_rows_copies_of_one(spark, no_coalescing):
    """All copies come from one partition of a shuffle, yet no range has over twice the mean."""
    df = spark.range(0, 100_000, 1, 16).selectExpr("if(id % 2 = 0, -1, id) AS k", "1 AS v").repartition(8, "k")
    assert max(df.rdd.glom().map(len).collect()) > 50_000
    laid = windows._laid_out(df, [], [("k", True)])
    sizes = column(laid.groupBy(windows._RANGE).count(), "count")
    assert sum(sizes) == 100_000 and max(sizes) <= 25_000
    parts = tw.sort_rows(df, "k").rdd.glom().map(len).collect()
    assert sum(parts) == 100_000 and max(parts) <= 25_000


def test_functions_share_a_layout(spark, no_coalescing):
    df = _mixed(spark, 5).where("i >= 0")
    for keys in ([], ["k"]):
        window = Window.partitionBy(*keys).orderBy("v", "i")
        expected = df.withColumns({
            "row_number": F.row_number().over(window).cast("bigint"), "x": F.lag("x", 2).over(window), "n": F.lead("i", 1, -7).over(window),
            "r": F.rank().over(window).cast("bigint"), "d": F.dense_rank().over(window).cast("bigint"), "t": F.ntile(7).over(window).cast("bigint"),
        })
        for hot_rows in (40, 100_000):
            layout = tw.WindowLayout(df, ["v", "i"], keys, hot_rows).row_number().lag("x", 2, target_column="x")
            got = layout.lead("i", 1, -7, "n").rank("r").dense_rank("d").ntile(7, "t").result()
            assert got.columns == expected.columns and got.dtypes == expected.dtypes
            assert rows(got) == rows(expected)
    text = plan(got.select("*"))
    assert "__twin_" not in text  # the last form is a plain window with one exchange
    assert text.split("== Physical")[1].count("hashpartitioning(k") == 1


def test_one_layout_is_sorted_and_written_once(spark, monkeypatch):
    df = spark.range(0, 4000, 1, 8).selectExpr("id % 7 AS v", "id")
    labels = []

    def counted(frame, label):
        labels.append(label)
        return stage(frame, label)

    monkeypatch.setattr(windows, "stage", counted)
    layout = tw.WindowLayout(df, ["v", "id"]).row_number().rank().lag("id")
    got = layout.result()
    assert labels == ["ranges", "edges"] and got.count() == 4000
    text = plan(got).split("== Physical")[1]
    # Two of the exchanges are of runs and segments, one is of the rows.
    assert "SortMergeJoin" not in text and text.count("hashpartitioning(") == 3


def test_target_may_replace_a_column(sales):
    got = tw.row_number(sales, ["date", "amount"], target_column="amount")
    assert got.columns == sales.columns and sorted(column(got, "amount")) == list(range(1, 8))


def test_empty_frame(sales):
    nothing = sales.where("amount < 0")
    for call in (tw.row_number, tw.rank, tw.dense_rank, tw.ntile):
        assert call(nothing, ["date"]).count() == 0
        assert call(nothing, ["date"], ["user_id"]).count() == 0


def test_whole_table_is_never_moved_to_one_partition(spark):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    for call in (tw.row_number, tw.rank, tw.dense_rank, tw.ntile):
        text = plan(call(events, ["value"])).split("== Physical")[1]
        for part in text.split("Exchange SinglePartition")[1:]:
            # Only the table of segments, already aggregated per range, goes to one task.
            assert "HashAggregate" in part.split("FileScan")[0] or "SortAggregate" in part.split("FileScan")[0]
