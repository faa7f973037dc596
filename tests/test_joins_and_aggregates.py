import pytest
from pyspark.sql import functions as F

import tablewright as tw
from tablewright import sizing
from tests.conftest import column, plan, rows

TYPES = ["inner", "left", "right", "full", "left_semi", "left_anti"]


@pytest.fixture
def sides(frame):
    left = frame([(1, "a"), (1, "b"), (2, "c"), (None, "n"), (4, "d")], "k int, l string")
    right = frame([(1, "x"), (1, "y"), (3, "z"), (None, "m"), (4, "w")], "k int, r string")
    return left, right


def test_null_keys_never_match(sides):
    left, right = sides
    assert tw.join_dataframes(left, right, ["k"]).count() == 5
    assert tw.join_dataframes(left, right, ["k"], join_type="full").count() == 5 + 2 + 2
    assert column(tw.join_dataframes(left, right, "k", join_type="left_anti"), "l") == ["c", "n"]


def test_key_names_and_counts(sides):
    left, right = sides
    renamed = right.withColumnRenamed("k", "j")
    assert tw.join_dataframes(left, renamed, ["k"], ["j"]).columns == ["k", "l", "j", "r"]
    with pytest.raises(ValueError):
        tw.join_dataframes(left, renamed, ["k", "l"], ["j"])
    with pytest.raises(ValueError):
        tw.join_dataframes(left, renamed, [])
    named = tw.join_dataframes(left, right, "k", suffixes=("", "_right"))
    assert named.columns == ["k", "l", "k_right", "r"]


def test_two_keys(frame):
    left = frame([(1, "a", 1), (1, "b", 2), (1, None, 3)], "k int, t string, n int")
    right = frame([(1, "a", 7), (1, None, 8)], "k int, t string, m int")
    assert column(tw.join_dataframes(left, right, ["k", "t"]), "m") == [7]


def test_aliases_and_self_join(frame):
    df = frame([(1, 0), (2, 1), (3, 1)], "id int, boss int")
    pairs = tw.join_with_aliases(df, df, "worker", "chief", ["boss"], ["id"])
    assert rows(pairs.select("worker.id", "chief.id")) == [(2, 1), (3, 1)]
    assert tw.self_join(df, ["id"]).where("left.boss = right.boss").count() == 3
    assert tw.cross_join_dataframes(df, df.select(F.col("id").alias("other"))).count() == 9


@pytest.mark.parametrize(
    "how, hot",
    [(how, hot) for how in TYPES for hot in ("left", "right", "both")] + [("full", "neither")],
)
def test_spread_join_equals_plain_join(spark, how, hot):
    """Key 1 or NULL may hold a large share of either side."""
    def side(name, heavy, parts):
        many = 60 if heavy else 2
        data = [(1, 10, f"{name}{i}") for i in range(many)]
        data += [(None, 10, f"{name}n{i}") for i in range(many)]
        data += [(i % 7 + 2, i % 3, f"{name}k{i}") for i in range(12)]
        data += [(50 if name == "l" else 60, 1, f"{name}only{i}") for i in range(many)]
        return spark.createDataFrame(data, f"k int, j int, {name} string").repartition(parts)

    left = side("l", hot in ("left", "both"), 6)
    right = side("r", hot in ("right", "both"), 5)
    plain = tw.join_dataframes(left, right, ["k", "j"], join_type=how)
    spread = tw.join_dataframes(left, right, ["k", "j"], join_type=how, hot_rows=8, hot_sides=("left", "right"))
    assert spread.columns == plain.columns
    assert rows(spread) == rows(plain)


@pytest.mark.parametrize("how", ["inner", "left", "full", "left_semi"])
def test_spread_join_of_a_table_with_itself(spark, how):
    """Every worker of the hot boss 1 meets that boss; the boss's own row is repeated."""
    data = [(i, 1 if i % 3 else i % 5) for i in range(1, 60)] + [(100, None)]
    df = spark.createDataFrame(data, "id int, boss int").repartition(5)
    arguments = (df, df, "worker", "chief", ["boss"], ["id"], how)
    plain = tw.join_with_aliases(*arguments)
    spread = tw.join_with_aliases(*arguments, hot_rows=5, hot_sides=("left", "right"))
    assert how == "left_semi" or "__tw_left_bucket" in plan(spread)
    assert rows(spread) == rows(plain)
    assert rows(spread.select("worker.id")) == rows(plain.select("worker.id"))


def test_spread_join_splits_the_hot_key(spark, no_coalescing):
    left = spark.range(0, 20_000, 1, 16).selectExpr("if(id % 3 = 0, 7, id) AS k", "id")
    right = spark.range(0, 100).selectExpr("id AS j")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = tw.join_dataframes(left, right, "k", "j", "left", hot_rows=500, hot_sides=["left"])
        per_task = joined.where("k = 7").groupBy(F.spark_partition_id()).count()
        assert max(column(per_task, "count")) < 6667 / 2
        assert joined.count() == 20_000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_sides_aqe_can_not_split_are_checked(spark, monkeypatch):
    """A left join with a hot key on its right side, found and spread by default."""
    left = spark.createDataFrame([(7, "a"), (8, "b"), (9, "c")], "k int, l string")
    right = spark.range(0, 9000, 1, 8).selectExpr("cast(if(id % 3 = 0, 7, id) AS int) AS j", "id")
    joined = tw.join_dataframes(left, right, "k", "j", "left", hot_rows=1000)
    assert "__tw_right_bucket" in plan(joined)
    expected = left.join(right, left.k == right.j, "left")
    assert rows(joined) == rows(expected)
    inner = tw.join_dataframes(left, right, "k", "j", "inner", hot_rows=1000)
    unchecked = tw.join_dataframes(left, right, "k", "j", "left", hot_sides=())
    assert "__tw_right_bucket" not in plan(inner) + plan(unchecked)


@pytest.fixture
def shuffled(spark):
    """Plain shuffle joins whose big partitions adaptive execution splits."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key in settings:
        spark.conf.unset(key)


def largest(df):
    return max(column(df.groupBy(F.spark_partition_id()).count(), "count"))


@pytest.mark.parametrize("how", ["left_semi", "left_anti"])
def test_semi_and_anti_joins_leave_the_left_side_to_aqe(spark, shuffled, how):
    left = spark.range(0, 6000, 1, 8).selectExpr("CASE id % 3 WHEN 0 THEN 7 WHEN 1 THEN id END AS k", "id")
    keys = spark.range(0, 6000, 1, 8).selectExpr("CASE WHEN id % 3 = 0 THEN 5 WHEN id % 7 > 0 THEN id END AS j")
    expected = rows(left.join(keys, left.k == keys.j, how))
    for hot_rows in (10_000, 1000):  # at 1000 the key 5 is hot, and distinct keys are written first
        joined = tw.join_dataframes(left, keys, "k", "j", how, hot_rows=hot_rows)
        physical = plan(joined).split("== Physical")[1]
        # An aggregate between shuffle and join would keep adaptive execution from splitting.
        assert "Aggregate" not in physical and physical.count("Exchange hashpartitioning") == 2
        assert rows(joined) == expected


def test_null_keys_of_a_full_join_are_split(spark, shuffled, no_coalescing):
    left = spark.range(0, 20_000, 1, 8).selectExpr("if(id % 10 = 0, id, NULL) AS k", "id AS l")
    right = spark.range(0, 100).selectExpr("id AS j", "id AS r").union(spark.sql("SELECT NULL, -1"))
    joined = tw.join_dataframes(left, right, "k", "j", "full", hot_rows=1000)
    assert largest(joined.where("k IS NULL AND l IS NOT NULL")) < 6_000
    assert rows(joined) == rows(left.join(right, left.k == right.j, "full"))


def test_a_key_hot_on_both_sides_is_split_on_both(spark, shuffled, no_coalescing):
    left = spark.range(0, 3000, 1, 4).selectExpr("if(id % 2 = 0, 7, id) AS k", "id AS l")
    right = spark.range(0, 900, 1, 4).selectExpr("if(id % 3 = 0, 7, -id) AS j", "id AS r")
    for how in ("inner", "left", "right", "full"):
        joined = tw.join_dataframes(left, right, "k", "j", how, hot_rows=100, hot_sides=["left", "right"])
        assert joined.where("k = 7 AND j = 7").count() == 1501 * 300
        assert largest(joined.where("k = 7")) < 1501 * 300 / 2
        assert rows(joined) == rows(left.join(right, left.k == right.j, how))


@pytest.mark.parametrize("sides", [("left", "right"), ("left",), ("right",)])
def test_pairs_of_hot_keys_of_a_full_join_are_made_by_an_inner_join(spark, shuffled, no_coalescing, sides):
    """Hot keys with and without partners, NULL keys on both sides, keys on one side only."""
    left = spark.range(0, 3000, 1, 4).selectExpr(
        "CASE id % 5 WHEN 0 THEN 7 WHEN 1 THEN 8 WHEN 2 THEN NULL ELSE id END AS k", "id AS v"
    )
    right = spark.range(0, 900, 1, 4).selectExpr(
        "CASE id % 4 WHEN 0 THEN 7 WHEN 1 THEN -8 WHEN 2 THEN NULL ELSE id END AS k", "id AS v"
    )
    expected = left.alias("l").join(right.alias("r"), F.expr("l.k = r.k"), "full")
    joined = tw.join_with_aliases(left, right, "l", "r", "k", join_type="full", hot_rows=100, hot_sides=sides)
    assert joined.columns == ["k", "v", "k", "v"] and joined.schema == expected.schema
    assert joined.select("l.v", "r.k").count() == expected.count()
    assert rows(joined) == rows(expected)
    merges = [line for line in plan(joined).split("== Physical")[1].splitlines() if "SortMergeJoin" in line]
    assert {line.rsplit(" ", 1)[1] for line in merges if "bucket" in line} == {"Inner"}
    made = joined.where("l.k = 7 AND r.k = 7")
    assert made.count() == 600 * 226 and largest(made) < 600 * 226 / 2


def test_spreading_does_not_need_several_input_partitions(spark, shuffled, no_coalescing):
    left = spark.range(0, 20_000, 1, 16).selectExpr("if(id % 3 = 0, 7, id) AS k", "id").repartition(8, "k")
    right = spark.range(0, 100).selectExpr("id AS j")
    joined = tw.join_dataframes(left, right, "k", "j", "left", hot_rows=500, hot_sides=["left"])
    assert largest(joined.where("k = 7")) < 6667 / 2 and joined.count() == 20_000


def test_broadcast_only_within_the_bound(spark):
    lines = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet")
    parts = spark.read.parquet("/root/testdata/sf0.01/part.parquet")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        def joined(how, **bound):
            return plan(
                tw.broadcast_join_dataframes(lines, parts, "l_partkey", "p_partkey", how, **bound)
            )

        assert "BroadcastHashJoin" in joined("left")
        assert "BroadcastHashJoin" not in joined("left", max_bytes=10_000)
        assert "BroadcastHashJoin" not in joined("full")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_compressed_files_are_measured(spark, tmp_path):
    """A file of 50 KB or so holds 20 MB of text."""
    path = str(tmp_path / "dense")
    spark.range(200).selectExpr("id", "repeat('x', 100000) AS t").coalesce(1).write.parquet(path)
    dense = spark.read.parquet(path)
    assert sizing.estimated_bytes(dense) < 2_000_000 < 20_000_000 < sizing.measured_bytes(dense)
    assert sizing.broadcast_if_small(dense, 2_000_000) is dense


def test_measured_bytes_of_nested_columns(spark):
    df = spark.sql("SELECT 1 AS a, array('xx', 'yy') AS b, map('k', 1) AS c, string(NULL) AS d")
    assert sizing.measured_bytes(df) > 64
    assert sizing.measured_bytes(df.where("a > 1")) == 0


# --- aggregation -------------------------------------------------------------------------


@pytest.fixture
def amounts(frame):
    data = [("a", 1.0, "p"), ("a", 2.0, "q"), ("a", 2.0, None), ("b", None, "p"), (None, 5.0, "p"),
            (None, 7.0, "p"), (None, None, "q")]
    return frame(data, "g string, x double, t string")


def test_aggregate_names_and_functions(amounts):
    got = tw.aggregate_data(amounts, ["g"], {"x": ["sum", "count"], "t": "count_distinct"})
    assert got.columns == ["g", "x_sum", "x_count", "t_count_distinct"]
    assert rows(got) == [(None, 12.0, 2, 2), ("a", 5.0, 3, 2), ("b", None, 0, 1)]
    assert rows(tw.aggregate_data(amounts, [], {"x": "max"})) == [(7.0,)]
    for name in ("collect_list", "upper", "no_such"):
        with pytest.raises(ValueError):
            tw.aggregate_data(amounts, ["g"], {"x": name})
    with pytest.raises(ValueError):
        tw.aggregate_data(amounts, ["g"], {})


@pytest.mark.parametrize("hot_rows", [100, 1])
def test_median_and_mode(amounts, hot_rows):
    got = tw.aggregate_data(amounts, ["g"], {"x": ["median", "mode"], "t": "mode"}, hot_rows)
    assert rows(got) == [(None, 6.0, 7.0, "p"), ("a", 2.0, 2.0, "q"), ("b", None, None, "p")]
    assert rows(tw.aggregate_data(amounts, [], {"x": ["median", "sum"]}, hot_rows)) == [(2.0, 17.0)]
    nothing = amounts.where("x < 0")
    assert rows(tw.aggregate_data(nothing, [], {"x": "median"}, hot_rows)) == [(None,)]


def test_median_of_hot_groups_equals_spark(spark):
    df = spark.range(0, 3000, 1, 6).selectExpr("id % 4 AS g", "cast(hash(id) % 500 AS double) AS x")
    expected = df.groupBy("g").agg(F.median("x").alias("x_median"))
    assert rows(tw.aggregate_data(df, "g", {"x": "median"}, hot_rows=50)) == rows(expected)


@pytest.mark.parametrize("kind", ["spread", "ties", "odd"])
def test_selected_median_equals_spark(spark, kind):
    """Big groups beside small ones; the middle lies in a bracket, in a run of ties, or off it."""
    value = {
        "spread": "cast(hash(id) AS double)",
        "ties": "cast(if(id % 3 = 0, 7, id % 5) AS double)",
        "odd": "CASE WHEN id % 7 = 0 THEN NULL WHEN id % 2 = 0 THEN double('NaN') "
               "WHEN id % 5 = 0 THEN double('-Infinity') ELSE double(hash(id)) END",
    }[kind]
    df = spark.range(0, 120_001, 1, 8).selectExpr("if(id % 3 > 0, NULL, if(id < 1000, id % 9, 100)) AS g", f"{value} AS x")
    got = tw.aggregate_data(df, "g", {"x": "median"}, hot_rows=5_000)
    expected = df.groupBy("g").agg(F.median("x").alias("x_median"))
    assert list(map(str, rows(got))) == list(map(str, rows(expected)))


def test_rows_are_not_shuffled_by_group_for_a_selected_median(spark, monkeypatch):
    """The hot groups are broadcast; by a shuffle, one task would get all rows of a group."""
    from tablewright.operators import aggregates

    selected, plans = aggregates._selected_median, []

    def watched(df, *rest):
        plans.append(plan(df).split("== Physical")[1])
        return selected(df, *rest)

    monkeypatch.setattr(aggregates, "_selected_median", watched)
    df = spark.range(0, 60_000, 1, 8).selectExpr("if(id % 3 = 0, NULL, id % 3) AS g", "cast(hash(id) AS double) AS x")
    got = tw.aggregate_data(df, "g", {"x": "median"}, hot_rows=1_000)
    assert rows(got) == rows(df.groupBy("g").agg(F.median("x")))
    assert "BroadcastHashJoin" in plans[0] and "Exchange hashpartitioning" not in plans[0]


def test_selected_median_needs_no_automatic_broadcast(spark, monkeypatch):
    """No pass over the rows shuffles them by group where Spark broadcasts nothing unasked."""
    from tablewright.operators import aggregates

    plans = []

    def watch(name):
        function = getattr(aggregates, name)

        def watched(df, *rest):
            plans.append(plan(df).split("== Physical")[1])
            return function(df, *rest)

        monkeypatch.setattr(aggregates, name, watched)

    watch("_selected_median")
    watch("numbered_in_ranges")
    df = spark.range(0, 60_000, 1, 8).selectExpr("if(id % 3 = 0, NULL, id % 3) AS g", "cast(hash(id) AS double) AS x")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = rows(tw.aggregate_data(df, "g", {"x": "median"}, hot_rows=1_000))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert got == rows(df.groupBy("g").agg(F.median("x")))
    assert len(plans) == 2
    for one in plans:
        assert "BroadcastHashJoin" in one and "Exchange hashpartitioning" not in one and "SortMergeJoin" not in one


def test_selected_median_sorts_few_rows(spark, monkeypatch):
    """Of a big group only the rows around the middle are ranked."""
    from tablewright.operators import aggregates

    ranked = []
    numbered = aggregates.numbered_in_ranges

    def watched(df, *rest):
        ranked.append(df.count())
        return numbered(df, *rest)

    monkeypatch.setattr(aggregates, "numbered_in_ranges", watched)
    df = spark.range(0, 400_000, 1, 8).selectExpr("1 AS g", "cast(hash(id) AS double) AS x")
    got = tw.aggregate_data(df, "g", {"x": "median"}, hot_rows=1_000)
    assert rows(got) == rows(df.groupBy("g").agg(F.median("x")))
    assert 0 < ranked[0] < 4_000


def test_pivot_of_more_than_a_scan_runs_its_input_once(spark, amounts):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    source = amounts.coalesce(1).mapInPandas(count, amounts.schema).repartition(2)
    found = tw.pivot_data(source, ["g"], "t", "x")
    assert found.columns == ["g", "null", "p", "q"]
    assert rows(found) == rows(tw.pivot_data(amounts, ["g"], "t", "x"))
    assert seen.value == 7
    counted = tw.pivot_data(source, ["g"], "t", "x", "count")
    assert rows(counted) == rows(tw.pivot_data(amounts, ["g"], "t", "x", "count"))
    spark.conf.set("spark.sql.pivotMaxValues", "2")
    try:
        with pytest.raises(ValueError, match="pivot_long"):
            tw.pivot_data(source, ["g"], "t", "x")
    finally:
        spark.conf.unset("spark.sql.pivotMaxValues")


def test_pivot_long(spark, amounts):
    got = tw.pivot_long(amounts, ["g"], "t", "x")
    assert got.columns == ["g", "t", "x_sum"]
    assert rows(got) == [(None, "p", 12.0), (None, "q", None), ("a", None, 2.0), ("a", "p", 1.0), ("a", "q", 2.0), ("b", "p", None)]
    many = spark.range(12_000).selectExpr("id % 2 AS g", "id AS t", "1 AS x")
    assert tw.pivot_long(many, "g", "t", "x", "count").count() == 12_000


def test_pivot(amounts):
    found = tw.pivot_data(amounts, ["g"], "t", "x")
    assert found.columns == ["g", "null", "p", "q"]
    assert rows(found) == [(None, None, 12.0, None), ("a", 2.0, 1.0, 2.0), ("b", None, None, None)]
    listed = tw.pivot_data(amounts, "g", "t", "x", "count", values=["q", "z"])
    assert rows(listed) == [(None, 0, None), ("a", 1, None), ("b", None, None)]
    with pytest.raises(ValueError):
        tw.pivot_data(amounts, ["g"], "t", "x", "median")


def test_totals(amounts):
    assert tw.sum(amounts, "x").first().asDict() == {"x_sum": 17.0}
    assert tw.avg(amounts, "x").first().asDict() == {"x_avg": 3.4}
    assert tw.min(amounts, "x").first().asDict() == {"x_min": 1.0}
    assert tw.max(amounts, ["x", "t"]).first().asDict() == {"x_max": 7.0, "t_max": "q"}
