from decimal import Decimal

import pytest

import tablewright as tw
from tests.conftest import column, plan, rows

NAN = float("nan")


def test_filters(frame):
    df = frame([(1, "ab"), (2, None), (None, "ba"), (4, "a.b")], "n int, t string")
    both = ["n > 0", "t LIKE 'a%' OR t LIKE 'b%'"]
    assert rows(tw.filter_rows(df, both)) == [(1, "ab"), (4, "a.b")]
    assert rows(tw.filter_rows(df, "n > 1")) == [(2, None), (4, "a.b")]
    with pytest.raises(ValueError):
        tw.filter_rows(df, [])
    assert column(tw.starts_with(df, "t", "a."), "n") == [4]
    assert column(tw.ends_with(df, "t", "b"), "n") == [1, 4]


def test_flags(frame):
    df = frame([(1, ""), (2, None), (3, " "), (4, "x%y")], "n int, t string")
    assert column(tw.is_null_or_empty_column(df, "t", "f"), "f") == [True, True, False, False]
    assert column(tw.is_null_or_empty_column(df, "n", "f"), "f") == [False] * 4
    assert column(tw.contains_substring_column(df, "t", "f", "%"), "f") == [False, None, False, True]
    assert column(tw.starts_with_column(df, "t", "f", "x"), "f") == [False, None, False, True]
    assert column(tw.ends_with_column(df, "t", "f", "y"), "f") == [False, None, False, True]


def test_nulls(frame):
    df = frame([(None, None, 1.0), (2, "", NAN), (3, "c", None)], "n int, t string, x double")
    assert column(tw.fill_null(df, "n", 0), "n") == [0, 2, 3]
    assert column(tw.fill_null(df, "n", "7"), "n") == [7, 2, 3]
    assert column(tw.fill_null(df, "t", "z"), "t") == ["z", "", "c"]
    assert column(tw.fill_null(df, "t", 5), "t") == ["5", "", "c"]
    assert column(tw.fill_null(df, "x", 9.0), "x") == [1.0, 9.0, 9.0]
    with pytest.raises(ValueError):
        tw.fill_null(df, "n", "many")
    assert tw.drop_null(df, "n").count() == 2
    assert column(tw.drop_null(df, "x"), "x") == [1.0]
    assert column(tw.ifnull_column(df, "f", "t", "none"), "f") == ["none", "", "c"]
    joined = tw.coalesce_column(df.selectExpr("cast(n AS string) n", "t"), "f", "t", "n")
    assert column(joined, "f") == [None, "", "c"]
    with pytest.raises(ValueError):
        tw.coalesce_column(df, "f")


def test_trim_and_case(frame):
    df = frame([("  a\t ", "Bc")], "a string, b string")
    assert tw.trim(df, ["a", "b"]).first() == ("a\t", "Bc")
    assert tw.trim(df, "a").first().a == "a\t"
    assert tw.uppercase(df, ["b"]).first().b == "BC"
    assert tw.lowercase(df, ["b"]).first().b == "bc"


def test_value_map(frame, monkeypatch):
    df = frame([("a", 1), ("b", 2), (None, 3), ("c", 4)], "t string, n int")
    wanted = ["A", "b", None, None]
    mapping = {"a": "A", "c": None}
    assert column(tw.rename_values(df, "t", mapping), "t") == wanted
    assert column(tw.rename_values(df, "t", {}), "t") == ["a", "b", None, "c"]
    monkeypatch.setattr("tablewright.operators.text.LITERAL_MAP_ENTRIES", 1)
    joined = tw.rename_values(df, "t", mapping)
    assert joined.columns == ["t", "n"]
    assert column(joined.orderBy("n"), "t") == wanted
    assert "BroadcastHashJoin" in plan(joined)


def test_split(frame):
    df = frame([("a b",), ("q",), (None,), ("x.y|z",)], "t string")
    two = tw.split_column(df, "t", ["p", "q"])
    assert column(two, "p") == ["a", "q", None, "x.y|z"]
    assert column(two, "q") == ["b", None, None, None]
    literal = tw.split_column(df, "t", ["p", "q"], ".", literal=True)
    assert column(literal, "q") == [None, None, None, "y|z"]
    assert column(tw.split_column(df, "t", ["p", "q"], r"\|"), "q") == [None, None, None, "z"]
    # The source column may be a target as well.
    assert tw.split_column(df, "t", ["t", "u"]).first() == ("a", "b")


def test_mask_and_clean(frame):
    df = frame([("1234567890",), ("12",), (None,), ("é-a b1",)], "t string")
    assert column(tw.mask_column(df, "t", "m"), "m") == ["******7890", "12", None, "**a b1"]
    assert column(tw.mask_column(df, "t", "m", "#", 0), "m") == ["#" * 10, "##", None, "#" * 6]
    cleaned = tw.remove_special_characters_column(df, "t", "m")
    assert column(cleaned, "m") == ["1234567890", "12", None, "ab1"]


def test_patterns_and_parts(frame):
    df = frame([("ann@x.com", "A"), ("none", None), (None, "C")], "t string, u string")
    assert column(tw.regex_extract_column(df, "t", "f", "^([^@]+)@"), "f") == ["ann", "", None]
    assert column(tw.replace_substring(df, "t", "n+", "_"), "t") == ["a_@x.com", "_o_e", None]
    assert column(tw.substring_column(df, "t", "f", 0, 2), "f") == ["an", "no", None]
    assert column(tw.substring_column(df, "t", "f", -3, 2), "f") == ["co", "on", None]
    assert column(tw.concat_columns(df, ["t", "u"], "f", "/"), "f") == ["ann@x.com/A", "none", "C"]


def test_several_columns_make_one_projection(spark):
    parts = spark.read.parquet("/root/testdata/sf0.001/part.parquet")
    text = plan(tw.uppercase(tw.trim(parts, ["p_name", "p_brand", "p_type"]), ["p_name"]))
    assert text.split("== Optimized")[1].split("== Physical")[0].count("Project") == 1


def test_dedup(frame):
    df = frame([(1, "b", 2), (1, "a", 3), (1, "a", 3), (2, None, 1)], "k int, t string, n int")
    assert tw.drop_duplicates(df).count() == 3
    assert tw.drop_duplicates(df, []).count() == 3
    assert tw.drop_duplicates(df, ["k"]).count() == 2
    first = tw.drop_duplicates(df, "k", order_by=["t"])
    assert first.columns == df.columns and rows(first) == [(1, "a", 3), (2, None, 1)]
    assert rows(tw.drop_duplicates(df, ["k"], order_by=[["t", False]])) == [(1, "b", 2), (2, None, 1)]
    text = plan(first)
    assert text.index("Final") < text.index("hashpartitioning") < text.rindex("Partial")


def test_sort(frame):
    df = frame([(1, None), (2, "b"), (3, "a"), (4, None)], "n int, t string")
    assert column(tw.sort_rows(df, ["t", "n"]), "n") == [1, 4, 3, 2]
    assert column(tw.sort_rows(df, ["t", "n"], ascending=False), "n") == [2, 3, 4, 1]
    assert column(tw.sort_rows(df, ["t", "n"], ascending=[False, True]), "n") == [2, 3, 1, 4]
    assert column(tw.sort_rows(df, "n", ascending=False), "n") == [4, 3, 2, 1]
    with pytest.raises(ValueError):
        tw.sort_rows(df, ["t", "n"], ascending=[True])


def test_sort_splits_a_run_of_copies(spark, no_coalescing):
    """Half of all rows are copies of one row; no task may get them all."""
    df = spark.range(0, 80_000, 1, 16).selectExpr("if(id % 2 = 0, -1, id) AS n")
    per_task = tw.sort_rows(df, "n").selectExpr("spark_partition_id() AS p").groupBy("p").count()
    assert max(column(per_task, "count")) < 20_000
    collected = column(tw.sort_rows(df, "n"), "n")
    assert collected == sorted(collected) and len(collected) == 80_000


@pytest.mark.parametrize("values", [{i: -i for i in range(600)}, {i: float(i) for i in range(600)}])
def test_a_mapping_gives_one_type_on_both_sides_of_the_limit(frame, values):
    df = frame([(1,), (700,), (None,)], "x int")
    results = []
    for size in (500, 501):
        got = tw.rename_values(df, "x", dict(list(values.items())[:size]))
        results.append((got.dtypes, rows(got)))
    assert results[0] == results[1]


def test_mapping_keys_outside_the_type_of_the_column(frame):
    """A bigint, fractional or decimal key beside an int column, on both sides of the limit."""
    df = frame([(1,), (2,), (None,)], "x int")
    for odd in (3_000_000_000, 1.5, Decimal("12345678901234567890.5"), -(1 << 31)):
        results = []
        for size in (499, 500):
            values = {i: i + 1 for i in range(size)} | {odd: 7}
            got = tw.rename_values(df, "x", values)
            results.append((got.dtypes, rows(got)))
        assert results[0] == results[1]
        assert [row[0] for row in results[0][1]] == [None, 2, 3]
