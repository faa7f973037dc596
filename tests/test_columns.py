import datetime

import pytest

import tablewright as tw
from tests.conftest import column, plan


def test_select_drop_add(frame):
    df = frame([(1, 2, 3)], "a int, b int, c int")
    assert tw.select(df, ["c", "a"]).columns == ["c", "a"]
    assert tw.select(df, "b").columns == ["b"]
    assert tw.drop_columns(df, ["a", "missing"]).columns == ["b", "c"]
    assert tw.add_column(df, "d", tw.col(df, "a") + 10).first().d == 11
    assert tw.add_column(df, "a", "b * 2").first().a == 4
    assert tw.type_of(df, "a") == "int"
    with pytest.raises(KeyError):
        tw.type_of(df, "z")


def test_renames_are_simultaneous(frame):
    df = frame([(1, 2)], "a int, b int")
    assert tw.rename_columns(df, {"a": "b", "b": "c"}).columns == ["b", "c"]
    assert tw.rename_columns(df, {"a": "b", "b": "a"}).first().asDict() == {"b": 1, "a": 2}
    assert tw.rename_columns(df, {"x": "y"}).columns == ["a", "b"]
    assert tw.rename_column(df, "a", "z").columns == ["z", "b"]
    assert tw.rename_column(df, "x", "z").columns == ["a", "b"]
    with pytest.raises(KeyError):
        tw.rename_columns(df, {"x": "y"}, strict=True)
    with pytest.raises(ValueError):
        tw.rename_columns(df, {"a": "b"})


def test_standardized_names(frame):
    df = frame([(1, 2, 3)], "`A  b` int, ` C ` int, `x-Y.z` int")
    assert tw.standardize_column_names(df).columns == ["a__b", "c", "x-y.z"]
    with pytest.raises(ValueError):
        tw.standardize_column_names(frame([(1, 2)], "`A b` int, a_b int"))


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_text_to_integer(spark, frame, ansi):
    texts = ["1", "3.7", "-3.7", " 5 ", ".5", ".", "1e2", "99999999999", "bad", None, "7."]
    df = frame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        got = tw.convert_column(df, "t", "integer").orderBy("i")
        assert column(got, "t") == [1, 3, -3, 5, 0, None, None, None, None, None, 7]
        doubles = tw.convert_column(df, "t", "double").orderBy("i")
        assert column(doubles, "t")[:3] == [1.0, 3.7, -3.7]
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_dates_and_timestamps(frame):
    texts = ["2024-01-02", "bad", "2024-01-02 10:11:12", None]
    df = frame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    day = datetime.date(2024, 1, 2)
    assert column(tw.convert_column(df, "t", "date").orderBy("i"), "t") == [day, None, day, None]
    strict = tw.convert_column(df, "t", "date", "yyyy-MM-dd").orderBy("i")
    assert column(strict, "t") == [day, None, None, None]
    stamped = tw.cast_column(df, "t", "datetime", "yyyy-MM-dd HH:mm:ss").orderBy("i")
    assert tw.type_of(stamped, "t") == "timestamp"
    assert column(stamped, "t") == [None, None, datetime.datetime(2024, 1, 2, 10, 11, 12), None]
    free = column(tw.cast_column(df, "t", "timestamp").orderBy("i"), "t")
    assert free[0] == datetime.datetime(2024, 1, 2) and free[1] is None


def test_cast_columns_is_one_projection(frame):
    df = frame([("1", "2.5", 300)], "a string, b string, c int")
    got = tw.cast_columns(df, {"a": "int", "b": "decimal(4,1)", "c": "tinyint"})
    assert [t for _, t in got.dtypes] == ["int", "decimal(4,1)", "tinyint"]
    row = got.first()
    assert row.a == 1 and float(row.b) == 2.5 and row.c is None
    assert plan(got).split("== Optimized")[1].split("== Physical")[0].count("Project") == 1


def test_pushdown_survives_renaming_and_trimming(spark):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    renamed = tw.rename_columns(orders, {"o_totalprice": "price"})
    trimmed = tw.trim(renamed, ["o_orderpriority"])
    text = plan(tw.filter_rows(trimmed, "price > 1000").select("o_orderkey", "o_orderpriority"))
    assert "GreaterThan(o_totalprice,1000.0)" in text
    read = text[text.rindex("ReadSchema"):]
    assert "o_custkey" not in read


def test_names_that_differ_in_case_only_clash(spark, frame):
    df = frame([(1, 2)], "x int, name int")
    with pytest.raises(ValueError, match="duplicate"):
        tw.rename_column(df, "x", "Name")
    assert tw.rename_columns(df, {"name": "Name"}).columns == ["x", "Name"]
    assert tw.rename_columns(df, {"x": "Name", "name": "y"}).columns == ["Name", "y"]
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        assert tw.rename_column(df, "x", "Name").columns == ["Name", "name"]
    finally:
        spark.conf.unset("spark.sql.caseSensitive")
