import json

import pytest

import tablewright as tw
from tablewright.sources import readers
from suite.registry import Tables
from suite.warehouse import _write_csv
from tablewright.plans import config as configs
from tablewright.plans import steps, warehouse
from tablewright.plans.run import located
from tablewright.plans.sql import run_sql, sql_text
from tests.conftest import column, rows


_NAMED = {"alias": "a", "input_prefix": "x"}


def _config(**changes):
    base = {
        "extraction": {"input_prefix": "in", "format": "parquet"},
        "transformation": {"steps": []},
        "loading": {"output_prefix": "out", "partition_cols": [], "unique_run": False},
    }
    return base | changes


@pytest.mark.parametrize(
    "broken, message",
    [
        ({"transformation": {"steps": {}}}, "must be a list"),
        ({"transformation": {"steps": ["trim"]}}, "step 0 must be an object"),
        ({"transformation": {"steps": [{"columns": []}]}}, "step 0 has no name"),
        (
            {"transformation": {"steps": [{"name": "explode"}]}},
            "unsupported step 'explode'; available: add_column",
        ),
        ({"transformation": []}, "must be an object"),
        ({"transformation": {"sql": "SELECT 1"}}, "needs extraction.inputs"),
        ({"transformation": {"sql": 3}}, "text or a list"),
        ({"extraction": {}}, "input_prefix is missing"),
        ({"extraction": {"input_prefix": "x", "format": "xml"}}, "unsupported input format"),
        ({"extraction": {"input_prefix": "x", "options": []}}, None),
        ({"extraction": {"input_prefix": "x", "options": ["a"]}}, "options must be an object"),
        ({"extraction": {"inputs": []}}, "non-empty list"),
        ({"extraction": {"inputs": ["x"]}}, "must be an object"),
        ({"extraction": {"inputs": [{"input_prefix": "x"}]}}, "has no alias"),
        ({"extraction": {"inputs": [_NAMED, _NAMED]}}, "duplicate input alias"),
        ({"extraction": {"inputs": [_NAMED]}}, "need transformation.sql"),
        (
            {"extraction": {"inputs": [_NAMED]}, "transformation": {"sql": ["  ", ""]}},
            "sql is empty",
        ),
        ({"loading": None}, "output_prefix is missing"),
        ({"loading": {"output_prefix": "x", "partition_cols": 3}}, "must be a list or comma"),
    ],
)
def test_configurations_are_checked_first(broken, message):
    if message is None:
        configs.check_config(_config(**broken))
        return
    with pytest.raises(ValueError, match=message):
        configs.check_config(_config(**broken))


def test_configuration_defaults(tmp_path):
    build = configs.check_config(_config(transformation=None, loading={"output_prefix": "o"}))
    assert build.steps == [] and build.sql is None and build.mode == "overwrite"
    assert build.unique_run and build.partition_cols == ["etl_run_date"]
    listed = _config(loading={"output_prefix": "o", "partition_cols": "a, b"})
    assert configs.check_config(listed).partition_cols == ["a", "b"]
    assert configs.check_config(_config()).partition_cols == []
    unlisted = _config(loading={"output_prefix": "o"})
    assert configs.check_config(unlisted, ["d"]).partition_cols == ["d"]
    path = tmp_path / "c.json"
    path.write_text(json.dumps(_config()))
    assert configs.load_config(path) == configs.load_config(json.dumps(_config())) == _config()
    with pytest.raises(ValueError):
        configs.load_config("[1]")


def test_locations():
    assert located("s3a://b/w/", "silver/x/") == "s3a://b/w/silver/x"
    assert located("s3a://b", "file:/tmp/x") == "file:/tmp/x"
    assert located("/base", "/tmp/x/") == "/tmp/x" and located(None, "rel") == "rel"


def test_sql_aliases_are_temporary(spark, frame):
    spark.sql("SELECT 'mine' AS who").createOrReplaceTempView("taken")
    a, b = frame([(1,)], "n int"), frame([(2,)], "n int")
    lines = ["SELECT n FROM taken", "UNION ALL SELECT n FROM fresh"]
    got = run_sql(spark, {"taken": a, "fresh": b}, lines)
    assert rows(got) == [(1,), (2,)]
    assert spark.table("taken").first().who == "mine"
    assert not spark.catalog.tableExists("fresh")
    with pytest.raises(Exception, match="no_such"):
        run_sql(spark, {"fresh": a}, "SELECT no_such FROM fresh")
    assert not spark.catalog.tableExists("fresh")
    for frames, text in (({"a": a}, " "), ({}, "SELECT 1")):
        with pytest.raises(ValueError):
            run_sql(spark, frames, text)
    assert sql_text(None) is None
    cached = frame([(5,)], "n int").cache()
    assert cached.count() == 1 and rows(run_sql(spark, {"c": cached}, "SELECT n FROM c")) == [(5,)]
    assert cached.storageLevel.useMemory
    cached.unpersist()
    spark.catalog.dropTempView("taken")


def test_steps_cover_the_operators(frame):
    df = frame([(1, " a ", None), (2, "b", 3.0)], "n int, t string, x double")
    assert {"trim", "drop_duplicates", "row_number", "aggregate_data"} <= set(steps.STEPS)
    got = tw.apply_transformation_steps(
        df,
        [
            {"name": "trim", "columns": ["t"]},
            {"name": "fill_null", "column": "x", "value": 0},
            {"name": "coalesce_column", "target_column": "c", "source_columns": ["x"]},
            {"name": "row_number", "order_by": [["n", False]]},
        ],
        "r1",
    )
    audit = ["etl_loaded_at", "etl_run_date", "etl_run_id"]
    assert got.columns == ["n", "t", "x", "c", "row_number", *audit]
    assert rows(got.select("n", "t", "c", "row_number", "etl_run_id")) == [
        (1, "a", 0.0, 2, "r1"), (2, "b", 3.0, 1, "r1")]


def test_run_counts_and_guards(spark, frame, tmp_path):
    base = str(tmp_path)
    frame([(1, "x"), (1, "x"), (2, "y")], "n int, t string").write.parquet(f"{base}/in")
    config = _config(transformation={"steps": [{"name": "drop_duplicates"}]})
    result = tw.run_pipeline(spark, config, base, run_id="run 1", count_inputs=True)
    assert result.path == f"{base}/out"
    assert result.output_rows == 2 and result.input_rows == {None: 3}
    stored = tw.read_parquet(spark, result.path)
    assert column(stored, "source_path") == [f"{base}/in"] * 2
    assert column(stored, "etl_run_id") == ["run_1"] * 2
    for source, target in (("in", "in"), ("in", "in/below"), ("deep/in", "deep")):
        config = _config(
            extraction={"input_prefix": source}, loading={"output_prefix": target, "unique_run": False}
        )
        with pytest.raises(ValueError, match="own input"):
            tw.run_pipeline(spark, config, base)
    for allowed in ({"unique_run": True}, {"unique_run": False, "mode": "append", "partition_cols": []}):
        same = _config(loading={"output_prefix": "twice", **allowed}, extraction={"input_prefix": "twice"})
        frame([(1, "x")], "n int, t string").write.mode("overwrite").parquet(f"{base}/twice")
        assert tw.run_pipeline(spark, same, base, "one").output_rows == 1
    with pytest.raises(FileNotFoundError):
        tw.run_pipeline(spark, _config(extraction={"input_prefix": "nothing"}), base)
    kept = tw.run_pipeline(
        spark, _config(loading={"output_prefix": "out", "mode": "ignore", "unique_run": False,
                                "partition_cols": []}), base, count_inputs=True)
    assert kept.output_rows is None and tw.read_parquet(spark, kept.path).count() == 2
    unique = tw.run_pipeline(spark, _config(loading={"output_prefix": "runs"}), base, "r")
    assert unique.path == f"{base}/runs/run_id=r"
    assert "etl_run_date" in tw.read_parquet(spark, f"{base}/runs", run_id="r").columns


def test_declared_schema(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.jsonl").write_text('{"n": 1, "t": "x"}\n{"n": "bad"}\n')
    source = {"input_prefix": "in", "format": "json", "schema": "n int, t string, z date"}
    result = tw.run_pipeline(spark, _config(extraction=source), str(tmp_path))
    stored = tw.read_parquet(spark, result.path)
    assert dict(stored.dtypes)["z"] == "date"
    assert rows(stored.select("n", "t")) == [(None, None), (1, "x")]
    with pytest.raises(ValueError, match="DDL"):
        configs.check_config(_config(extraction=source | {"schema": ["n int"]}))


def test_command_line(spark, frame, tmp_path, capsys):
    import run_build

    frame([(1,), (2,)], "n int").write.parquet(f"{tmp_path}/in")
    path = tmp_path / "build.json"
    path.write_text(json.dumps(_config()))
    run_build.main([str(path), "--base-path", str(tmp_path), "--run-id", "x", "--count-inputs"])
    assert f"wrote 2 rows to {tmp_path}/out; input rows: {{None: 2}}" in capsys.readouterr().out


def test_warehouse_end_to_end(spark, tmp_path):
    """CSV to gold through storage; the sums must agree with plain SQL over the source tables."""
    tables, base = Tables(spark, "/root/testdata/sf0.001"), str(tmp_path)
    for name in warehouse.COLUMNS:
        _write_csv(tables, name, base)
    assert len(warehouse.builds()) == 19
    by_day = {"gold_fact_orders", "gold_fact_order_items", "gold_daily_sales"}  # 2,400 folders each
    only = [name for name in warehouse.builds() if name not in by_day]
    results = tw.run_warehouse(spark, base, "nightly", only=only)
    assert list(results) == only

    silver = {t: tw.read_parquet(spark, f"{base}/silver/{t}") for t in ("orders", "order_items")}
    sales = tw.transform_frames(spark, warehouse.builds()["gold_daily_sales"], silver)
    orders, lines = tables["orders"], tables["lineitem"]
    distinct = lines.select("l_orderkey", "l_linenumber").distinct().count()
    assert sales.selectExpr("sum(order_count)", "sum(order_item_count)").first() == (
        orders.count(), distinct)
    performance = tw.read_parquet(spark, f"{base}/gold/product_performance")
    assert results["gold_product_performance"].output_rows == tables["part"].count()
    assert performance.selectExpr("sum(event_count)").first()[0] <= tables["events"].count()
    assert set(column(performance, "etl_run_id")) == {"nightly"}

    tw.create_gold_tables(spark, f"{base}/gold", schema="shop_test")
    try:
        tw.sync_partitions(spark, "shop_test", ["fact_events"])
        assert spark.table("shop_test.fact_events").count() == tables["events"].count()
        assert spark.table("shop_test.dim_users").count() == tables["customer"].count()
    finally:
        spark.sql("DROP SCHEMA shop_test CASCADE")


def test_lookups(spark, frame):
    frames = {
        "sale": frame([(1, "a", 2), (2, "b", 3), (3, None, 4)], "id int, item string, n int"),
        "item": frame([("a", "red"), ("c", "blue")], "item string, colour string"),
    }
    listed = [{"alias": alias, "input_prefix": alias} for alias in frames]
    lookups = {
        "fact": "sale",
        "joins": [
            {"table": "item", "key": "item", "columns": {"colour": "item_colour"}},
            {"table": "sale", "key": "id", "aggregate": {"total": "sum(n)"}, "defaults": {"total": 0}},
        ],
        "derive": {"twice": "n * 2"},
        "columns": ["id", "item_colour", "total", "twice"],
    }
    config = {
        "extraction": {"inputs": listed}, "transformation": {"lookups": lookups},
        "loading": {"output_prefix": "out"},
    }
    got = tw.transform_frames(spark, config, frames)
    assert rows(got) == [(1, "red", 2, 4), (2, None, 3, 6), (3, None, 4, 8)]
    for broken in (
        [], {"fact": "sale"}, {**lookups, "fact": "none"}, {**lookups, "joins": {}},
        {**lookups, "joins": [{"table": "item", "columns": {"a": "b"}}]},
        {**lookups, "joins": [{"table": "item", "key": "item"}]},
    ):
        with pytest.raises(ValueError, match="lookups"):
            tw.transform_frames(spark, {**config, "transformation": {"lookups": broken}}, frames)
    with pytest.raises(ValueError, match="either"):
        both = {"lookups": lookups, "sql": "SELECT 1"}
        tw.transform_frames(spark, {**config, "transformation": both}, frames)


def test_input_gate_stops_at_the_first_file(spark, tmp_path):
    deep = tmp_path / "a" / "b"
    deep.mkdir(parents=True)
    (tmp_path / "_hidden.csv").write_text("x")
    with pytest.raises(FileNotFoundError):
        readers.require_files(spark, str(tmp_path), ["csv"], "csv")
    (deep / "one.CSV").write_text("x")
    readers.require_files(spark, str(tmp_path), ["csv"], "csv")
    readers.require_files(spark, str(tmp_path / "a" / "*"), None, "any")
    with pytest.raises(FileNotFoundError):
        readers.require_files(spark, str(tmp_path / "none"), None, "any")
