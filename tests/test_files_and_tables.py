import os

import pytest
from pyspark.sql import functions as F

import tablewright as tw
from tablewright import staging
from tablewright.sources import readers, writers
from tablewright.sources.tables import GOLD_TABLES
from tests.conftest import column, plan, rows


def test_format_names():
    assert readers.normalize_read_format(None) == "parquet"
    assert readers.normalize_read_format(" CSV ") == "csv"
    assert readers.get_spark_reader_format("xlsx") == "com.crealytics.spark.excel"
    assert readers.get_file_extensions_for_format("json") == (".json", ".jsonl", ".ndjson")
    with pytest.raises(ValueError, match="avro, csv"):
        readers.normalize_read_format("xml")


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "deep" / "er").mkdir(parents=True)
    (tmp_path / "a.CSV").write_text("k,v\n1,x\n")
    (tmp_path / "deep" / "b.csv").write_text("k,v\n2,y\n")
    (tmp_path / "deep" / "er" / "c.txt").write_text("note\n")
    return tmp_path


def _names(df):
    return sorted(os.path.basename(path) for path in column(df, "path"))


def test_list_files(spark, folder):
    assert _names(tw.list_files(spark, str(folder))) == ["a.CSV", "b.csv", "c.txt"]
    assert _names(tw.list_files(spark, str(folder), ["csv"])) == ["a.CSV", "b.csv"]
    assert _names(tw.list_files(spark, str(folder), ".txt, .csv")) == ["a.CSV", "b.csv", "c.txt"]
    assert _names(tw.list_files(spark, str(folder / "a.CSV"), [".csv"])) == ["a.CSV"]
    assert _names(readers.list_parquet_files(spark, str(folder))) == []
    listed = plan(tw.list_files(spark, str(folder), ["csv"]))
    assert "content" not in listed[listed.rindex("ReadSchema"):]
    with pytest.raises(FileNotFoundError):
        tw.list_files(spark, str(folder / "none"))


def test_read_needs_matching_files(spark, folder):
    with pytest.raises(FileNotFoundError):
        tw.read_dataset(spark, str(folder), "parquet")
    with pytest.raises(FileNotFoundError):
        tw.read_dataset(spark, str(folder / "none"), "csv")
    options = {"header": True, "recursiveFileLookup": True, "pathGlobFilter": "*.{csv,CSV}"}
    assert rows(tw.read_dataset(spark, str(folder), "csv", options)) == [("1", "x"), ("2", "y")]
    text = tw.read_dataset(spark, str(folder / "deep" / "er"), "text", extensions=".txt")
    assert rows(text) == [("note",)]


def test_csv_quotes_and_gaps(spark, tmp_path):
    (tmp_path / "q.csv").write_text('a,b,c\n"x ""y"" z",, p \n"",2\n')
    options = {"header": True, "inferSchema": False, "escape": '"', "quote": '"'}
    got = tw.read_dataset(spark, str(tmp_path), "csv", options)
    assert rows(got) == [(None, "2", None), ('x "y" z', None, " p ")]


def test_run_ids():
    assert writers.safe_run_id(" scheduled__2024-01-01T00:00:00+00:00 ") == (
        "scheduled__2024-01-01T00_00_00_00_00")
    assert writers.safe_run_id("  ") is None and writers.safe_run_id(None) is None
    assert writers.build_unique_output_path("/x/", "r é") == "/x/run_id=r__"
    made = writers.build_unique_output_path("/x")
    assert made.startswith("/x/run_id=2") and made != writers.build_unique_output_path("/x")


def test_write_modes_and_runs(spark, frame, tmp_path):
    df, base = frame([(1, "a"), (2, None)], "n int, day string"), str(tmp_path / "out")
    assert tw.write_parquet(df, base + "/", unique_run=False) == base
    tw.write_parquet(df, base, mode="append", unique_run=False)
    tw.write_parquet(df, base, mode="ignore", unique_run=False)
    assert tw.read_parquet(spark, base).count() == 4
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        tw.write_parquet(df, base, mode="error", unique_run=False)
    runs = str(tmp_path / "runs")
    for run_id in ("one", "two"):
        tw.write_parquet(df, runs, run_id=run_id)
    assert tw.read_parquet(spark, runs).count() == 4
    assert column(tw.read_parquet(spark, runs, run_id="two"), "run_id") == ["two", "two"]
    tw.write_parquet(df, runs, run_id="007")
    assert tw.read_parquet(spark, runs, run_id="007").count() == 2


def test_partition_overwrite(spark, frame, tmp_path):
    first = frame([(1, "d1"), (2, "d2"), (3, None)], "n int, day string")
    second = frame([(9, "d2")], "n int, day string")

    def write(name, how):
        path = str(tmp_path / name)
        for df in (first, second):
            tw.write_parquet(
                df, path, unique_run=False, partition_cols="day", partition_overwrite=how
            )
        return rows(tw.read_parquet(spark, path))

    assert write("static", "static") == [(9, "d2")]
    assert write("dynamic", "dynamic") == [(1, "d1"), (3, None), (9, "d2")]
    assert any("__HIVE_DEFAULT_PARTITION__" in d for d in os.listdir(tmp_path / "dynamic"))


def test_few_files_per_partition(spark, tmp_path):
    df = spark.range(0, 1000, 1, 8).selectExpr("id", "id % 3 AS day")
    path = tw.write_parquet(df, str(tmp_path / "days"), unique_run=False, partition_cols=["day"])
    assert tw.list_files(spark, path, ".parquet").count() == 3


def test_lineage_and_audit(frame):
    df = frame([(1, "old")], "n int, source_path string")
    assert readers.with_source_path(df, "s3a://b/x").first() == (1, "s3a://b/x")
    audited = tw.with_audit_columns(df)
    assert audited.columns[-3:] == ["etl_loaded_at", "etl_run_date", "etl_run_id"]
    assert [t for _, t in audited.dtypes[-3:]] == ["timestamp", "date", "string"]
    assert audited.first().etl_run_id == "manual"
    assert tw.with_audit_columns(audited, "r2").columns == audited.columns


def test_staging(spark, frame, monkeypatch):
    df = frame([(1, "a", [1, 2])], "`x y` int, `x y` string, z array<int>")
    staged = staging.stage(df, "test")
    assert staged.columns == ["x y", "x y", "z"] and rows(staged) == rows(df)
    odd = df.select(F.lit(None).alias("nothing"), F.array(F.lit(None)).alias("nothings"))
    assert rows(staging.stage(odd, "odd")) == [(None, [None])]
    staging.clear_staged(spark)
    with pytest.raises(Exception, match="FILE_NOT_EXIST|PATH_NOT_FOUND|not exist"):
        staged.collect()
    folder = staging.shared_folder(spark)
    configured = spark.conf.get("spark.checkpoint.dir", None)
    assert folder == (configured or spark.sparkContext.getCheckpointDir()).rstrip("/")


def test_gold_tables_and_partition_sync(spark, tmp_path):
    base = str(tmp_path / "gold")
    names = tw.create_gold_tables(spark, base, schema="gold_test")
    assert len(names) == 7
    try:
        for name, table in GOLD_TABLES.items():
            stored = spark.table(f"gold_test.{name}")
            assert len(stored.columns) == table.columns.count(",") + 1
            described = spark.catalog.listColumns(f"gold_test.{name}")
            assert [c.name for c in described if c.isPartition] == list(table.partitioned_by)

        def store(*days):
            ddl = "order_count long, order_item_count long, d string"
            df = spark.createDataFrame([(1, 2, d) for d in days], ddl)
            day = df.withColumn("order_day", F.to_date("d")).drop("d")
            tw.write_parquet(tw.with_audit_columns(day), f"{base}/daily_sales", unique_run=False,
                             partition_cols=["order_day"])
            tw.sync_partitions(spark, "gold_test", ["daily_sales"])
            return sorted(str(d) for d in column(spark.table("gold_test.daily_sales"), "order_day"))

        assert store("2024-01-01", "2024-01-02") == ["2024-01-01", "2024-01-02"]
        assert store("2024-01-02", "2024-01-03") == ["2024-01-02", "2024-01-03"]
        spark.range(1).selectExpr("'P1' AS product_id", "2.5D AS price").write.parquet(
            f"{base}/product_performance")
        spark.catalog.refreshTable("gold_test.product_performance")
        shown = spark.table("gold_test.product_performance").limit(10).select("product_id", "price")
        assert rows(shown) == [("P1", 2.5)]
    finally:
        spark.sql("DROP SCHEMA gold_test CASCADE")
