"""File sources and sinks: every query writes and reads whole tables in the shared folder."""

from __future__ import annotations

from pyspark.sql import functions as F

import tablewright as tw
from suite.registry import plain_timestamps, query
from suite.written_files import avro_file, write_files, xlsx_file
from tablewright.sources.readers import with_source_path
from tablewright.sources.writers import with_audit_columns
from tablewright.staging import fresh_path

_ORDERS = (
    "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority "
    "FROM orders"
)
_TYPES = {
    "o_orderkey": "bigint", "o_custkey": "bigint", "o_totalprice": "double",
    "o_orderdate": "timestamp",
}


def _typed(orders):
    return plain_timestamps(tw.cast_columns(orders, _TYPES))


@query("scan_parquet", "SELECT o_orderkey, o_totalprice FROM orders")
def _(t):
    orders = tw.read_dataset(t.spark, f"{t.folder}/orders.parquet")
    return tw.select(orders, ["o_orderkey", "o_totalprice"])


@query("scan_csv", _ORDERS)
def _(t):
    path = fresh_path(t.spark, "csv")
    t["orders"].write.option("header", True).csv(path)
    options = {"header": True, "inferSchema": False, "multiLine": False, "escape": '"', "quote": '"'}
    return _typed(tw.read_dataset(t.spark, path, "csv", options))


@query("scan_json", _ORDERS)
def _(t):
    path = fresh_path(t.spark, "json")
    orders = t["orders"]
    orders.write.json(path)
    text = ", ".join(f"{name} string" for name in orders.columns)
    return _typed(tw.read_dataset(t.spark, path, "json", schema=text))


@query("scan_text", "SELECT concat_ws('|', o_orderkey, o_orderpriority) AS value FROM orders")
def _(t):
    path = fresh_path(t.spark, "text")
    t["orders"].select(F.concat_ws("|", "o_orderkey", "o_orderpriority")).write.text(path)
    return tw.read_dataset(t.spark, path, "text")


@query("scan_orc", _ORDERS)
def _(t):
    path = fresh_path(t.spark, "orc")
    t["orders"].write.orc(path)
    return tw.read_dataset(t.spark, path, "ORC")


# The columns of the orders as Avro types; the date in microseconds.
_AVRO_ORDERS = {
    "type": "record", "name": "order", "fields": [
        {"name": "o_orderkey", "type": "long"}, {"name": "o_custkey", "type": ["null", "long"]},
        {"name": "o_orderstatus", "type": ["string", "null"]}, {"name": "o_totalprice", "type": "double"},
        {"name": "o_orderdate", "type": {"type": "long", "logicalType": "local-timestamp-micros"}},
        {"name": "o_orderpriority", "type": ["null", "string"]},
    ],
}


def _avro_orders(names, rows):
    branches = {f["name"]: [b != "null" for b in f["type"]].index(True) for f in _AVRO_ORDERS["fields"] if isinstance(f["type"], list)}

    def row(values):
        return {n: (branches[n], v) if n in branches and v is not None else v for n, v in zip(names, values)}

    return avro_file(_AVRO_ORDERS, map(row, rows))


@query("scan_avro", _ORDERS)
def _(t):
    """Read by small splits, so that most files have several tasks."""
    orders = plain_timestamps(t["orders"])
    orders = orders.withColumn("o_orderdate", F.unix_micros(F.col("o_orderdate").cast("timestamp")))
    path = write_files(orders.select([f["name"] for f in _AVRO_ORDERS["fields"]]), fresh_path(t.spark, "avro"), ".avro", _avro_orders)
    return tw.read_dataset(t.spark, path, "avro", {"splitBytes": 64 * 1024})


@query("scan_excel", _ORDERS)
def _(t):
    orders = t["orders"].withColumn("o_orderdate", F.col("o_orderdate").cast("string"))
    path = write_files(orders, fresh_path(t.spark, "excel"), ".xlsx", lambda names, rows: xlsx_file([names, *rows]), 20_000)
    return _typed(tw.read_dataset(t.spark, path, "excel", {"header": True}))


@query("list_files", """
    SELECT DISTINCT concat('status_is=', o_orderstatus) AS folder, true AS has_bytes FROM orders""")
def _(t):
    """Folders that hold Parquet files after a partitioned write."""
    orders = t["orders"].withColumn("status_is", F.col("o_orderstatus"))
    path = tw.write_parquet(
        orders, fresh_path(t.spark, "listed"), unique_run=False, partition_cols=["status_is"]
    )
    files = tw.list_files(t.spark, path, [".PARQUET"])
    folder = F.element_at(F.split("path", "/"), -2).alias("folder")
    return files.groupBy(folder).agg((F.sum("length") > 0).alias("has_bytes"))


@query("lineage_column", "SELECT c_custkey, c_name, 'customer.parquet' AS source_file, "
       "'shop/customers' AS source_path FROM customer")
def _(t):
    customers = with_source_path(t["customer"], "", per_file=True).select(
        "c_custkey", "c_name", F.element_at(F.split("source_path", "/"), -1).alias("source_file")
    )
    return with_source_path(customers, "shop/customers")


@query("write_roundtrip", _ORDERS)
def _(t):
    path = tw.write_parquet(t["orders"], fresh_path(t.spark, "roundtrip"), unique_run=False)
    return tw.read_parquet(t.spark, path)


@query("write_append", f"{_ORDERS} UNION ALL {_ORDERS}")
def _(t):
    path = fresh_path(t.spark, "append")
    for _ in range(2):
        tw.write_parquet(t["orders"], path, mode="append", unique_run=False)
    return tw.read_parquet(t.spark, path)


@query("write_partitioned", """
    SELECT o_orderkey, o_totalprice, strftime(o_orderdate, '%Y-%m') AS order_month FROM orders""")
def _(t):
    orders = t["orders"].select(
        "o_orderkey", "o_totalprice", F.date_format("o_orderdate", "yyyy-MM").alias("order_month")
    )
    path = tw.write_parquet(
        orders, fresh_path(t.spark, "months"), unique_run=False, partition_cols=["order_month"]
    )
    return tw.read_parquet(t.spark, path).withColumn(
        "order_month", F.col("order_month").cast("string")
    )


@query("write_unique_run", """
    SELECT s_suppkey, s_name, 'first_run' AS run_id FROM supplier
    UNION ALL SELECT s_suppkey, s_name, 'second.run' FROM supplier""")
def _(t):
    base = fresh_path(t.spark, "runs")
    suppliers = t["supplier"].select("s_suppkey", "s_name")
    for run_id in ("first run", "second.run"):
        tw.write_parquet(suppliers, base, run_id=run_id)
    return tw.read_parquet(t.spark, base)


@query("audit_columns", "SELECT c_custkey, 'nightly' AS etl_run_id, true AS loaded FROM customer")
def _(t):
    audited = with_audit_columns(t["customer"].select("c_custkey"), "nightly")
    loaded = F.col("etl_run_date") == F.to_date("etl_loaded_at")
    return audited.select("c_custkey", "etl_run_id", loaded.alias("loaded"))
