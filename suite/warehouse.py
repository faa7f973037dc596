"""The shop warehouse: bronze, silver and gold tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

import tablewright as tw
from suite.registry import Tables, plain_timestamps, query, rounded
from suite.shop import raw, with_raw
from tablewright.plans import warehouse as shop
from tablewright.staging import fresh_path, stage

_KEYS = {table: names[0] for table, names in shop.COLUMNS.items()}


def _write_csv(t: Tables, table: str, base: str) -> None:
    """The raw table as a CSV dataset; outer spaces are kept for the silver layer to trim."""
    (
        raw(t, table)
        .write.option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(f"{base}/ecommerce_dataset/{table}.csv")
    )


# --- bronze ------------------------------------------------------------------------------


def _register_bronze(table: str) -> None:
    names = shop.COLUMNS[table]

    @query(f"bronze_{table}", with_raw(table, f"SELECT {', '.join(names)} FROM raw_{table}"))
    def _(t):
        base = fresh_path(t.spark, "bronze")
        _write_csv(t, table, base)
        result = tw.run_pipeline(t.spark, shop.bronze(table), base)
        return tw.read_parquet(t.spark, result.path).select(*names)


# --- silver ------------------------------------------------------------------------------

_SILVER_COLUMNS = {
    "signup_date": "CAST(signup_date AS DATE)",
    "product_name": "trim(product_name)",
    "category": "trim(category)",
    "brand": "trim(brand)",
    "price": "CAST(price AS DOUBLE)",
    "order_date": "CAST(order_date AS TIMESTAMP)",
    "total_amount": "CAST(total_amount AS DOUBLE)",
    "quantity": "CAST(quantity AS INTEGER)",
    "item_price": "CAST(item_price AS DOUBLE)",
    "item_total": "CAST(item_total AS DOUBLE)",
    "event_timestamp": "CAST(event_timestamp AS TIMESTAMP)",
    "review_date": "CAST(review_date AS TIMESTAMP)",
}


def _silver_sql(table: str) -> str:
    """One row per key of the typed raw table: the first one by all other columns."""
    key, *rest = shop.COLUMNS[table]
    rating = "CAST(rating AS INTEGER)" if table == "reviews" else "CAST(rating AS DOUBLE)"
    expressions = _SILVER_COLUMNS | {"rating": rating}
    typed = ", ".join(f"{expressions.get(c, c)} AS {c}" for c in [key, *rest])
    return (
        f"SELECT * FROM (SELECT {typed} FROM raw_{table}) QUALIFY row_number() OVER "
        f"(PARTITION BY {key} ORDER BY {', '.join(rest)}) = 1"
    )


def _silver(t: Tables, table: str) -> DataFrame:
    return tw.transform_frames(t.spark, shop.silver(table), {None: raw(t, table)})


def _register_silver(table: str) -> None:
    @query(f"silver_{table}", with_raw(table, _silver_sql(table)))
    def _(t):
        return plain_timestamps(_silver(t, table))


for _table in shop.COLUMNS:
    _register_bronze(_table)
    _register_silver(_table)


# --- gold --------------------------------------------------------------------------------


def _gold(t: Tables, name: str) -> DataFrame:
    config = shop.builds()[f"gold_{name}"]
    aliases = [entry["alias"] for entry in config["extraction"]["inputs"]]
    frames = {alias: _silver(t, alias) for alias in aliases}
    return plain_timestamps(tw.transform_frames(t.spark, config, frames))


def _gold_sql(tables: str, body: str) -> str:
    silver = ", ".join(f"{name} AS ({_silver_sql(name)})" for name in tables.split())
    return with_raw(tables, "").rstrip() + f", {silver} {body}"


_PERFORMANCE_SQL = _gold_sql("products order_items events reviews", """
    SELECT p.product_id, product_name, category, brand, price, p.rating AS catalog_rating,
           coalesce(units_sold, 0) AS units_sold, round(coalesce(gross_sales, 0), 2) AS gross_sales,
           coalesce(order_count, 0) AS order_count, coalesce(event_count, 0) AS event_count,
           coalesce(active_user_count, 0) AS active_user_count,
           coalesce(review_count, 0) AS review_count, round(avg_review_rating, 6) AS avg_review_rating
    FROM products AS p
    LEFT JOIN (SELECT product_id, CAST(sum(quantity) AS BIGINT) AS units_sold,
                      sum(item_total) AS gross_sales, count(DISTINCT order_id) AS order_count
               FROM order_items GROUP BY ALL) AS s ON s.product_id = p.product_id
    LEFT JOIN (SELECT product_id, count(*) AS event_count,
                      count(DISTINCT user_id) AS active_user_count
               FROM events GROUP BY ALL) AS a ON a.product_id = p.product_id
    LEFT JOIN (SELECT product_id, count(*) AS review_count, avg(rating) AS avg_review_rating
               FROM reviews GROUP BY ALL) AS f ON f.product_id = p.product_id""")


@query("gold_dim_users", _gold_sql("users", "SELECT * FROM users"))
def _(t):
    return _gold(t, "dim_users")


@query("gold_dim_products", _gold_sql("products", "SELECT * FROM products"))
def _(t):
    return _gold(t, "dim_products")


@query("gold_fact_orders", _gold_sql("orders users", """
    SELECT order_id, o.user_id, order_date, CAST(order_date AS DATE) AS order_day, order_status,
           total_amount, city AS user_city, gender AS user_gender
    FROM orders AS o LEFT JOIN users AS u ON o.user_id = u.user_id"""))
def _(t):
    return _gold(t, "fact_orders")


@query("gold_fact_order_items", _gold_sql("order_items orders products", """
    SELECT order_item_id, i.order_id, i.product_id, i.user_id, order_date,
           CAST(order_date AS DATE) AS order_day, order_status, quantity, item_price, item_total,
           category, brand
    FROM order_items AS i LEFT JOIN orders AS o ON i.order_id = o.order_id
    LEFT JOIN products AS p ON i.product_id = p.product_id"""))
def _(t):
    return _gold(t, "fact_order_items")


_FACT_EVENTS_SQL = _gold_sql("events products users", """
    SELECT event_id, e.user_id, e.product_id, event_type, event_timestamp,
           CAST(event_timestamp AS DATE) AS event_date, city AS user_city, category, brand
    FROM events AS e LEFT JOIN users AS u ON e.user_id = u.user_id
    LEFT JOIN products AS p ON e.product_id = p.product_id""")


@query("gold_fact_events", _FACT_EVENTS_SQL)
def _(t):
    return _gold(t, "fact_events")


@query("gold_external_table", _FACT_EVENTS_SQL)
def _(t):
    """The event facts stored by day and read through their external table."""
    base = fresh_path(t.spark, "gold")
    schema = "tablewright_" + base.rsplit("-", 1)[1]
    config = shop.builds()["gold_fact_events"]
    frames = {alias: _silver(t, alias) for alias in ("events", "products", "users")}
    facts = tw.with_audit_columns(tw.transform_frames(t.spark, config, frames))
    tw.write_parquet(
        facts, f"{base}/fact_events", unique_run=False, partition_cols=["event_date"]
    )
    tw.create_gold_tables(t.spark, base, schema)
    tw.sync_partitions(t.spark, schema, ["fact_events"])
    stored = t.spark.table(f"{schema}.fact_events").select(*shop.FACT_EVENTS)
    read = stage(plain_timestamps(stored), "stored")
    t.spark.sql(f"DROP SCHEMA {schema} CASCADE")
    return read


@query("gold_daily_sales", _gold_sql("orders order_items", """
    SELECT CAST(order_date AS DATE) AS order_day, count(DISTINCT o.order_id) AS order_count,
           count(order_item_id) AS order_item_count
    FROM orders AS o LEFT JOIN order_items AS i ON o.order_id = i.order_id
    GROUP BY CAST(order_date AS DATE)"""))
def _(t):
    return _gold(t, "daily_sales")


def product_performance(t: Tables) -> DataFrame:
    """The flagship: catalogue, sales, activity and reviews of every product."""
    return rounded(
        rounded(_gold(t, "product_performance"), 2, "gross_sales"), 6, "avg_review_rating"
    )


@query("gold_product_performance", _PERFORMANCE_SQL)
def _(t):
    return product_performance(t)


@query("preview_topk", f"""
    SELECT product_id, gross_sales, units_sold FROM ({_PERFORMANCE_SQL})
    ORDER BY gross_sales DESC, product_id LIMIT 10""")
def _(t):
    ranked = tw.sort_rows(product_performance(t), ["gross_sales", "product_id"], [False, True])
    return ranked.select("product_id", "gross_sales", "units_sold").limit(10)


@query("medallion_end_to_end", _PERFORMANCE_SQL)
def _(t):
    """CSV files to bronze to silver to the stored product table, all through storage."""
    base = fresh_path(t.spark, "warehouse")
    tables = ["products", "order_items", "events", "reviews"]
    for table in tables:
        _write_csv(t, table, base)
    wanted = [f"{layer}_{table}" for layer in ("bronze", "silver") for table in tables]
    runs = tw.run_warehouse(t.spark, base, "suite", only=[*wanted, "gold_product_performance"])
    stored = tw.read_parquet(t.spark, runs["gold_product_performance"].path)
    stored = stored.where(F.col("etl_run_id") == "suite").select(*shop.PRODUCT_PERFORMANCE)
    return rounded(rounded(stored, 2, "gross_sales"), 6, "avg_review_rating")


@query("gold_partition_removal", f"""
    SELECT * FROM ({_FACT_EVENTS_SQL}) WHERE event_date <> (
        SELECT min(CAST(event_timestamp AS DATE)) FROM ({_gold_sql("events", "SELECT * FROM events")}))""")
def _(t):
    """The external table after the folder of its first day is gone."""
    base = fresh_path(t.spark, "gold")
    schema = "tablewright_" + base.rsplit("-", 1)[1]
    config = shop.builds()["gold_fact_events"]
    frames = {alias: _silver(t, alias) for alias in ("events", "products", "users")}
    facts = tw.with_audit_columns(tw.transform_frames(t.spark, config, frames))
    tw.write_parquet(facts, f"{base}/fact_events", unique_run=False, partition_cols=["event_date"])
    tw.create_gold_tables(t.spark, base, schema)
    tw.sync_partitions(t.spark, schema, ["fact_events"])
    first = t.spark.table(f"{schema}.fact_events").agg(F.min("event_date")).head()[0]
    folder = t.spark._jvm.org.apache.hadoop.fs.Path(f"{base}/fact_events/event_date={first}")
    folder.getFileSystem(t.spark._jsc.hadoopConfiguration()).delete(folder, True)
    tw.sync_partitions(t.spark, schema, ["fact_events"])
    left = t.spark.table(f"{schema}.fact_events").select(*shop.FACT_EVENTS)
    read = stage(plain_timestamps(left), "stored")
    t.spark.sql(f"DROP SCHEMA {schema} CASCADE")
    return read


@query("input_counts", """
    SELECT 'o' AS alias, count(*) AS n FROM orders UNION ALL
    SELECT 'c', count(*) FROM customer UNION ALL
    SELECT 'output', count(*) FROM orders JOIN customer ON o_custkey = c_custkey""")
def _(t):
    """Rows counted by the write job; an input the statement names twice counts once."""
    listed = [
        {"alias": alias, "input_prefix": f"{t.folder}/{name}.parquet"}
        for alias, name in (("o", "orders"), ("c", "customer"))
    ]
    sql = """
        SELECT o.o_orderkey FROM o JOIN c ON o.o_custkey = c.c_custkey
        LEFT JOIN (SELECT o_custkey, max(o_orderkey) AS last FROM o GROUP BY o_custkey) AS n
          ON n.o_custkey = o.o_custkey"""
    config = {
        "extraction": {"inputs": listed}, "transformation": {"sql": sql},
        "loading": {"output_prefix": fresh_path(t.spark, "counted"), "partition_cols": [], "unique_run": False},
    }
    result = tw.run_pipeline(t.spark, config, count_inputs=True)
    rows = [*result.input_rows.items(), ("output", result.output_rows)]
    return t.spark.createDataFrame(rows, "alias string, n long")
