"""Shop tables in raw (all text) form, derived from the supplied tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from suite.registry import Tables
from tablewright.plans.sql import run_sql

# One statement per table; the words in braces differ between Spark and DuckDB.
_RAW = {
    "users": (
        "customer nation",
        """
        SELECT concat('U', c_custkey) AS user_id, c_name AS name,
               concat('user', c_custkey, '@example.com') AS email,
               CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender, n_name AS city,
               {signup} AS signup_date
        FROM customer JOIN nation ON c_nationkey = n_nationkey
        """,
    ),
    "products": (
        "part",
        """
        SELECT concat('P', p_partkey) AS product_id, concat('  ', p_name, ' ') AS product_name,
               p_type AS category, p_brand AS brand, CAST(p_retailprice AS {text}) AS price,
               CAST(CAST(p_size % 5 + 1 AS double) AS {text}) AS rating
        FROM part
        """,
    ),
    "orders": (
        "orders",
        """
        SELECT concat('O', o_orderkey) AS order_id, concat('U', o_custkey) AS user_id,
               {order_time} AS order_date, o_orderstatus AS order_status,
               CAST(o_totalprice AS {text}) AS total_amount
        FROM orders
        """,
    ),
    "order_items": (
        "lineitem orders part",
        """
        SELECT concat('I', l_orderkey, '-', l_linenumber) AS order_item_id,
               concat('O', l_orderkey) AS order_id, concat('P', l_partkey) AS product_id,
               concat('U', o_custkey) AS user_id,
               CAST(CAST(l_quantity AS int) AS {text}) AS quantity,
               CAST(p_retailprice AS {text}) AS item_price,
               CAST(l_extendedprice AS {text}) AS item_total
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
        """,
    ),
    "events": (
        "events",
        """
        SELECT concat('E', event_id) AS event_id, concat('U', user_id) AS user_id,
               concat('P', {product}) AS product_id, event_type,
               {event_time} AS event_timestamp
        FROM events
        """,
    ),
    "reviews": (
        "events",
        """
        SELECT concat('R', event_id) AS review_id, concat('P', {product}) AS product_id,
               CAST(CAST(floor(value) AS bigint) % 5 + 1 AS {text}) AS rating,
               {event_time} AS review_date
        FROM events WHERE event_type = 'purchase'
        """,
    ),
}

_SPARK = {
    "text": "string",
    "signup": "date_format(date_add(DATE'2020-01-01', CAST(c_custkey % 1000 AS int)), "
    "'yyyy-MM-dd')",
    "order_time": "date_format(o_orderdate, 'yyyy-MM-dd HH:mm:ss')",
    "event_time": "date_format(ts, 'yyyy-MM-dd HH:mm:ss')",
    "product": "get_json_object(props, '$.k')",
}
_DUCKDB = {
    "text": "varchar",
    "signup": "strftime(DATE '2020-01-01' + CAST(c_custkey % 1000 AS int), '%Y-%m-%d')",
    "order_time": "strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')",
    "event_time": "strftime(ts, '%Y-%m-%d %H:%M:%S')",
    "product": "json_extract_string(props, '$.k')",
}


def raw(tables: Tables, name: str) -> DataFrame:
    """One raw shop table."""
    sources, statement = _RAW[name]
    frames = {source: tables[source] for source in sources.split()}
    return run_sql(tables.spark, frames, statement.format(**_SPARK))


def raw_sql(name: str) -> str:
    """The raw shop table as DuckDB SQL."""
    return _RAW[name][1].format(**_DUCKDB)


def with_raw(names: str, body: str) -> str:
    """DuckDB SQL in which ``raw_<name>`` are the raw shop tables."""
    parts = [f"raw_{name} AS ({raw_sql(name)})" for name in names.split()]
    return f"WITH {', '.join(parts)} {body}"
