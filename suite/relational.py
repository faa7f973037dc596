"""Joins, aggregation, pivots and SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

import tablewright as tw
from suite.registry import query, rounded
from tablewright.plans.sql import run_sql
from tablewright.plans.steps import apply_steps

_BOTH = ("left", "right")
_PRODUCT = "CAST(json_extract_string(props, '$.k') AS bigint) AS product"


def _events(t):
    """Events with the product number from their properties; product 0..99."""
    return t["events"].selectExpr(
        "event_id", "event_type", "CAST(get_json_object(props, '$.k') AS bigint) AS product"
    )


def _parts(t):
    return t["part"].select("p_partkey", "p_brand")


_EVENT_PART = f"""
    SELECT event_id, event_type, product, p_partkey, p_brand
    FROM (SELECT event_id, event_type, {_PRODUCT} FROM events) AS e
    {{}} JOIN part ON product = p_partkey"""
_ORDER_LINE = """
    SELECT o_orderkey, o_orderstatus, l_orderkey, l_linenumber, l_quantity
    FROM orders {} JOIN lineitem ON o_orderkey = l_orderkey"""


def _orders(t):
    return t["orders"].select("o_orderkey", "o_orderstatus")


def _lines(t):
    return t["lineitem"].select("l_orderkey", "l_linenumber", "l_quantity")


# --- joins -------------------------------------------------------------------------------


@query("join_inner", _ORDER_LINE.format("INNER"))
def _(t):
    return tw.join_dataframes(_orders(t), _lines(t), ["o_orderkey"], ["l_orderkey"])


@query("join_left", _ORDER_LINE.format("LEFT"))
def _(t):
    return tw.join_dataframes(_orders(t), _lines(t), "o_orderkey", "l_orderkey", "left")


@query("join_right", _EVENT_PART.format("RIGHT"))
def _(t):
    return tw.join_dataframes(_events(t), _parts(t), "product", "p_partkey", "right")


@query("join_full", _EVENT_PART.format("FULL"))
def _(t):
    return tw.join_dataframes(_events(t), _parts(t), "product", "p_partkey", "full")


@query("join_left_semi", "SELECT o_orderkey, o_orderstatus FROM orders "
       "WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)")
def _(t):
    return tw.join_dataframes(_orders(t), _lines(t), "o_orderkey", "l_orderkey", "left_semi")


@query("join_left_anti", "SELECT o_orderkey, o_orderstatus FROM orders "
       "WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)")
def _(t):
    return tw.join_dataframes(_orders(t), _lines(t), "o_orderkey", "l_orderkey", "left_anti")


@query("join_multi_key", """
    SELECT l_orderkey, l_linenumber, l_quantity, copies
    FROM lineitem JOIN (SELECT l_orderkey AS k, l_linenumber AS n, count(*) AS copies
                        FROM lineitem GROUP BY ALL) ON l_orderkey = k AND l_linenumber = n""")
def _(t):
    counted = _lines(t).groupBy("l_orderkey", "l_linenumber").agg(F.count("*").alias("copies"))
    return tw.join_dataframes(
        _lines(t), counted, ["l_orderkey", "l_linenumber"], suffixes=("", "_counted")
    ).drop("l_orderkey_counted", "l_linenumber_counted")


@query("join_broadcast", """
    SELECT l_orderkey, l_linenumber, l_suppkey, s_name
    FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey""")
def _(t):
    lines = t["lineitem"].select("l_orderkey", "l_linenumber", "l_suppkey")
    suppliers = t["supplier"].select("s_suppkey", "s_name")
    joined = tw.broadcast_join_dataframes(lines, suppliers, "l_suppkey", "s_suppkey", "left")
    return joined.drop("s_suppkey")


@query("join_cross", """
    SELECT month, r_name FROM region
    CROSS JOIN (SELECT DISTINCT strftime(o_orderdate, '%Y-%m') AS month FROM orders)""")
def _(t):
    """A dense month-by-region grid; months come from all orders, regions are a fixed few."""
    months = t["orders"].select(F.date_format("o_orderdate", "yyyy-MM").alias("month")).distinct()
    return tw.cross_join_dataframes(months, t["region"].select("r_name"))


@query("join_aliased", """
    SELECT o_orderkey AS order_key, c_name AS customer, o_totalprice AS price
    FROM orders JOIN customer ON o_custkey = c_custkey""")
def _(t):
    joined = tw.join_with_aliases(
        t["orders"], t["customer"], "o", "c", ["o_custkey"], ["c_custkey"]
    )
    return joined.selectExpr(
        "o.o_orderkey AS order_key", "c.c_name AS customer", "o.o_totalprice AS price"
    )


@query("join_self", "SELECT o_orderkey AS order_key, o_totalprice AS price, o_orderstatus AS status "
       "FROM orders")
def _(t):
    joined = tw.self_join(t["orders"], ["o_orderkey"])
    return joined.selectExpr(
        "left.o_orderkey AS order_key", "left.o_totalprice AS price",
        "right.o_orderstatus AS status",
    )


@query("join_hot_inner", """
    SELECT l_orderkey, l_linenumber, l_suppkey, s_suppkey, s_name
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey""")
def _(t):
    lines = t["lineitem"].select("l_orderkey", "l_linenumber", "l_suppkey")
    suppliers = t["supplier"].select("s_suppkey", "s_name")
    return tw.join_dataframes(
        lines, suppliers, "l_suppkey", "s_suppkey", hot_rows=250, hot_sides=_BOTH
    )


@query("join_hot_full", _EVENT_PART.format("FULL"))
def _(t):
    return tw.join_dataframes(
        _events(t), _parts(t), "product", "p_partkey", "full", hot_rows=90, hot_sides=_BOTH
    )


# --- aggregation -------------------------------------------------------------------------


@query("agg_group", """
    SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS l_quantity_sum,
           round(avg(l_extendedprice), 6) AS l_extendedprice_avg,
           min(l_discount) AS l_discount_min, max(l_tax) AS l_tax_max,
           count(l_orderkey) AS l_orderkey_count
    FROM lineitem GROUP BY ALL""")
def _(t):
    result = tw.aggregate_data(
        t["lineitem"],
        ["l_returnflag", "l_linestatus"],
        {
            "l_quantity": "sum", "l_extendedprice": "avg", "l_discount": "min", "l_tax": "max",
            "l_orderkey": "count",
        },
    )
    return rounded(rounded(result, 2, "l_quantity_sum"), 6, "l_extendedprice_avg")


_STATS = """
    SELECT l_returnflag, round(stddev_samp(l_quantity), 6) AS l_quantity_stddev,
           round(median(l_extendedprice), 6) AS l_extendedprice_median
    FROM lineitem GROUP BY ALL"""
_STATS_WANTED = {"l_quantity": "stddev", "l_extendedprice": "median"}


@query("agg_stats", _STATS)
def _(t):
    result = tw.aggregate_data(t["lineitem"], ["l_returnflag"], _STATS_WANTED)
    return rounded(result, 6, "l_quantity_stddev", "l_extendedprice_median")


@query("agg_stats_hot", _STATS)
def _(t):
    """As agg_stats, with every group too big for one task."""
    result = tw.aggregate_data(t["lineitem"], ["l_returnflag"], _STATS_WANTED, hot_rows=1000)
    return rounded(result, 6, "l_quantity_stddev", "l_extendedprice_median")


@query("agg_mode", """
    SELECT l_returnflag, l_quantity AS l_quantity_mode FROM (
        SELECT l_returnflag, l_quantity, row_number() OVER (
            PARTITION BY l_returnflag ORDER BY count(*) DESC, l_quantity DESC) AS place
        FROM lineitem GROUP BY l_returnflag, l_quantity) WHERE place = 1""")
def _(t):
    return tw.aggregate_data(t["lineitem"], ["l_returnflag"], {"l_quantity": "mode"})


@query("agg_distinct", """
    SELECT o_orderstatus, count(DISTINCT o_custkey) AS o_custkey_count_distinct,
           count(DISTINCT o_orderdate) AS o_orderdate_count_distinct
    FROM orders GROUP BY ALL""")
def _(t):
    wanted = {"o_custkey": "count_distinct", "o_orderdate": "count_distinct"}
    return tw.aggregate_data(t["orders"], ["o_orderstatus"], wanted)


@query("agg_approx_distinct", """
    SELECT o_orderstatus, count(DISTINCT o_custkey) AS o_custkey_count_distinct, true AS within
    FROM orders GROUP BY o_orderstatus""")
def _(t):
    """The estimate is within a sixth of the exact count, three times its standard error."""
    wanted = {"o_custkey": ["approx_count_distinct", "count_distinct"]}
    counted = tw.aggregate_data(t["orders"], ["o_orderstatus"], wanted)
    exact, estimate = F.col("o_custkey_count_distinct"), F.col("o_custkey_approx_count_distinct")
    within = F.abs(estimate - exact) <= exact / 6
    return counted.select("o_orderstatus", "o_custkey_count_distinct", within.alias("within"))


@query("join_hot_semi", """
    SELECT l_orderkey, l_linenumber, l_returnflag FROM lineitem
    WHERE l_returnflag IN (SELECT l_returnflag FROM lineitem WHERE l_linestatus = 'O')""")
def _(t):
    """Few, very frequent keys on both sides."""
    lines = t["lineitem"].select("l_orderkey", "l_linenumber", "l_returnflag")
    open_flags = tw.filter_rows(t["lineitem"], "l_linestatus = 'O'").select(F.col("l_returnflag").alias("flag"))
    return tw.join_dataframes(lines, open_flags, "l_returnflag", "flag", "left_semi", hot_rows=100)


@query("join_hot_anti", """
    SELECT o_orderkey, o_orderstatus FROM orders
    WHERE o_orderstatus NOT IN (SELECT o_orderstatus FROM orders WHERE o_orderstatus <> 'P')""")
def _(t):
    orders = t["orders"].select("o_orderkey", "o_orderstatus")
    closed = tw.filter_rows(t["orders"], "o_orderstatus <> 'P'").select(F.col("o_orderstatus").alias("s"))
    return tw.join_dataframes(orders, closed, "o_orderstatus", "s", "left_anti", hot_rows=100)


@query("join_null_full", """
    SELECT o_orderkey, nullif(o_custkey % 3, 0) AS k, c_custkey
    FROM orders FULL JOIN (SELECT c_custkey, nullif(c_custkey % 1000, 0) AS j FROM customer) AS c
      ON nullif(o_custkey % 3, 0) = j""")
def _(t):
    """A third of the left keys are NULL, and the others are hot."""
    orders = t["orders"].selectExpr("o_orderkey", "nullif(o_custkey % 3, 0) AS k")
    customers = t["customer"].selectExpr("c_custkey", "nullif(c_custkey % 1000, 0) AS j")
    return tw.join_dataframes(orders, customers, "k", "j", "full", hot_rows=500).drop("j")


@query("pivot_sum", """
    SELECT o_orderpriority, round(sum(o_totalprice) FILTER (o_orderstatus = 'F'), 2) AS "F",
           round(sum(o_totalprice) FILTER (o_orderstatus = 'O'), 2) AS "O",
           round(sum(o_totalprice) FILTER (o_orderstatus = 'P'), 2) AS "P"
    FROM orders GROUP BY ALL""")
def _(t):
    pivoted = tw.pivot_data(t["orders"], ["o_orderpriority"], "o_orderstatus", "o_totalprice")
    return rounded(pivoted, 2, "F", "O", "P")


@query("pivot_count", """
    SELECT user_id, nullif(count(value) FILTER (event_type = 'click'), 0) AS click,
           nullif(count(value) FILTER (event_type = 'purchase'), 0) AS purchase,
           nullif(count(value) FILTER (event_type = 'signup'), 0) AS signup,
           nullif(count(value) FILTER (event_type = 'view'), 0) AS view,
           nullif(count(value) FILTER (event_type = 'error'), 0) AS "null"
    FROM events GROUP BY ALL""")
def _(t):
    events = t["events"].selectExpr("user_id", "nullif(event_type, 'error') AS kind", "value")
    return tw.pivot_data(events, ["user_id"], "kind", "value", "count")


@query("total_sum", "SELECT round(sum(l_quantity), 2) AS l_quantity_sum FROM lineitem")
def _(t):
    return rounded(tw.sum(t["lineitem"], "l_quantity"), 2, "l_quantity_sum")


@query("total_avg", "SELECT round(avg(l_extendedprice), 4) AS l_extendedprice_avg FROM lineitem")
def _(t):
    return rounded(tw.avg(t["lineitem"], "l_extendedprice"), 4, "l_extendedprice_avg")


@query("total_min", "SELECT min(l_shipdate) AS l_shipdate_min FROM lineitem")
def _(t):
    return tw.min(t["lineitem"], "l_shipdate")


@query("total_max", "SELECT max(o_totalprice) AS o_totalprice_max FROM orders")
def _(t):
    return tw.max(t["orders"], "o_totalprice")


# --- SQL and step chains -----------------------------------------------------------------

_SQL_STEP = """
SELECT o_orderstatus AS status, o_orderpriority AS priority, count(*) AS n
FROM orders GROUP BY GROUPING SETS ((o_orderstatus, o_orderpriority), (o_orderstatus), ())
UNION ALL
SELECT 'unused customer', NULL, count(*)
FROM (SELECT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders) AS unused
"""


@query("sql_step", _SQL_STEP)
def _(t):
    return run_sql(t.spark, {"orders": t["orders"], "customer": t["customer"]}, _SQL_STEP)


@query("step_chain", """
    SELECT c_custkey AS id, upper(trim(c_name)) AS customer_name,
           coalesce(nullif(lower(c_mktsegment), 'building'), 'none') AS segment,
           CAST(trunc(c_acctbal) AS integer) AS balance
    FROM customer WHERE c_acctbal > 0 AND c_nationkey < 20""")
def _(t):
    customers = t["customer"].selectExpr(
        "c_custkey AS ` ID`", "concat(' ', c_name, '  ') AS `Customer Name`",
        "nullif(c_mktsegment, 'BUILDING') AS Segment", "CAST(c_acctbal AS string) AS Balance",
        "c_nationkey AS nation",
    )
    return apply_steps(
        customers,
        [
            {"name": "standardize_column_names"},
            {"name": "trim", "columns": ["customer_name"]},
            {"name": "uppercase", "columns": ["customer_name"]},
            {"name": "lowercase", "columns": ["segment"]},
            {"name": "fill_null", "column": "segment", "value": "none"},
            {"name": "filter_rows", "conditions": ["CAST(balance AS double) > 0", "nation < 20"]},
            {"name": "cast_columns", "cast_map": {"balance": "integer"}},
            {"name": "drop_columns", "columns": ["nation"]},
            {"name": "drop_null", "column": "id"},
            {"name": "drop_duplicates", "subset": ["id"], "order_by": ["customer_name"]},
            {"name": "sort_rows", "columns": ["id"], "ascending": False},
        ],
    )
