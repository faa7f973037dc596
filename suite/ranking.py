"""Windows, sort, top-k and deduplication."""

from __future__ import annotations

import tablewright as tw
from suite.registry import query

_ORDERS = ["o_orderkey", "o_custkey", "o_orderdate", "o_totalprice"]
_BY_DATE = [("o_orderdate", True), "o_orderkey"]
_EVENTS = ["event_id", "user_id", "event_type", "value"]
_BY_VALUE = [["value", False], "event_id"]
_LINES = ["l_orderkey", "l_linenumber", "l_returnflag", "l_quantity"]


def _sql(columns: list[str], table: str, **window_columns: str) -> str:
    computed = ", ".join(f"{text} AS {name}" for name, text in window_columns.items())
    return f"SELECT {', '.join(columns)}, {computed} FROM {table}"


def _orders(t):
    return t["orders"].select(*_ORDERS)


def _events(t):
    return t["events"].select(*_EVENTS)


def _lines(t):
    return t["lineitem"].select(*_LINES)


_CUSTOMER = "OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)"
_GLOBAL = "OVER (ORDER BY value DESC, event_id)"
_KIND = "OVER (PARTITION BY event_type ORDER BY value DESC, event_id)"
_FLAG = "OVER (PARTITION BY l_returnflag ORDER BY l_quantity DESC)"
_QUANTITY = "OVER (ORDER BY l_quantity)"


# --- per group ---------------------------------------------------------------------------


@query("win_lag", _sql(_ORDERS, "orders", o_totalprice_lag_1=f"lag(o_totalprice) {_CUSTOMER}"))
def _(t):
    return tw.lag(_orders(t), "o_totalprice", _BY_DATE, ["o_custkey"])


@query("win_lead", _sql(_ORDERS, "orders", following=f"lead(o_totalprice, 2, -1.0) {_CUSTOMER}"))
def _(t):
    return tw.lead(
        _orders(t), "o_totalprice", _BY_DATE, ["o_custkey"], 2, -1.0, target_column="following"
    )


@query("win_row_number", _sql(_ORDERS, "orders", row_number=f"row_number() {_CUSTOMER}"))
def _(t):
    return tw.row_number(_orders(t), _BY_DATE, ["o_custkey"])


@query("win_rank", _sql(_LINES, "lineitem", rank=f"rank() {_FLAG}"))
def _(t):
    return tw.rank(_lines(t), [("l_quantity", False)], ["l_returnflag"])


@query("win_dense_rank", _sql(_LINES, "lineitem", dense_rank=f"dense_rank() {_FLAG}"))
def _(t):
    return tw.dense_rank(_lines(t), [("l_quantity", False)], ["l_returnflag"])


@query("win_ntile", _sql(_ORDERS, "orders", ntile=f"ntile(4) {_CUSTOMER}"))
def _(t):
    return tw.ntile(_orders(t), _BY_DATE, ["o_custkey"])


# --- over the whole table ----------------------------------------------------------------


@query("win_row_number_global", _sql(_EVENTS, "events", row_number=f"row_number() {_GLOBAL}"))
def _(t):
    return tw.row_number(_events(t), _BY_VALUE)


@query("win_rank_global", _sql(_LINES, "lineitem", rank=f"rank() {_QUANTITY}"))
def _(t):
    return tw.rank(_lines(t), ["l_quantity"])


@query("win_dense_rank_global", _sql(_LINES, "lineitem", dense_rank=f"dense_rank() {_QUANTITY}"))
def _(t):
    return tw.dense_rank(_lines(t), ["l_quantity"])


@query("win_ntile_global", _sql(_EVENTS, "events", ntile=f"ntile(7) {_GLOBAL}"))
def _(t):
    return tw.ntile(_events(t), _BY_VALUE, num_buckets=7)


@query("win_lag_global", _sql(_EVENTS, "events", value_lag_3=f"lag(value, 3) {_GLOBAL}"))
def _(t):
    return tw.lag(_events(t), "value", _BY_VALUE, offset=3)


@query("win_lead_global", _sql(_EVENTS, "events", value_lead_1=f"lead(value, 1, 0.0) {_GLOBAL}"))
def _(t):
    return tw.lead(_events(t), "value", _BY_VALUE, default_value=0.0)


# --- groups too big for one task ---------------------------------------------------------


@query("win_row_number_hot", _sql(_EVENTS, "events", row_number=f"row_number() {_KIND}"))
def _(t):
    return tw.row_number(_events(t), _BY_VALUE, ["event_type"], hot_rows=2000)


@query("win_rank_hot", _sql(_LINES, "lineitem", rank=f"rank() {_FLAG}"))
def _(t):
    return tw.rank(_lines(t), [("l_quantity", False)], ["l_returnflag"], hot_rows=2000)


@query("win_lag_hot", _sql(_EVENTS, "events", value_lag_1=f"lag(value) {_KIND}"))
def _(t):
    return tw.lag(_events(t), "value", _BY_VALUE, ["event_type"], hot_rows=2000)


# --- sort, top-k, deduplication ----------------------------------------------------------


@query("sort_rows", "SELECT * FROM lineitem ORDER BY l_shipdate DESC NULLS LAST, l_quantity NULLS FIRST")
def _(t):
    return tw.sort_rows(t["lineitem"], ["l_shipdate", "l_quantity"], ascending=[False, True])


@query("dedup_rows", "SELECT DISTINCT l_partkey, l_suppkey, l_returnflag FROM lineitem")
def _(t):
    return tw.drop_duplicates(t["lineitem"].select("l_partkey", "l_suppkey", "l_returnflag"))


_LINE_REST = [
    "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus", "l_shipdate",
]


@query("dedup_by_key", f"""
    SELECT l_orderkey, l_linenumber, {', '.join(_LINE_REST)} FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                               ORDER BY {', '.join(_LINE_REST)}) = 1""")
def _(t):
    lines = t["lineitem"].select("l_orderkey", "l_linenumber", *_LINE_REST)
    return tw.drop_duplicates(lines, ["l_orderkey", "l_linenumber"], order_by=_LINE_REST)
