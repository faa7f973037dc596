"""Projection, naming, casting, filters, nulls and strings."""

from __future__ import annotations

from pyspark.sql import functions as F

import tablewright as tw
from suite.registry import plain_timestamps, query
from suite.shop import raw, with_raw

# --- projection and naming ---------------------------------------------------------------


@query("select_columns", "SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders")
def _(t):
    return tw.select(t["orders"], ["o_orderkey", "o_totalprice", "o_orderstatus"])


@query("drop_columns", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def _(t):
    return tw.drop_columns(t["customer"], ["c_nationkey", "c_acctbal", "no_such_column"])


@query("add_column", "SELECT *, o_totalprice + 10 AS raised, upper(o_orderstatus) AS o_orderpriority "
       "FROM (SELECT * EXCLUDE (o_orderpriority) FROM orders)")
def _(t):
    orders = t["orders"]
    raised = tw.add_column(orders, "raised", tw.col(orders, "o_totalprice") + 10)
    return tw.add_column(raised, "o_orderpriority", "upper(o_orderstatus)")


@query("rename_column", "SELECT s_suppkey AS id, s_name, s_nationkey, s_acctbal FROM supplier")
def _(t):
    return tw.rename_column(t["supplier"], "s_suppkey", "id")


@query("rename_columns", "SELECT c_name AS c_custkey, c_custkey AS c_name, c_nationkey AS nation, "
       "c_acctbal, c_mktsegment FROM customer")
def _(t):
    swap = {"c_custkey": "c_name", "c_name": "c_custkey", "c_nationkey": "nation"}
    return tw.rename_columns(t["customer"], swap, strict=True)


@query("standardize_names", "SELECT p_partkey AS part_key, p_name AS part_name, p_brand FROM part")
def _(t):
    named = t["part"].selectExpr("p_partkey AS ` Part Key `", "p_name AS `PART Name`", "p_brand")
    return tw.standardize_column_names(named)


# --- casting -----------------------------------------------------------------------------

_BAD_DATE = "CASE WHEN user_id LIKE '%7' THEN 'bad' ELSE signup_date END"


@query("convert_date", with_raw("users", f"""
    SELECT user_id, CAST(TRY_STRPTIME({_BAD_DATE}, '%Y-%m-%d') AS DATE) AS signup_date
    FROM raw_users"""))
def _(t):
    users = raw(t, "users").selectExpr("user_id", f"{_BAD_DATE} AS signup_date")
    return tw.convert_column(users, "signup_date", "date", format="yyyy-MM-dd")


_BAD_TIME = "CASE WHEN event_id LIKE '%3' THEN 'bad' ELSE event_timestamp END"


@query("convert_timestamp", with_raw("events", f"""
    SELECT event_id, TRY_CAST({_BAD_TIME} AS TIMESTAMP) AS event_timestamp FROM raw_events"""))
def _(t):
    events = raw(t, "events").selectExpr("event_id", f"{_BAD_TIME} AS event_timestamp")
    return plain_timestamps(tw.convert_column(events, "event_timestamp", "timestamp"))


_BAD_NUMBER = "CASE WHEN product_id LIKE '%5' THEN 'n/a' ELSE item_total END"


@query("convert_number", with_raw("order_items", f"""
    SELECT order_item_id, CAST(trunc(TRY_CAST({_BAD_NUMBER} AS DOUBLE)) AS INTEGER) AS item_total
    FROM raw_order_items"""))
def _(t):
    items = raw(t, "order_items").selectExpr("order_item_id", f"{_BAD_NUMBER} AS item_total")
    return tw.cast_column(items, "item_total", "integer")


@query("cast_columns", with_raw("orders", """
    SELECT order_id, user_id, CAST(order_date AS TIMESTAMP) AS order_date, order_status,
           CAST(total_amount AS DOUBLE) AS total_amount FROM raw_orders"""))
def _(t):
    casts = {"order_date": "datetime", "total_amount": "double"}
    typed = tw.cast_columns(raw(t, "orders"), casts, {"order_date": "yyyy-MM-dd HH:mm:ss"})
    assert tw.type_of(typed, "total_amount") == "double"
    return plain_timestamps(typed)


# --- filters and flags -------------------------------------------------------------------


@query("filter_rows", "SELECT * FROM lineitem WHERE l_quantity > 30 AND l_discount <= 0.05 "
       "AND (l_returnflag = 'R' OR l_linestatus = 'O')")
def _(t):
    conditions = ["l_quantity > 30", "l_discount <= 0.05", "l_returnflag = 'R' OR l_linestatus = 'O'"]
    return tw.filter_rows(t["lineitem"], conditions)


@query("filter_starts_with", "SELECT * FROM part WHERE starts_with(p_name, 'small')")
def _(t):
    return tw.starts_with(t["part"], "p_name", "small")


@query("filter_ends_with", "SELECT * FROM part WHERE suffix(p_name, 'ring')")
def _(t):
    return tw.ends_with(t["part"], "p_name", "ring")


@query("flag_contains", "SELECT doc_id, contains(text, 'the') AS has_the FROM documents")
def _(t):
    flagged = tw.contains_substring_column(t["documents"], "text", "has_the", "the")
    return tw.select(flagged, ["doc_id", "has_the"])


@query("flag_starts_with", "SELECT page_id, url, starts_with(url, 'https://') AS secure FROM pages")
def _(t):
    flagged = tw.starts_with_column(t["pages"], "url", "secure", "https://")
    return tw.drop_columns(flagged, "html")


@query("flag_ends_with", "SELECT conv_id, turn, suffix(text, '.') AS closed FROM conversations")
def _(t):
    flagged = tw.ends_with_column(t["conversations"], "text", "closed", ".")
    return tw.select(flagged, ["conv_id", "turn", "closed"])


_GAPS = "CASE event_type WHEN 'error' THEN NULL WHEN 'view' THEN '' ELSE event_type END"


@query("flag_null_or_empty", f"""
    SELECT event_id, coalesce(kind = '', true) AS missing
    FROM (SELECT event_id, {_GAPS} AS kind FROM events)""")
def _(t):
    events = t["events"].selectExpr("event_id", f"{_GAPS} AS kind")
    return tw.is_null_or_empty_column(events, "kind", "missing").drop("kind")


# --- nulls -------------------------------------------------------------------------------

_NO_ERROR = "nullif(event_type, 'error') AS kind"


@query("drop_null", f"SELECT * FROM (SELECT event_id, {_NO_ERROR} FROM events) WHERE kind IS NOT NULL")
def _(t):
    return tw.drop_null(t["events"].selectExpr("event_id", _NO_ERROR), "kind")


@query("fill_null", f"SELECT event_id, coalesce(kind, 'unknown') AS kind "
       f"FROM (SELECT event_id, {_NO_ERROR} FROM events)")
def _(t):
    return tw.fill_null(t["events"].selectExpr("event_id", _NO_ERROR), "kind", "unknown")


@query("coalesce_column", """
    SELECT c_custkey, coalesce(nullif(c_mktsegment, 'BUILDING'), c_name) AS label FROM customer""")
def _(t):
    parts = t["customer"].selectExpr(
        "c_custkey", "nullif(c_mktsegment, 'BUILDING') AS segment", "c_name"
    )
    return tw.coalesce_column(parts, "label", "segment", "c_name").select("c_custkey", "label")


@query("ifnull_column", f"SELECT event_id, kind, coalesce(kind, 'none') AS kind_filled "
       f"FROM (SELECT event_id, {_NO_ERROR} FROM events)")
def _(t):
    return tw.ifnull_column(t["events"].selectExpr("event_id", _NO_ERROR), "kind_filled", "kind", "none")


# --- strings -----------------------------------------------------------------------------


@query("str_trim", with_raw("products", """
    SELECT product_id, trim(product_name) AS product_name, trim(category) AS category
    FROM raw_products"""))
def _(t):
    products = raw(t, "products").select("product_id", "product_name", "category")
    return tw.trim(products, ["product_name", "category"])


@query("str_lower", "SELECT c_custkey, lower(c_name) AS c_name, lower(c_mktsegment) AS c_mktsegment "
       "FROM customer")
def _(t):
    customers = t["customer"].select("c_custkey", "c_name", "c_mktsegment")
    return tw.lowercase(customers, ["c_name", "c_mktsegment"])


@query("str_upper", "SELECT p_partkey, upper(p_name) AS p_name FROM part")
def _(t):
    return tw.uppercase(t["part"].select("p_partkey", "p_name"), "p_name")


@query("str_map_values_long", """
    SELECT o_orderkey, CASE WHEN o_custkey BETWEEN 1 AND 700 THEN -o_custkey ELSE o_custkey END
           AS o_custkey FROM orders""")
def _(t):
    """A mapping of 700 entries, which is joined instead of written into the plan."""
    negated = {key: -key for key in range(1, 701)}
    return tw.rename_values(t["orders"].select("o_orderkey", "o_custkey"), "o_custkey", negated)


@query("str_map_values", """
    SELECT event_id, CASE event_type WHEN 'view' THEN 'V' WHEN 'click' THEN 'C'
           ELSE event_type END AS event_type FROM events""")
def _(t):
    events = t["events"].select("event_id", "event_type")
    return tw.rename_values(events, "event_type", {"view": "V", "click": "C"})


@query("str_regex_replace", "SELECT doc_id, regexp_replace(text, '[0-9]+', '#', 'g') AS text "
       "FROM documents")
def _(t):
    return tw.replace_substring(t["documents"].select("doc_id", "text"), "text", "[0-9]+", "#")


@query("str_regex_extract", "SELECT page_id, regexp_extract(url, '^https?://([^/]+)/', 1) AS host "
       "FROM pages")
def _(t):
    pages = tw.regex_extract_column(t["pages"], "url", "host", "^https?://([^/]+)/")
    return pages.select("page_id", "host")


@query("str_substring", "SELECT conv_id, turn, substring(text, 3, 12) AS head, "
       "CASE WHEN length(text) < 6 THEN text ELSE substring(text, -6, 6) END AS tail "
       "FROM conversations")
def _(t):
    """The last six characters; of a shorter text all of it."""
    head = tw.substring_column(t["conversations"], "text", "head", 3, 12)
    return tw.substring_column(head, "text", "tail", -6, 6).select("conv_id", "turn", "head", "tail")


@query("str_split", "SELECT page_id, str_split(url, '/')[1] AS scheme, str_split(url, '/')[3] AS host, "
       "str_split(url, '/')[9] AS deep FROM pages")
def _(t):
    names = ["scheme", "gap", "host", "a", "b", "c", "d", "e", "deep"]
    parts = tw.split_column(t["pages"], "url", names, separator="/")
    return parts.select("page_id", "scheme", "host", "deep")


@query("str_concat", "SELECT c_custkey, concat_ws('-', c_name, nullif(c_mktsegment, 'BUILDING'), "
       "c_nationkey) AS label FROM customer")
def _(t):
    customers = t["customer"].withColumn("segment", F.expr("nullif(c_mktsegment, 'BUILDING')"))
    label = tw.concat_columns(customers, ["c_name", "segment", "c_nationkey"], "label", "-")
    return label.select("c_custkey", "label")


@query("str_mask", "SELECT page_id, repeat('*', greatest(length(url) - 4, 0)) || right(url, 4) AS masked "
       "FROM pages")
def _(t):
    return tw.mask_column(t["pages"], "url", "masked").select("page_id", "masked")


@query("str_remove_special", "SELECT doc_id, regexp_replace(text, '[^a-zA-Z0-9]', '', 'g') AS plain "
       "FROM documents")
def _(t):
    cleaned = tw.remove_special_characters_column(t["documents"], "text", "plain")
    return cleaned.select("doc_id", "plain")
