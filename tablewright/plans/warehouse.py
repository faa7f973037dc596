"""The shop warehouse: CSV files to bronze, cleaned silver and joined or summed gold tables.

Every build is a plain configuration for ``run_pipeline``. Deduplication is ordered by all
other columns of a table, so reruns keep the same rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import SparkSession

from tablewright.plans.run import RunResult, run_pipeline

Config = dict[str, Any]

# Tables, their columns (key first), and the casts and trims of the silver layer.
COLUMNS = {
    "users": ["user_id", "name", "email", "gender", "city", "signup_date"],
    "products": ["product_id", "product_name", "category", "brand", "price", "rating"],
    "orders": ["order_id", "user_id", "order_date", "order_status", "total_amount"],
    "order_items": [
        "order_item_id", "order_id", "product_id", "user_id", "quantity", "item_price", "item_total",
    ],
    "events": ["event_id", "user_id", "product_id", "event_type", "event_timestamp"],
    "reviews": ["review_id", "product_id", "rating", "review_date"],
}
CASTS = {
    "users": {"signup_date": "date"},
    "products": {"price": "double", "rating": "double"},
    "orders": {"order_date": "timestamp", "total_amount": "double"},
    "order_items": {"quantity": "integer", "item_price": "double", "item_total": "double"},
    "events": {"event_timestamp": "timestamp"},
    "reviews": {"rating": "integer", "review_date": "timestamp"},
}
PATTERNS = {"users": {"signup_date": "yyyy-MM-dd"}}
TRIMMED = {"products": ["product_name", "category", "brand"]}

_CSV_OPTIONS = {
    "header": True, "inferSchema": False, "multiLine": False, "escape": '"', "quote": '"',
}


def _build(name: str, extraction: Config, transformation: Config, output: str,
           partition_cols: Sequence[str], depends_on: Sequence[str] = ()) -> Config:
    return {
        "pipeline": {
            "name": name, "schedule": "@daily", "enabled": True, "depends_on": list(depends_on),
        },
        "extraction": extraction,
        "transformation": transformation,
        "loading": {
            "output_prefix": output,
            "partition_cols": list(partition_cols),
            "unique_run": False,
        },
    }


def _unique(columns: Sequence[str]) -> Config:
    key, *rest = columns
    return {"name": "drop_duplicates", "subset": [key], "order_by": rest}


def bronze(table: str) -> Config:
    """Raw CSV, all text, stored as Parquet."""
    source = {
        "input_prefix": f"ecommerce_dataset/{table}.csv",
        "format": "csv",
        "options": _CSV_OPTIONS,
    }
    return _build(f"bronze_{table}", source, {"steps": []}, f"bronze/{table}", [])


def silver(table: str) -> Config:
    """Clean names, trimmed text, real types, one row per key."""
    steps: list[Config] = [{"name": "standardize_column_names"}]
    if table in TRIMMED:
        steps.append({"name": "trim", "columns": TRIMMED[table]})
    cast = {"name": "cast_columns", "cast_map": CASTS[table]}
    if table in PATTERNS:
        cast["format_map"] = PATTERNS[table]
    steps += [cast, _unique(COLUMNS[table])]
    source = {"input_prefix": f"bronze/{table}", "format": "parquet", "options": {}}
    return _build(
        f"silver_{table}", source, {"steps": steps}, f"silver/{table}", ["etl_run_date"],
        [f"bronze_{table}"],
    )


def _gold(name: str, tables: Sequence[str], transformation: Config,
          partition_cols: Sequence[str] = ()) -> Config:
    listed = [
        {"alias": t, "input_prefix": f"silver/{t}", "format": "parquet", "options": {}}
        for t in tables
    ]
    return _build(
        f"gold_{name}", {"inputs": listed}, transformation, f"gold/{name}", partition_cols,
        [f"silver_{t}" for t in tables],
    )


def _dimension(name: str, table: str) -> Config:
    columns = COLUMNS[table]
    sql = f"SELECT {', '.join(columns)} FROM {table}"
    return _gold(name, [table], {"sql": sql, "steps": [_unique(columns)]})


# The output columns of the fact and performance tables, key first.
FACT_ORDERS = [
    "order_id", "user_id", "order_date", "order_day", "order_status", "total_amount", "user_city",
    "user_gender",
]
FACT_ORDER_ITEMS = [
    "order_item_id", "order_id", "product_id", "user_id", "order_date", "order_day",
    "order_status", "quantity", "item_price", "item_total", "category", "brand",
]
FACT_EVENTS = [
    "event_id", "user_id", "product_id", "event_type", "event_timestamp", "event_date",
    "user_city", "category", "brand",
]
PRODUCT_PERFORMANCE = [
    "product_id", "product_name", "category", "brand", "price", "catalog_rating", "units_sold",
    "gross_sales", "order_count", "event_count", "active_user_count", "review_count",
    "avg_review_rating",
]

# Keys of the silver tables are unique, so these joins neither add nor repeat rows, and say so.
_CATALOGUE = {
    "table": "products", "key": "product_id", "unique": True,
    "columns": {"category": "category", "brand": "brand"},
}
_FACTS = {
    "fact_orders": {
        "fact": "orders",
        "joins": [
            {"table": "users", "key": "user_id", "unique": True,
             "columns": {"city": "user_city", "gender": "user_gender"}},
        ],
        "derive": {"order_day": "to_date(order_date)"},
        "columns": FACT_ORDERS,
    },
    "fact_order_items": {
        "fact": "order_items",
        "joins": [
            _CATALOGUE,
            {"table": "orders", "key": "order_id", "unique": True,
             "columns": {"order_date": "order_date", "order_status": "order_status"}},
        ],
        "derive": {"order_day": "to_date(order_date)"},
        "columns": FACT_ORDER_ITEMS,
    },
    "fact_events": {
        "fact": "events",
        "joins": [
            _CATALOGUE,
            {"table": "users", "key": "user_id", "unique": True, "columns": {"city": "user_city"}},
        ],
        "derive": {"event_date": "to_date(event_timestamp)"},
        "columns": FACT_EVENTS,
    },
    # One row per product from each table, so the joins are between product-sized tables.
    "product_performance": {
        "fact": "products",
        "joins": [
            {"table": "order_items", "key": "product_id",
             "aggregate": {"units_sold": "sum(quantity)", "gross_sales": "sum(item_total)",
                           "order_count": "count(DISTINCT order_id)"},
             "defaults": {"units_sold": 0, "gross_sales": 0.0, "order_count": 0}},
            {"table": "events", "key": "product_id",
             "aggregate": {"event_count": "count(*)",
                           "active_user_count": "count(DISTINCT user_id)"},
             "defaults": {"event_count": 0, "active_user_count": 0}},
            {"table": "reviews", "key": "product_id",
             "aggregate": {"review_count": "count(*)", "avg_review_rating": "avg(rating)"},
             "defaults": {"review_count": 0}},
        ],
        "derive": {"catalog_rating": "rating"},
        "columns": PRODUCT_PERFORMANCE,
    },
}

# Items are counted per order before the join, so an order with very many items crosses the
# shuffle as one row; the counts then add up to the same total per day.
_DAILY_SALES_SQL = """
WITH items_per_order AS (
    SELECT order_id, COUNT(order_item_id) AS items FROM order_items GROUP BY order_id
)
SELECT to_date(o.order_date) AS order_day,
       COUNT(DISTINCT o.order_id) AS order_count,
       SUM(COALESCE(i.items, 0)) AS order_item_count
FROM orders AS o
LEFT JOIN items_per_order AS i ON i.order_id = o.order_id
GROUP BY to_date(o.order_date)
"""

def _fact(name: str, partition_cols: Sequence[str] = ()) -> Config:
    described = _FACTS[name]
    tables = [described["fact"], *[join["table"] for join in described["joins"]]]
    return _gold(name, tables, {"lookups": described, "steps": []}, partition_cols)


def _gold_builds() -> list[Config]:
    daily = {"sql": _DAILY_SALES_SQL, "steps": []}
    return [
        _dimension("dim_users", "users"),
        _dimension("dim_products", "products"),
        _fact("fact_orders", ["order_day"]),
        _fact("fact_order_items", ["order_day"]),
        _fact("fact_events", ["event_date"]),
        _gold("daily_sales", ["orders", "order_items"], daily, ["order_day"]),
        _fact("product_performance"),
    ]


def builds() -> dict[str, Config]:
    """All nineteen builds by name; each comes after those it depends on."""
    listed = [*map(bronze, COLUMNS), *map(silver, COLUMNS), *_gold_builds()]
    return {config["pipeline"]["name"]: config for config in listed}


def run_warehouse(
    spark: SparkSession, base_path: str, run_id: str | None = None,
    only: Sequence[str] | None = None,
) -> Mapping[str, RunResult]:
    """Run the builds in order below ``base_path``."""
    return {
        name: run_pipeline(spark, config, base_path, run_id)
        for name, config in builds().items()
        if only is None or name in only
    }
