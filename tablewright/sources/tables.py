"""External tables over the gold datasets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class GoldTable:
    """Columns as DDL, partition columns included, and the partition column names."""

    columns: str
    partitioned_by: tuple[str, ...] = ()


_AUDIT = "etl_loaded_at timestamp, etl_run_date date, etl_run_id string"

# The column lists of the gold tables.
GOLD_TABLES: Mapping[str, GoldTable] = {
    "dim_users": GoldTable(
        "user_id string, name string, email string, gender string, city string, "
        f"signup_date date, {_AUDIT}"
    ),
    "dim_products": GoldTable(
        "product_id string, product_name string, category string, brand string, "
        f"price double, rating double, {_AUDIT}"
    ),
    "fact_orders": GoldTable(
        "order_id string, user_id string, order_date timestamp, order_status string, "
        f"total_amount double, user_city string, user_gender string, {_AUDIT}, order_day date",
        ("order_day",),
    ),
    "fact_order_items": GoldTable(
        "order_item_id string, order_id string, product_id string, user_id string, "
        "order_date timestamp, order_status string, quantity int, item_price double, "
        f"item_total double, category string, brand string, {_AUDIT}, order_day date",
        ("order_day",),
    ),
    "fact_events": GoldTable(
        "event_id string, user_id string, product_id string, event_type string, "
        "event_timestamp timestamp, user_city string, category string, brand string, "
        f"{_AUDIT}, event_date date",
        ("event_date",),
    ),
    "daily_sales": GoldTable(
        f"order_count bigint, order_item_count bigint, {_AUDIT}, order_day date",
        ("order_day",),
    ),
    "product_performance": GoldTable(
        "product_id string, product_name string, category string, brand string, "
        "price double, catalog_rating double, units_sold bigint, gross_sales double, "
        "order_count bigint, event_count bigint, active_user_count bigint, "
        f"review_count bigint, avg_review_rating double, {_AUDIT}"
    ),
}


def create_gold_tables(
    spark: SparkSession,
    base_path: str,
    schema: str = "gold",
    tables: Mapping[str, GoldTable] = GOLD_TABLES,
) -> list[str]:
    """Create the schema and one external Parquet table per gold dataset below ``base_path``."""
    base = base_path.rstrip("/")
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{schema}`")
    for name, table in tables.items():
        names = ", ".join(table.partitioned_by)
        split = f"PARTITIONED BY ({names})" if names else ""
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS `{schema}`.`{name}` ({table.columns}) "
            f"USING PARQUET {split} LOCATION '{base}/{name}'"
        )
    return list(tables)


def sync_partitions(
    spark: SparkSession,
    schema: str = "gold",
    names: Sequence[str] | None = None,
) -> None:
    """Register new partition directories and forget vanished ones."""
    if names is None:
        names = [name for name, table in GOLD_TABLES.items() if table.partitioned_by]
    for name in names:
        spark.sql(f"MSCK REPAIR TABLE `{schema}`.`{name}` SYNC PARTITIONS")
        spark.catalog.refreshTable(f"{schema}.{name}")
