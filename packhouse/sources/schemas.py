"""Declared schemas of the business tables, and a read that checks them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from packhouse.functions.numbers import LINE_MONEY, MONEY

# Columns and types of the stored tables.
TABLES: dict[str, str] = {
    "clients": "id string, name string, name_ar string, type string, phone string, credit_days int, created_at timestamp",
    "products": f"id string, name string, name_ar string, unit string, cost_per_unit {MONEY}, profit_margin_pct double, "
    "shelf_life_days int, created_at timestamp",
    "client_pricing": f"id string, client_id string, product_id string, selling_price {MONEY}, last_updated timestamp",
    "client_pricing_history": f"id string, client_id string, product_id string, selling_price {MONEY}, changed_at timestamp",
    "orders": f"id string, client_id string, order_date date, delivery_date date, transport_cost {MONEY}, "
    f"packaging_cost {MONEY}, total_revenue {MONEY}, total_cost {MONEY}, net_profit {MONEY}, margin_percentage double, "
    "margin_zone string, created_at timestamp",
    "order_items": f"id string, order_id string, product_id string, quantity {MONEY}, selling_price_used double, "
    f"cost_used {MONEY}, total_revenue {MONEY}, total_cost {LINE_MONEY}",
    "payments": f"id string, order_id string, amount {MONEY}, invoice_date date, due_date date, paid_date date, "
    "status string, created_at timestamp",
    "inventory_batches": f"id string, product_id string, harvest_date date, harvested_qty {MONEY}, sold_qty {MONEY}, "
    f"damaged_qty {MONEY}, expired_qty {MONEY}, waste_percentage double, waste_value {MONEY}, created_at timestamp",
    "pricing_settings": "id string, overhead_pct double, labor_pct double, updated_at timestamp",
}


class SchemaMismatch(Exception):
    pass


def schema(table: str) -> T.StructType:
    return T.StructType.fromDDL(TABLES[table])


def checked(df: DataFrame, table: str) -> DataFrame:
    """Select the declared columns; fail where one is missing or of another type."""
    found = {f.name: f.dataType for f in df.schema}
    wrong = [
        f"{f.name}: expected {f.dataType.simpleString()}, found {found[f.name].simpleString() if f.name in found else 'nothing'}"
        for f in schema(table)
        if found.get(f.name) != f.dataType
    ]
    if wrong:
        raise SchemaMismatch(f"{table}: " + "; ".join(wrong))
    return df.select(*[f.name for f in schema(table)])


def read_table(spark: SparkSession, root: str, table: str, folder: str | None = None) -> DataFrame:
    """A stored table; ``folder``, below the root, where it isn't named after the table."""
    return checked(spark.read.parquet(f"{root.rstrip('/')}/{folder or table}"), table)
