"""Business tables from a few hand-written rows, with the interface of the sources."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from packhouse.config import Settings
from packhouse.sources.schemas import schema

EXTRA = {
    "margins": "product_id string, profit_margin_pct double",
    "variants": "product_id string, position int, weight double, price double",
    "ledger": "id string, date date, type string, amount decimal(18,2), description string",
    "waste_links": "link_key string, client_id string, client_name string, order_id string, order_label string",
    "draft_lines": "id string, order_id string, product_id string, package_size string, num_packages string, qty string",
    "pricing_entries": "product_id string, new_size string, new_price string, new_margin string",
    "reassigned_lines": "id string, product_id string, new_client_id string, selling_price_used double",
}


def day(text: str) -> dt.date:
    return dt.date.fromisoformat(text)


def _value(v, kind):
    if isinstance(kind, T.DecimalType) and v is not None:
        return Decimal(str(v))
    if isinstance(kind, T.DateType) and isinstance(v, str):
        return day(v)
    if isinstance(kind, T.DoubleType) and v is not None:
        return float(v)
    return v


def frame(spark: SparkSession, ddl: str | T.StructType, rows: list[dict]) -> DataFrame:
    struct = ddl if isinstance(ddl, T.StructType) else T.StructType.fromDDL(ddl)
    data = [tuple(_value(r.get(f.name), f.dataType) for f in struct) for r in rows]
    return spark.createDataFrame(data, struct)


class Small:
    NAMES = {
        "clients": "clients",
        "products": "products",
        "orders": "orders",
        "order_items": "order_items",
        "payments": "payments",
        "batches": "inventory_batches",
        "price_history": "client_pricing_history",
        "client_pricing": "client_pricing",
    }

    def __init__(self, spark: SparkSession, **rows: list[dict]):
        self.spark = spark
        self.rows = rows

    def __getattr__(self, name):
        if name in self.NAMES:
            table = frame(self.spark, schema(self.NAMES[name]), self.rows.get(name, []))
            return lambda *cols: table.select(*cols) if cols else table
        if name in EXTRA:
            return lambda: frame(self.spark, EXTRA[name], self.rows.get(name, []))
        raise AttributeError(name)

    def settings(self) -> Settings:
        return Settings()
