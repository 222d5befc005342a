"""Writing results: the price list, document tables, snapshots."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Headings of the exported price list.
PRICE_LIST_HEADINGS = {
    "product": "Product",
    "product_ar": "Product (AR)",
    "base_cost_per_kg": "Base Cost/kg",
    "pack_size_kg": "Pack Size (kg)",
    "raw_cost_per_pack": "Raw Cost/Pack",
    "overhead_pct": "Overhead %",
    "labor_pct": "Labor %",
    "total_cost_per_pack": "Total Cost/Pack",
    "profit_margin_pct": "Profit Margin %",
    "pack_price": "Pack Price (EGP)",
    "price_per_kg": "Price/KG",
}


def write_price_list(rows: DataFrame, folder: str, day: dt.date, file_format: str = "csv") -> str:
    """Write the price list of a day: CSV with the printed headings, or Parquet with plain names."""
    path = f"{folder.rstrip('/')}/export_date={day.isoformat()}"
    if file_format == "csv":
        renamed = rows.select(*[F.col(c).alias(h) for c, h in PRICE_LIST_HEADINGS.items()])
        renamed.write.mode("overwrite").csv(path, header=True)
    elif file_format == "parquet":
        rows.select(*PRICE_LIST_HEADINGS).write.mode("overwrite").parquet(path)
    else:
        raise ValueError(f"unknown format: {file_format}")
    return path


def write_by_delivery_date(lines: DataFrame, folder: str) -> None:
    """Write document lines in one folder per delivery date.

    Rows of a date are brought together first, so that a date gets few files; a
    very large date is spread over several tasks by adaptive execution.
    """
    lines.hint("rebalance", "delivery_date").write.mode("overwrite").partitionBy("delivery_date").parquet(folder)


def write_snapshot(tables: dict[str, DataFrame], root: str, version: str) -> str:
    """Write a new snapshot of several tables beside the old ones; it counts once every table is complete."""
    base = f"{root.rstrip('/')}/version={version}"
    for name, table in tables.items():
        table.write.mode("overwrite").parquet(f"{base}/{name}")
    return base


def snapshot_is_complete(spark: SparkSession, base: str, tables: list[str]) -> bool:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    paths = [jvm.org.apache.hadoop.fs.Path(f"{base}/{name}/_SUCCESS") for name in tables]
    return all(path.getFileSystem(conf).exists(path) for path in paths)
