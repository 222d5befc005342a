"""Stock batches: waste, links to orders, batch rules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packhouse.config import Params
from packhouse.functions import rules
from packhouse.functions.numbers import cents
from packhouse.operators import quality
from packhouse.operators.lookups import with_parent


def with_waste(batches: DataFrame, products: DataFrame, packaging=None) -> DataFrame:
    """Set waste percentage and value of batches; ``packaging`` is a cost per unit of waste.

    ``raw_waste_value`` is the value before rounding, as deducted from a linked order.
    """
    packaging = F.lit(0) if packaging is None else packaging
    rows = with_parent(batches, products, "product_id", {"_cost": "cost_per_unit"})
    waste = rules.waste_quantity(F.col("damaged_qty"), F.col("expired_qty"))
    raw = rules.raw_waste_value(waste, F.col("_cost"), packaging)
    return rows.withColumns(
        {
            "waste_qty": waste,
            "waste_percentage": rules.waste_percentage(waste, F.col("harvested_qty")),
            "raw_waste_value": raw,
            "waste_value": cents(raw),
        }
    ).drop("_cost")


def batch_waste(t, p: Params) -> DataFrame:
    batches = t.batches("id", "product_id", "harvested_qty", "damaged_qty", "expired_qty")
    return with_waste(batches, t.products("id", "cost_per_unit")).select(
        F.col("id").alias("batch_id"), "waste_qty", "waste_percentage", "waste_value"
    )


def waste_tiers(t, p: Params) -> DataFrame:
    batches = t.batches("id", "waste_percentage")
    return batches.select(
        F.col("id").alias("batch_id"), "waste_percentage", rules.waste_tier(F.col("waste_percentage"), p.thresholds).alias("tier")
    )


def linked_batches(batches: DataFrame, links: DataFrame) -> DataFrame:
    """Add the order a batch is linked to: by batch id, else by product and harvest date."""
    fields = ["client_id", "client_name", "order_id", "order_label"]
    fallback = F.concat_ws("_", "product_id", F.col("harvest_date").cast("string"))
    rows = batches.withColumn("_fallback", fallback)
    for key, prefix in (("id", "_a_"), ("_fallback", "_b_")):
        rows = with_parent(
            rows, links, key, {f"{prefix}key": "link_key", **{prefix + f: f for f in fields}}, parent_key="link_key"
        )
    by_id = F.col("_a_key").isNotNull()
    chosen = {f: F.when(by_id, F.col("_a_" + f)).otherwise(F.col("_b_" + f)) for f in fields}
    return rows.select(*batches.columns, *[c.alias(f) for f, c in chosen.items()])


def batch_order_links(t, p: Params) -> DataFrame:
    links = linked_batches(t.batches("id", "product_id", "harvest_date"), t.waste_links())
    return links.select(F.col("id").alias("batch_id"), "client_id", "client_name", "order_id", "order_label")


def dq_batches(t, p: Params) -> DataFrame:
    batches = t.batches("id", "product_id", "harvested_qty", "damaged_qty", "expired_qty")
    checked = quality.with_failures(batches, quality.batch_rules())
    return checked.select(
        F.col("id").alias("batch_id"), (F.size("failures") == 0).alias("is_valid"), F.concat_ws(",", "failures").alias("failures")
    )


def dq_ledger(t, p: Params) -> DataFrame:
    checked = quality.with_failures(t.ledger(), quality.ledger_rules())
    return checked.select(
        F.col("id").alias("entry_id"), (F.size("failures") == 0).alias("is_valid"), F.concat_ws(",", "failures").alias("failures")
    )


def dq_master_data(t, p: Params) -> DataFrame:
    """Rows and rejects of products, clients, prices and payments."""
    checks = {
        "products": (t.products("name", "cost_per_unit"), quality.product_rules()),
        "clients": (t.clients("name"), quality.client_rules()),
        "prices": (t.client_pricing("client_id", "product_id", "selling_price"), quality.price_rules()),
        "payments": (t.payments("amount"), quality.payment_rules()),
    }
    parts = [
        quality.with_failures(rows, rule_set).agg(
            F.lit(name).alias("table_name"),
            F.count(F.lit(1)).alias("row_count"),
            F.count_if(F.size("failures") > 0).alias("rejected_count"),
        )
        for name, (rows, rule_set) in checks.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
