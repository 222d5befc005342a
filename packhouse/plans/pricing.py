"""Suggested prices, the pack price calculator, the price list."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packhouse.config import Params, Settings
from packhouse.functions import rules
from packhouse.functions.numbers import dbl, or_default, parse_float, to_fixed, zero_if_null
from packhouse.operators.lookups import with_parent

# Scenarios of the repricing report: overhead and labor in percent.
SCENARIOS = (Settings(10.0, 5.0), Settings(15.0, 0.0), Settings(20.0, 2.5))


def settings(t, p: Params) -> Settings:
    """The settings in force: those given, else those saved."""
    return p.settings or t.settings()


def _products(t) -> DataFrame:
    return t.products("id", "name", "name_ar", "unit", "cost_per_unit").withColumnRenamed("id", "product_id")


def _with_margin(t) -> DataFrame:
    return with_parent(_products(t), t.margins(), "product_id", {"saved_margin": "profit_margin_pct"}, parent_key="product_id")


def suggested_price(t, p: Params) -> DataFrame:
    price = rules.suggested_price(F.col("cost_per_unit"), F.col("saved_margin"), settings(t, p))
    return _with_margin(t).select("product_id", price.alias("suggested_price"))


def suggested_pack_price(t, p: Params) -> DataFrame:
    """Suggested price of each saved pack size: by the pack for kg goods, by the piece for the rest."""
    margins = _with_margin(t)
    side = {"unit": "unit", "cost_per_unit": "cost_per_unit", "saved_margin": "saved_margin"}
    packs = with_parent(t.variants(), margins, "product_id", side, parent_key="product_id")
    price = rules.suggested_price(F.col("cost_per_unit"), F.col("saved_margin"), settings(t, p))
    by_pack = (F.col("unit") == rules.KG) & (F.col("weight") > 0)
    shown = F.when(by_pack, price * F.col("weight")).otherwise(price)
    return packs.select("product_id", "position", "weight", to_fixed(shown, 2).alias("suggested_price"))


def calculator_rows(t, p: Params) -> DataFrame:
    """Where each product starts in the calculator: its first saved pack, else one unit at cost.

    A listing price is shown with two decimals and a margin with one, and later steps start from what is shown.
    """
    first = t.variants().filter(F.col("position") == 0)
    rows = with_parent(_products(t), first, "product_id", {"weight": "weight", "price": "price"}, parent_key="product_id")
    saved = F.col("weight").isNotNull()
    cost = rules.pack_cost(F.col("cost_per_unit"), F.col("weight"), settings(t, p))
    unit_cost = rules.pack_cost(F.col("cost_per_unit"), F.lit(1.0), settings(t, p))
    return rows.withColumns(
        {
            "pack_size": F.when(saved, F.col("weight")).otherwise(F.lit(1.0)),
            "pack_price": F.when(saved, F.col("price")).otherwise(to_fixed(unit_cost, 2)),
            "profit_margin": F.when(saved, to_fixed(rules.markup_pct(F.col("price"), cost), 1)).otherwise(F.lit(0.0)),
        }
    ).drop("weight", "price")


def pricing_rows(t, p: Params) -> DataFrame:
    return calculator_rows(t, p).select("product_id", "pack_size", "pack_price", "profit_margin")


def pricing_rows_valid(t, p: Params) -> DataFrame:
    """Rows worth saving as a pack size: both size and price positive."""
    rows = calculator_rows(t, p).filter((F.col("pack_size") > 0) & (F.col("pack_price") > 0))
    return rows.select("product_id", F.col("pack_size").alias("weight"), F.col("pack_price").alias("price"))


def pack_cost(t, p: Params) -> DataFrame:
    rows = calculator_rows(t, p)
    return rows.select("product_id", "pack_size", rules.pack_cost(F.col("cost_per_unit"), F.col("pack_size"), settings(t, p)).alias("pack_cost"))


def _entered(t, p: Params) -> DataFrame:
    entries = t.pricing_entries()
    typed = {"new_size": "new_size", "new_price": "new_price", "new_margin": "new_margin"}
    return with_parent(calculator_rows(t, p), entries, "product_id", typed, parent_key="product_id")


def _row_cost(t, p: Params) -> Column:
    return rules.pack_cost(F.col("cost_per_unit"), or_default(F.col("pack_size"), 1.0), settings(t, p))


def margin_from_price(t, p: Params) -> DataFrame:
    """A new pack price gives a new margin on cost."""
    price = zero_if_null(parse_float(F.col("new_price")))
    return _entered(t, p).select(
        "product_id", price.alias("pack_price"), to_fixed(rules.markup_pct(price, _row_cost(t, p)), 1).alias("profit_margin")
    )


def price_from_margin(t, p: Params) -> DataFrame:
    """A new margin gives a new pack price."""
    margin = zero_if_null(parse_float(F.col("new_margin")))
    return _entered(t, p).select(
        "product_id", margin.alias("profit_margin"), to_fixed(rules.price_at_markup(_row_cost(t, p), margin), 2).alias("pack_price")
    )


def reprice_pack_size(t, p: Params) -> DataFrame:
    """A new pack size at the same margin; a blank or zero size counts as 1."""
    size = or_default(parse_float(F.col("new_size")), 1.0)
    cost = rules.pack_cost(F.col("cost_per_unit"), size, settings(t, p))
    return _entered(t, p).select(
        "product_id", size.alias("pack_size"), to_fixed(rules.price_at_markup(cost, F.col("profit_margin")), 2).alias("pack_price")
    )


def reprice_scenario(t, p: Params, scenarios: tuple[Settings, ...] = SCENARIOS) -> DataFrame:
    """Every product at its current margin under each overhead and labor scenario.

    The scenarios ride along as a short constant list on each product row; nothing is joined.
    """
    options = F.array(
        *[
            F.struct(
                F.lit(s.overhead_pct).alias("overhead_pct"), F.lit(s.labor_pct).alias("labor_pct"), F.lit(s.factor).alias("factor")
            )
            for s in scenarios
        ]
    )
    rows = calculator_rows(t, p).withColumn("s", F.explode(options))
    cost = dbl(F.col("cost_per_unit")) * or_default(F.col("pack_size"), 1.0) * F.col("s.factor")
    price = to_fixed(rules.price_at_markup(cost, F.col("profit_margin")), 2)
    return rows.select("product_id", "s.overhead_pct", "s.labor_pct", "pack_size", price.alias("pack_price"))


def price_per_kg(t, p: Params) -> DataFrame:
    return calculator_rows(t, p).select("product_id", rules.price_per_kg(F.col("pack_price"), F.col("pack_size")).alias("price_per_kg"))


def default_variants(t, p: Params) -> DataFrame:
    """The default pack sizes of every product, priced at cost."""
    weights = F.posexplode(F.array(*[F.lit(w) for w in rules.DEFAULT_WEIGHTS])).alias("position", "weight")
    return _products(t).select("product_id", "cost_per_unit", weights).select(
        "product_id", "position", "weight", rules.default_price(F.col("cost_per_unit"), F.col("weight")).alias("price")
    )


def price_list_export(t, p: Params) -> DataFrame:
    """The price list as exported, one row per product."""
    size = or_default(F.col("pack_size"), 1.0)
    cost = dbl(F.col("cost_per_unit"))
    price = zero_if_null(F.col("pack_price"))
    return calculator_rows(t, p).select(
        "product_id",
        F.col("name").alias("product"),
        F.coalesce("name_ar", F.lit("")).alias("product_ar"),
        to_fixed(cost, 2).alias("base_cost_per_kg"),
        size.alias("pack_size_kg"),
        to_fixed(cost * size, 2).alias("raw_cost_per_pack"),
        F.lit(settings(t, p).overhead_pct).alias("overhead_pct"),
        F.lit(settings(t, p).labor_pct).alias("labor_pct"),
        to_fixed(rules.pack_cost(F.col("cost_per_unit"), size, settings(t, p)), 2).alias("total_cost_per_pack"),
        zero_if_null(F.col("profit_margin")).alias("profit_margin_pct"),
        price.alias("pack_price"),
        to_fixed(rules.price_per_kg(price, size), 2).alias("price_per_kg"),
    )
