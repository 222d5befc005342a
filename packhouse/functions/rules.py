"""Business rules as column expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from packhouse.config import Settings, Thresholds
from packhouse.functions.numbers import dbl, or_default, pct, round_half_up

SUPERMARKET = "supermarket"
KG = "kg"
PAID = "paid"

# Default pack weights in kg.
DEFAULT_WEIGHTS = (0.1, 0.25, 0.5, 1.0)


def truthy(c: Column) -> Column:
    """Neither null nor zero."""
    return F.coalesce(dbl(c), F.lit(0.0)) != 0


def three_tiers(value: Column, high: float, mid: float, strict: bool = False) -> Column:
    """``high`` / ``mid`` / ``low`` by two limits, inclusive unless ``strict``."""
    above_high = value > high if strict else value >= high
    above_mid = value > mid if strict else value >= mid
    return F.when(above_high, "high").when(above_mid, "mid").otherwise("low")


def margin_zone(margin: Column, t: Thresholds = Thresholds()) -> Column:
    return F.when(margin >= t.zone_green, "green").when(margin >= t.zone_yellow, "yellow").otherwise("red")


def waste_tier(waste_pct: Column, t: Thresholds = Thresholds()) -> Column:
    return F.when(waste_pct > t.waste_high, "red").when(waste_pct > t.waste_mid, "yellow").otherwise("green")


def is_supermarket(client_type: Column) -> Column:
    return F.coalesce(client_type, F.lit("restaurant")) == SUPERMARKET


def recovered_packs(applies: Column, price: Column, revenue: Column) -> Column:
    """Number of packs behind a stored line: revenue over price, rounded half up."""
    return F.when(applies & (price > 0), dbl(F.floor(dbl(revenue) / dbl(price) + 0.5)))


def recovered_size(quantity: Column, packs: Column) -> Column:
    return F.when(packs > 0, dbl(quantity) / packs)


def line_revenue(client_is_supermarket: Column, price: Column, quantity: Column, packs: Column) -> Column:
    return F.when(client_is_supermarket & truthy(packs), dbl(price) * dbl(packs)).otherwise(dbl(price) * dbl(quantity))


def due_date(delivery: Column, credit_days: Column, default_days: int) -> Column:
    return F.date_add(delivery, or_default(credit_days, default_days).cast("int"))


def days_past_due(as_of: dt.date, due: Column) -> Column:
    return F.date_diff(F.lit(as_of), due)


def waste_quantity(damaged: Column, expired: Column) -> Column:
    return F.coalesce(damaged, F.lit(0)) + F.coalesce(expired, F.lit(0))


def waste_percentage(waste: Column, harvested: Column) -> Column:
    return round_half_up(pct(waste, F.coalesce(harvested, F.lit(0))), 2)


def raw_waste_value(waste: Column, unit_cost: Column, packaging_per_unit: Column) -> Column:
    return waste * (F.coalesce(unit_cost, F.lit(0)) + F.coalesce(packaging_per_unit, F.lit(0)))


def packed_quantity(is_kg: Column, size: Column, count: Column) -> Column:
    """Kilograms for kg goods (size x count), pieces for the rest."""
    count = F.coalesce(dbl(count), F.lit(0.0))
    return F.when(is_kg, F.coalesce(dbl(size), F.lit(0.0)) * count).otherwise(count)


def suggested_price(cost: Column, margin_pct: Column, s: Settings) -> Column:
    """Cost plus overhead, labor and margin, each added on the bare cost."""
    percent = F.coalesce(dbl(margin_pct), F.lit(0.0)) / 100
    return dbl(cost) * (F.lit(1 + s.overhead_pct / 100 + s.labor_pct / 100) + percent)


def pack_cost(cost: Column, size: Column, s: Settings) -> Column:
    return dbl(cost) * dbl(size) * F.lit(s.factor)


def markup_pct(price: Column, total_cost: Column) -> Column:
    """Margin on cost; 0 where the cost is not positive."""
    return F.when(total_cost > 0, (dbl(price) - total_cost) / total_cost * 100).otherwise(F.lit(0.0))


def price_at_markup(total_cost: Column, margin_pct: Column) -> Column:
    return total_cost * (F.lit(1.0) + dbl(margin_pct) / 100)


def price_per_kg(price: Column, size: Column) -> Column:
    return F.when(size > 0, dbl(price) / dbl(size)).otherwise(F.lit(0.0))


def default_price(cost: Column, weight: Column) -> Column:
    return round_half_up(dbl(cost) * dbl(weight), 2)
