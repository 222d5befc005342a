"""Product and client performance, stock and price advice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from packhouse.config import Params
from packhouse.functions import rules
from packhouse.functions.numbers import dbl, money, pct, zero_if_null
from packhouse.functions.text import UNKNOWN
from packhouse.operators.lookups import fold_children, with_parent
from packhouse.plans.pricing import settings

UNKNOWN_CLIENT = "unknown"
TOP_VARIANT_PRODUCTS = 6


def recent_orders(t, p: Params, *cols: str) -> DataFrame:
    """Orders inside the look-back, or all of them when there is none."""
    if p.lookback_days is None:
        return t.orders(*cols)
    after = F.col("order_date") > F.lit(p.days_before(p.lookback_days))
    return t.orders(*dict.fromkeys([*cols, "order_date"])).filter(after).select(*cols)


def _recent_items(t, p: Params, *cols: str) -> DataFrame:
    if p.lookback_days is None:
        return t.order_items(*cols)
    orders = recent_orders(t, p, "id").select(F.col("id").alias("order_id"))
    return t.order_items("order_id", *cols).join(orders, "order_id", "left_semi").drop("order_id")


def product_stats(t, p: Params) -> DataFrame:
    """One row per product sold.

    Lines are summed by product before the product is looked up, so a product with
    a third of all lines is reduced map-side; lines without a product drop out.
    """
    items = _recent_items(t, p, "product_id", "quantity", "selling_price_used", "total_revenue", "total_cost")
    price = F.coalesce("selling_price_used", F.lit(0.0))
    sums = items.groupBy("product_id").agg(
        zero_if_null(F.sum("quantity")).alias("total_qty"),
        zero_if_null(F.sum("total_revenue")).alias("total_revenue"),
        zero_if_null(F.sum("total_cost")).alias("total_cost"),
        F.count(F.lit(1)).alias("order_count"),
        F.min(price).alias("min_price"),
        F.greatest(F.max(price), F.lit(0.0)).alias("max_price"),
    )
    products = t.products("id", "name", "unit", "cost_per_unit").select(
        F.col("id").alias("product_id"), "name", "unit", F.col("cost_per_unit").alias("base_cost")
    )
    stats = sums.join(products, "product_id", "inner")
    quantity, revenue = F.col("total_qty"), F.col("total_revenue")
    return stats.withColumns(
        {
            "avg_price": F.when(quantity > 0, dbl(revenue) / dbl(quantity)).otherwise(F.lit(0.0)),
            "margin": pct(revenue - F.col("total_cost"), revenue),
        }
    )


def product_revenue(t, p: Params) -> Column:
    """Revenue of all lines that have a product, as a one-value subquery."""
    sums = _recent_items(t, p, "product_id", "total_revenue").groupBy("product_id").agg(F.sum("total_revenue").alias("revenue"))
    known = t.products("id").select(F.col("id").alias("product_id"))
    # An inner join on the products' key: a semi join would be pushed below the sums, to the lines.
    return sums.join(known, "product_id", "inner").agg(zero_if_null(F.sum("revenue"))).scalar()


def product_performance(t, p: Params) -> DataFrame:
    th = p.thresholds
    stats = product_stats(t, p).withColumn("revenue_share", pct(F.col("total_revenue"), product_revenue(t, p)))
    return stats.withColumns(
        {
            "margin_tier": rules.three_tiers(F.col("margin"), th.margin_high, th.margin_mid),
            "share_tier": rules.three_tiers(F.col("revenue_share"), th.share_high, th.share_mid, strict=True),
        }
    ).orderBy(F.col("total_revenue").desc(), "product_id")


def product_trend(t, p: Params) -> DataFrame:
    """Revenue of the last seven days against the seven before, for every product sold.

    Only orders of those two weeks are joined to their lines.
    """
    week, fortnight = F.lit(p.days_before(p.week_days)), F.lit(p.days_before(2 * p.week_days))
    dated = t.orders("id", "order_date").filter(F.col("order_date") > fortnight)
    dated = dated.select(F.col("id").alias("order_id"), (F.col("order_date") > week).alias("is_recent"))
    items = t.order_items("order_id", "product_id", "total_revenue").join(dated, "order_id", "inner")
    moved = items.groupBy("product_id").agg(
        F.sum(F.when(F.col("is_recent"), F.col("total_revenue"))).alias("recent"),
        F.sum(F.when(~F.col("is_recent"), F.col("total_revenue"))).alias("previous"),
    )
    sold = t.order_items("product_id").select("product_id").distinct()
    products = t.products("id", "name").select(F.col("id").alias("product_id"), "name")
    rows = sold.join(products, "product_id", "inner").join(moved, "product_id", "left")
    recent, previous = zero_if_null(F.col("recent")), zero_if_null(F.col("previous"))
    change = F.when(previous > 0, (dbl(recent) - dbl(previous)) / dbl(previous) * 100).otherwise(
        F.when(recent > 0, F.lit(100.0)).otherwise(F.lit(0.0))
    )
    return rows.select(
        "product_id",
        "name",
        recent.alias("recent_revenue"),
        previous.alias("previous_revenue"),
        change.alias("trend_pct"),
        F.when(change > 0, "up").when(change < 0, "down").otherwise("flat").alias("trend"),
    )


def client_stats(t, p: Params) -> DataFrame:
    """Revenue and quantity per client; lines without an order form the ``unknown`` client.

    Lines are summed per order, then per client, before names and counts are looked up.
    """
    items = t.order_items("order_id", "total_revenue", "quantity")
    per_order = fold_children(items, "order_id", revenue=F.sum("total_revenue"), qty=F.sum("quantity"))
    per_order = with_parent(per_order, t.orders("id", "client_id"), "order_id", {"client_id": "client_id"})
    client = F.coalesce(F.nullif(F.col("client_id"), F.lit("")), F.lit(UNKNOWN_CLIENT))
    return per_order.groupBy(client.alias("client_id")).agg(
        zero_if_null(F.sum("revenue")).alias("total_revenue"), zero_if_null(F.sum("qty")).alias("total_qty")
    )


def client_performance(t, p: Params) -> DataFrame:
    counts = t.orders("client_id").groupBy("client_id").agg(F.count(F.lit(1)).alias("n"))
    rows = with_parent(client_stats(t, p), counts, "client_id", {"n": "n"}, parent_key="client_id")
    rows = with_parent(rows, t.clients("id", "name"), "client_id", {"name": "name"})
    return rows.select(
        "client_id",
        F.coalesce(F.nullif(F.col("name"), F.lit("")), F.lit(UNKNOWN)).alias("client_name"),
        "total_revenue",
        "total_qty",
        zero_if_null(F.col("n")).alias("total_orders"),
        pct(F.col("total_revenue"), product_revenue(t, p)).alias("revenue_share"),
    ).orderBy(F.col("total_revenue").desc(), "client_id")


def analytics_summary(t, p: Params) -> DataFrame:
    totals = product_stats(t, p).agg(
        zero_if_null(F.sum("total_revenue")).alias("total_revenue"), F.count(F.lit(1)).alias("products_sold")
    )
    orders = t.orders("id").agg(F.count(F.lit(1)))
    clients = client_stats(t, p).agg(F.count(F.lit(1)))
    return totals.select(
        "total_revenue", orders.scalar().alias("total_orders"), "products_sold", clients.scalar().alias("active_clients")
    )


def stock_recommendations(t, p: Params) -> DataFrame:
    """Increase, decrease or keep the stock of each product, by daily sales and number of lines."""
    a = p.advice
    span = recent_orders(t, p, "order_date").agg(
        F.greatest(F.lit(1), F.date_diff(F.max("order_date"), F.min("order_date")))
    )
    stats = product_stats(t, p).withColumn("velocity", dbl(F.col("total_qty")) / dbl(span.scalar()))
    lines, velocity = F.col("order_count"), F.col("velocity")
    kind = (
        F.when((lines >= a.busy_lines) & (velocity > a.busy_velocity), "increase")
        .when((lines <= a.quiet_lines) & (velocity < a.quiet_velocity), "decrease")
        .otherwise("stable")
    )
    rank = F.when(F.col("recommendation") == "increase", 0).when(F.col("recommendation") == "decrease", 1).otherwise(2)
    return (
        stats.withColumn("recommendation", kind)
        .withColumn("rank_pos", rank)
        .select("product_id", "name", "unit", "recommendation", "rank_pos", "velocity", "order_count", "total_qty", "total_revenue")
        .orderBy("rank_pos", F.col("total_revenue").desc(), "product_id")
    )


def stock_rec_counts(t, p: Params) -> DataFrame:
    """How many products are to be acted on, and how many are stable."""
    is_stable = F.col("recommendation") == "stable"
    return stock_recommendations(t, p).agg(F.count_if(~is_stable).alias("to_act_on"), F.count_if(is_stable).alias("stable"))


def price_suggestions(t, p: Params) -> DataFrame:
    """Zero to three price tips per product."""
    a = p.advice
    stats = with_parent(product_stats(t, p), t.margins(), "product_id", {"saved_margin": "profit_margin_pct"}, parent_key="product_id")
    lines, margin, avg = F.col("order_count"), F.col("margin"), F.col("avg_price")
    low, high = F.col("min_price"), F.col("max_price")
    suggested = rules.suggested_price(F.col("base_cost"), F.col("saved_margin"), settings(t, p))
    none = F.lit(None).cast("double")

    def tip(rule: str, kind: str, metric: Column, target: Column) -> Column:
        return F.struct(
            F.lit(rule).alias("rule"), F.lit(kind).alias("kind"), metric.alias("metric"), target.alias("target_price")
        )

    spread = F.when((high > 0) & (low > 0), (high - low) / low * 100)
    demand = F.when(
        (lines >= a.busy_lines) & (margin < a.low_margin), tip("raise_price", "increase", margin, avg * a.raise_factor)
    ).when((lines <= a.quiet_lines) & (margin > a.high_margin), tip("lower_price", "decrease", margin, none))
    tips = F.array(
        demand,
        F.when(spread > a.spread_pct, tip("standardise", "info", spread, none)),
        F.when(
            (suggested > 0) & (avg > 0) & (avg < suggested * a.underpriced_factor),
            tip("underpriced", "increase", avg, suggested),
        ),
    )
    return stats.select("product_id", "name", F.explode(F.array_compact(tips)).alias("tip")).select("product_id", "name", "tip.*")


def variant_sales_summary(t, p: Params) -> DataFrame:
    """The six best-selling products that have saved pack sizes."""
    stats = product_stats(t, p)
    # Distinct keys and an inner join: a semi join would be pushed below the sums, to the lines.
    with_sizes = t.variants().select("product_id").distinct()
    return (
        stats.join(with_sizes, "product_id", "inner")
        .orderBy(F.col("total_revenue").desc(), "product_id")
        .limit(TOP_VARIANT_PRODUCTS)
        .select("product_id", "name", "unit", "total_revenue", "avg_price")
    )


def variant_sales_sizes(t, p: Params) -> DataFrame:
    """The pack sizes and prices that the summary lists beside each of its products, one row each, best seller first."""
    top = variant_sales_summary(t, p).select("product_id", "total_revenue")
    # Six rows, so one task will do.
    ranked = top.withColumn("place", F.row_number().over(Window.orderBy(F.col("total_revenue").desc(), "product_id")))
    return ranked.join(t.variants(), "product_id").select("place", "product_id", "position", "weight", "price")
