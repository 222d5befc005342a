"""Weekly key figures, waste, receivables, cash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packhouse.config import Params
from packhouse.functions import rules
from packhouse.functions.numbers import pct, zero_if_null
from packhouse.operators.lookups import fold_children


def _week(t, p: Params, *cols: str) -> DataFrame:
    """Orders of the last week: the lower bound counts, there is no upper one."""
    columns = dict.fromkeys([*cols, "order_date"])
    return t.orders(*columns).filter(F.col("order_date") >= F.lit(p.days_before(p.week_days)))


def _week_base_cost(t, p: Params) -> DataFrame:
    """Farmer cost of the week's lines."""
    week = _week(t, p, "id").select(F.col("id").alias("order_id"))
    items = t.order_items("order_id", "total_cost").join(week, "order_id", "left_semi")
    return items.agg(zero_if_null(F.sum("total_cost")).alias("base_cost"))


def weekly_kpis(t, p: Params) -> DataFrame:
    orders = _week(t, p, "total_revenue", "net_profit", "transport_cost", "packaging_cost", "margin_percentage")
    sums = orders.agg(
        F.count(F.lit(1)).alias("orders"),
        zero_if_null(F.sum("total_revenue")).alias("revenue"),
        zero_if_null(F.sum("net_profit")).alias("profit"),
        zero_if_null(F.sum("transport_cost")).alias("transport_cost"),
        zero_if_null(F.sum("packaging_cost")).alias("packaging_cost"),
        # Stored margins have two decimals: summed exactly, so that no order of rows shows.
        zero_if_null(F.sum(F.col("margin_percentage").cast("decimal(18,2)"))).alias("margin_sum"),
    ).withColumn("base_cost", _week_base_cost(t, p).scalar())
    return weekly_figures(sums, p)


def weekly_figures(sums: DataFrame, p: Params) -> DataFrame:
    """The week's key figures from its sums: orders, revenue, profit, costs and stored margins."""
    whole = F.col("revenue")
    total = F.col("base_cost") + F.col("transport_cost") + F.col("packaging_cost")
    average = F.when(F.col("orders") > 0, F.col("margin_sum").cast("double") / F.col("orders")).otherwise(F.lit(0.0))
    return sums.withColumns({"total_cost": total, "avg_margin": average}).select(
        "orders",
        "revenue",
        "profit",
        "avg_margin",
        rules.margin_zone(F.col("avg_margin"), p.thresholds).alias("avg_margin_zone"),
        "base_cost",
        "transport_cost",
        "packaging_cost",
        "total_cost",
        pct(F.col("base_cost"), whole).alias("base_pct"),
        pct(F.col("transport_cost"), whole).alias("transport_pct"),
        pct(F.col("packaging_cost"), whole).alias("packaging_pct"),
        pct(F.col("total_cost"), whole).alias("total_cost_pct"),
    )


def waste_totals(t, p: Params) -> DataFrame:
    batches = t.batches("harvested_qty", "damaged_qty", "expired_qty", "waste_value")
    totals = batches.agg(
        zero_if_null(F.sum("harvested_qty")).alias("harvested"),
        zero_if_null(F.sum(rules.waste_quantity(F.col("damaged_qty"), F.col("expired_qty")))).alias("waste"),
        zero_if_null(F.sum("waste_value")).alias("waste_value"),
    )
    return waste_figures(totals, p)


def waste_figures(totals: DataFrame, p: Params) -> DataFrame:
    waste_pct = pct(F.col("waste"), F.col("harvested"))
    return totals.withColumn("waste_pct", waste_pct).withColumn("alert", F.col("waste_pct") > p.thresholds.waste_high)


def _is_paid() -> Column:
    return F.coalesce(F.col("status") == rules.PAID, F.lit(False))


def receivables_totals(t, p: Params) -> DataFrame:
    return t.payments("amount", "status").agg(
        zero_if_null(F.sum(F.when(~_is_paid(), F.col("amount")))).alias("outstanding"),
        zero_if_null(F.sum(F.when(_is_paid(), F.col("amount")))).alias("collected"),
    )


def base_cost_collected(t, p: Params) -> DataFrame:
    """Farmer cost of paid orders, counted once per paid payment."""
    paid = t.payments("order_id", "status").filter(_is_paid()).groupBy("order_id").agg(F.count(F.lit(1)).alias("times"))
    cost = fold_children(t.order_items("order_id", "total_cost"), "order_id", cost=F.sum("total_cost"))
    return paid.join(cost, "order_id", "inner").agg(
        zero_if_null(F.sum(F.col("cost") * F.col("times"))).alias("base_cost_collected")
    )


def top_client_share(t, p: Params) -> DataFrame:
    by_client = t.orders("client_id", "total_revenue").groupBy("client_id").agg(zero_if_null(F.sum("total_revenue")).alias("revenue"))
    return client_concentration(by_client, p)


def client_concentration(by_client: DataFrame, p: Params) -> DataFrame:
    """Share of the largest client in the revenue of all."""
    totals = by_client.agg(F.greatest(F.max("revenue"), F.lit(0)).alias("top"), F.sum("revenue").alias("all"))
    share = F.coalesce(pct(F.col("top"), F.col("all")), F.lit(0.0))
    return totals.select(share.alias("top_client_pct")).withColumn(
        "alert", F.col("top_client_pct") > p.thresholds.top_client_alert
    )


def cash_position(t, p: Params) -> DataFrame:
    """Cash in hand, and what it comes to once clients and the farmer are paid."""
    kind, amount = F.col("type"), F.col("amount")
    signed = F.when(kind.isin("initial", "deposit"), amount).when(kind == "withdrawal", -amount)
    cash = t.ledger().agg(zero_if_null(F.sum(signed)).alias("manual_cash"))
    due = receivables_totals(t, p)
    cash = cash.withColumns(
        {
            "collected": due.select("collected").scalar(),
            "expected_in": due.select("outstanding").scalar(),
            "farmer_owed": _week_base_cost(t, p).scalar(),
        }
    )
    cash = cash.withColumn("cash_in_hand", F.col("manual_cash") + F.col("collected"))
    return cash.withColumn("projected", F.col("cash_in_hand") + F.col("expected_in") - F.col("farmer_owed"))
