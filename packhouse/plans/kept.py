"""The dashboard's figures, kept up to date under change feeds instead of worked out again."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packhouse.config import Params
from packhouse.functions.numbers import zero_if_null
from packhouse.plans import dashboard
from packhouse.streaming.kept import CLIENT_REVENUE, DAYS, RECEIVABLES, WASTE, run_kept


def weekly(days: DataFrame, clients: DataFrame, p: Params) -> DataFrame:
    """The week's key figures and the largest client's share, from sums by day and by client."""
    week = days.filter(F.col("order_date") >= F.lit(p.days_before(p.week_days)))
    sums = week.agg(zero_if_null(F.sum("row_count")).alias("orders"), *[zero_if_null(F.sum(n)).alias(n) for n in DAYS.sums])
    top = dashboard.client_concentration(clients, p)
    return dashboard.weekly_figures(sums, p).withColumns(
        {"top_client_pct": top.select("top_client_pct").scalar(), "top_client_alert": top.select("alert").scalar()}
    )


def receivables(sums: DataFrame) -> DataFrame:
    both = {"outstanding": ~F.col("paid"), "collected": F.col("paid")}
    return sums.agg(*[zero_if_null(F.sum(F.when(c, F.col("amount")))).alias(n) for n, c in both.items()])


def waste(sums: DataFrame, p: Params) -> DataFrame:
    # One row even where nothing is kept.
    return dashboard.waste_figures(sums.agg(*[zero_if_null(F.sum(n)).alias(n) for n in WASTE.sums]), p)


def kept_weekly_kpis(t, p: Params) -> DataFrame:
    days, clients = run_kept(t.order_feed(), [DAYS, CLIENT_REVENUE])
    return weekly(days, clients, p)


def kept_receivables(t, p: Params) -> DataFrame:
    (sums,) = run_kept(t.payment_feed(), [RECEIVABLES])
    return receivables(sums)


def kept_waste_totals(t, p: Params) -> DataFrame:
    (sums,) = run_kept(t.batch_feed(), [WASTE])
    return waste(sums, p)
