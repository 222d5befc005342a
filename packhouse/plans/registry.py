"""Every report and job by name, over the given tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from packhouse.config import Params
from packhouse.plans import analytics, catalog, dashboard, documents, kept, maintenance, order_log, orders, pricing, stock
from packhouse.session import tune
from packhouse.sources.testdata import Testdata
from packhouse.streaming import debounce, flows

# The last order date of the given tables.
AS_OF = dt.date(2001, 8, 1)
PARAMS = Params(as_of=AS_OF)
# Advice over the whole history, and by a look-back under names of its own.
RECENT = replace(PARAMS, lookback_days=30)
GAP_SECONDS = 30 * 60


def plain(df: DataFrame) -> DataFrame:
    """Exact decimals as doubles, dates and times as ISO text: the form results are handed out in."""
    shown = []
    for f in df.schema:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(f.dataType, T.TimestampType):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType)):
            c = c.cast("long")
        shown.append(c.alias(f.name))
    return df.select(*shown)


def debounced_changes(t: Testdata, p: Params) -> DataFrame:
    return debounce.debounced(t.change_events(), GAP_SECONDS).select("key", F.col("ts").alias("changed_at"), "seq", "value")


def debounced_changes_stream(t: Testdata, p: Params) -> DataFrame:
    saved = debounce.run_debounce(t.spark, t.root, GAP_SECONDS)
    return saved.select("key", F.col("ts").alias("changed_at"), "seq", "value")


def _events(t: Testdata) -> DataFrame:
    return flows.entries(t.spark.read.parquet(f"{t.root}/events.parquet"))


def daily_ledger_flow(t: Testdata, p: Params) -> DataFrame:
    return flows.daily_flow(_events(t))


def daily_ledger_flow_stream(t: Testdata, p: Params) -> DataFrame:
    return flows.run_daily_flow(t.spark, t.root)


def ledger_totals(t: Testdata, p: Params) -> DataFrame:
    return flows.running_totals(_events(t))


def ledger_totals_stream(t: Testdata, p: Params) -> DataFrame:
    return flows.run_running_totals(t.spark, t.root)


_PLANS: list[Callable] = [
    catalog.products_by_name,
    catalog.clients_by_name,
    catalog.client_price_list,
    catalog.price_history,
    catalog.orders_with_client,
    catalog.order_documents,
    catalog.order_documents_flat,
    catalog.batches_with_product,
    catalog.payments_with_client,
    catalog.receivables_aging,
    catalog.sales_fact,
    catalog.client_order_count,
    catalog.client_orders,
    catalog.client_price_map,
    catalog.pricing_by_client,
    catalog.pricing_items_by_client,
    catalog.client_price_margin,
    documents.settings_resolved,
    documents.product_margins_table,
    documents.weight_variants_table,
    documents.ledger_entries,
    documents.ledger_bad_documents,
    orders.order_margin_zone,
    orders.line_revenue,
    orders.line_quantity,
    orders.pack_recovery_kg,
    orders.pack_recovery_client,
    orders.order_economics,
    orders.order_cost_breakdown,
    orders.orders_by_delivery_date,
    orders.client_order_number,
    orders.invoice_due_dates,
    orders.invoice_lines,
    orders.delivery_note_lines,
    orders.contact_links,
    orders.order_labels,
    orders.order_drafts,
    orders.reprice_lines_for_client,
    orders.dq_orders,
    pricing.suggested_price,
    pricing.suggested_pack_price,
    pricing.pricing_rows,
    pricing.pricing_rows_valid,
    pricing.pack_cost,
    pricing.margin_from_price,
    pricing.price_from_margin,
    pricing.reprice_pack_size,
    pricing.reprice_scenario,
    pricing.price_per_kg,
    pricing.default_variants,
    pricing.price_list_export,
    stock.batch_waste,
    stock.waste_tiers,
    stock.batch_order_links,
    stock.dq_batches,
    stock.dq_ledger,
    stock.dq_master_data,
    dashboard.weekly_kpis,
    dashboard.waste_totals,
    dashboard.receivables_totals,
    dashboard.base_cost_collected,
    dashboard.top_client_share,
    dashboard.cash_position,
    kept.kept_weekly_kpis,
    kept.kept_receivables,
    kept.kept_waste_totals,
    analytics.product_performance,
    analytics.product_trend,
    analytics.client_performance,
    analytics.analytics_summary,
    analytics.stock_recommendations,
    analytics.stock_rec_counts,
    analytics.price_suggestions,
    analytics.variant_sales_summary,
    analytics.variant_sales_sizes,
    maintenance.apply_product_changes,
    maintenance.apply_client_changes,
    maintenance.apply_price_changes,
    maintenance.apply_margin_changes,
    maintenance.apply_variant_changes,
    maintenance.apply_settings_changes,
    maintenance.price_fanout_clients,
    maintenance.price_apply_to_client,
    maintenance.apply_order_deletes,
    maintenance.create_orders_payments,
    maintenance.apply_order_updates,
    maintenance.deduct_waste,
    maintenance.batch_intake,
    maintenance.apply_payment_changes,
    maintenance.apply_ledger_changes,
    maintenance.intake_deductions,
    maintenance.intake_orders,
    maintenance.intake_links,
    maintenance.apply_batch_deletes,
    maintenance.rejected_writes,
    order_log.apply_order_log,
    debounced_changes,
    debounced_changes_stream,
    daily_ledger_flow,
    daily_ledger_flow_stream,
    ledger_totals,
    ledger_totals_stream,
]

_LOOKED_BACK = [analytics.stock_recommendations, analytics.stock_rec_counts, analytics.price_suggestions]


def _query(plan: Callable, params: Params = PARAMS) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain(plan(Testdata(tune(spark), sf_dir), params))

    run.__name__ = plan.__name__
    run.__doc__ = plan.__doc__
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {plan.__name__: _query(plan) for plan in _PLANS}
    return found | {f"{plan.__name__}_last_30_days": _query(plan, RECENT) for plan in _LOOKED_BACK}
