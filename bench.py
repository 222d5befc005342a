"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR   tables to read (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default: all)
BENCH_QUERIES  comma-separated names, or ``all`` (default: the list below)
BENCH_RUNS     timed runs after one warm-up; the median counts (default 1)
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from packhouse.plans.registry import queries  # noqa: E402
from packhouse.session import local_session  # noqa: E402

HEADLINE = [
    "product_performance",
    "product_trend",
    "client_performance",
    "analytics_summary",
    "stock_recommendations",
    "price_suggestions",
    "weekly_kpis",
    "receivables_totals",
    "base_cost_collected",
    "top_client_share",
    "cash_position",
    "waste_totals",
    "sales_fact",
    "order_economics",
    "order_cost_breakdown",
    "orders_by_delivery_date",
    "client_order_number",
    "price_history",
    "client_price_margin",
    "receivables_aging",
    "invoice_lines",
    "delivery_note_lines",
    "order_documents",
    "batch_order_links",
    "price_list_export",
    "reprice_scenario",
    "dq_orders",
    "apply_product_changes",
    "apply_price_changes",
    "apply_order_deletes",
    "apply_order_updates",
    "create_orders_payments",
    "deduct_waste",
    "batch_intake",
    "debounced_changes",
    "daily_ledger_flow",
]


def run(plan, spark, sf_dir: str) -> float:
    start = time.perf_counter()
    plan(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    plans = queries()
    wanted = os.environ.get("BENCH_QUERIES", "")
    names = list(plans) if wanted == "all" else wanted.split(",") if wanted else HEADLINE

    spark = local_session("packhouse-bench", cpus=cpus, partitions=int(cpus) if cpus.isdigit() else 8)
    seconds = {}
    for name in names:
        run(plans[name], spark, sf_dir)
        seconds[name] = round(statistics.median(run(plans[name], spark, sf_dir) for _ in range(runs)), 3)
    spark.stop()

    found = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": float(found.group(1)) if found else None,
    }
    print(json.dumps(out))


if __name__ == "__main__":
    main()
