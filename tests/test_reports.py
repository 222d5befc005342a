"""Reports over a few hand-written rows; values worked out by hand."""

import datetime as dt
from dataclasses import replace
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from packhouse.config import Params
from packhouse.plans import analytics, catalog, dashboard, orders, pricing, stock
from small import Small, day

AS_OF = day("2001-08-01")
P = Params(as_of=AS_OF)


def back(days):
    return AS_OF - dt.timedelta(days=days)


def order(i, client="c", days=0, **rest):
    zero = dict(transport_cost=0, packaging_cost=0, total_revenue=0, total_cost=0, net_profit=0, margin_percentage=0)
    return {**zero, "id": str(i), "client_id": client, "order_date": back(days), "delivery_date": back(days), **rest}


def item(i, order_id, product="p", qty=1, revenue=10, cost=4, price=10):
    return {
        "id": str(i), "order_id": order_id and str(order_id), "product_id": product, "quantity": qty, "selling_price_used": price,
        "cost_used": cost, "total_revenue": revenue, "total_cost": cost,
    }


PRODUCT = {"id": "p", "name": "Tomato", "unit": "kg", "cost_per_unit": 4}


def test_trend_windows(spark):
    days = [6, 7, 8, 13, 14, -3]
    t = Small(
        spark,
        products=[PRODUCT, {"id": "new", "name": "New"}, {"id": "old", "name": "Old"}],
        orders=[order(n, days=d) for n, d in enumerate(days)],
        order_items=[item(n, n, revenue=10**n) for n in range(len(days))] + [item("x", 0, "new"), item("y", 4, "old")],
    )
    got = {r.product_id: r for r in analytics.product_trend(t, P).collect()}
    # Recent: 6 days ago and the future; previous: 7, 8 and 13 days ago; 14 is too old.
    assert float(got["p"].recent_revenue) == 100001 and float(got["p"].previous_revenue) == 1110
    assert got["p"].trend == "up"
    assert (got["new"].trend_pct, got["new"].trend) == (100.0, "up")
    assert (got["old"].trend_pct, got["old"].trend) == (0.0, "flat")


def test_weekly_bounds(spark):
    t = Small(
        spark,
        orders=[
            order(1, days=7, total_revenue=100, net_profit=50, transport_cost=5, margin_percentage=80),
            order(2, days=8, total_revenue=1000),
            order(3, days=0, total_revenue=100, net_profit=-20, packaging_cost=15, margin_percentage=-20),
        ],
        order_items=[item(1, 1, cost=40), item(2, 1, cost=10), item(3, 2, cost=999)],
    )
    r = dashboard.weekly_kpis(t, P).first()
    assert (r.orders, float(r.revenue), float(r.profit), r.avg_margin, r.avg_margin_zone) == (2, 200.0, 30.0, 30.0, "red")
    assert (float(r.base_cost), float(r.total_cost), r.base_pct, r.total_cost_pct) == (50.0, 70.0, 25.0, 35.0)


def test_weekly_without_orders(spark):
    r = dashboard.weekly_kpis(Small(spark), P).first()
    assert (r.orders, float(r.revenue), r.avg_margin, float(r.total_cost), r.base_pct) == (0, 0.0, 0.0, 0.0, 0.0)


def test_product_performance(spark):
    t = Small(
        spark,
        products=[PRODUCT, {"id": "q", "name": "Melon", "unit": "pc", "cost_per_unit": 1}],
        order_items=[
            item(1, 1, qty=2, revenue=60, cost=30, price=30),
            item(2, 1, qty=0, revenue=0, cost=0, price=0),
            item(3, 1, "q", qty=0, revenue=0, cost=5, price=None),
            item(4, 1, None, revenue=40),
            item(5, 1, "missing", revenue=40),
        ],
    )
    got = {r.product_id: r for r in analytics.product_performance(t, P).collect()}
    assert set(got) == {"p", "q"}
    p = got["p"]
    assert (p.order_count, p.avg_price, p.min_price, p.max_price, p.margin, p.revenue_share) == (2, 30.0, 0.0, 30.0, 50.0, 100.0)
    assert (p.margin_tier, p.share_tier) == ("high", "high")
    assert (got["q"].avg_price, got["q"].margin, got["q"].max_price, got["q"].margin_tier) == (0.0, 0.0, 0.0, "low")


def test_client_performance(spark):
    t = Small(
        spark,
        products=[PRODUCT],
        clients=[{"id": "c", "name": "Nile"}, {"id": "idle", "name": "Idle"}],
        orders=[order(1), order(2), order(3, "idle"), order(4, "nameless")],
        order_items=[item(1, 1, revenue=30), item(2, 1, revenue=20), item(3, 99, revenue=50), item(4, 4, None, revenue=7)],
    )
    got = {r.client_id: r for r in analytics.client_performance(t, P).collect()}
    assert set(got) == {"c", "unknown", "nameless"}  # a client without lines is not listed
    assert (got["c"].client_name, float(got["c"].total_revenue), got["c"].total_orders, got["c"].revenue_share) == ("Nile", 50.0, 2, 50.0)
    assert (got["unknown"].client_name, got["unknown"].total_orders) == ("Unknown", 0)
    assert (got["nameless"].client_name, got["nameless"].revenue_share) == ("Unknown", pytest.approx(7.0))
    summary = analytics.analytics_summary(t, P).first()
    assert (float(summary.total_revenue), summary.total_orders, summary.products_sold, summary.active_clients) == (100.0, 4, 1, 3)


def test_concentration(spark):
    losses = Small(spark, orders=[order(1, "a", total_revenue=-5), order(2, "b", total_revenue=0)])
    assert dashboard.top_client_share(losses, P).first().top_client_pct == 0.0
    assert dashboard.top_client_share(Small(spark), P).first().top_client_pct == 0.0
    one = dashboard.top_client_share(Small(spark, orders=[order(1, total_revenue=5)]), P).first()
    assert (one.top_client_pct, one.alert) == (100.0, True)


def stock_of(spark, lines, qty, span):
    t = Small(
        spark,
        products=[PRODUCT],
        orders=[order(1, days=0), order(2, days=span)],
        order_items=[item(n, 1, qty=qty / lines) for n in range(lines)],
    )
    r = analytics.stock_recommendations(t, P).first()
    return r.recommendation, r.velocity


def test_stock_rule(spark):
    assert stock_of(spark, 4, 20, 10) == ("stable", 2.0)  # velocity must exceed 2
    assert stock_of(spark, 4, 22, 10) == ("increase", 2.2)
    assert stock_of(spark, 1, 5, 10) == ("stable", 0.5)  # velocity must be below 0.5
    assert stock_of(spark, 1, 4, 10) == ("decrease", 0.4)
    assert stock_of(spark, 4, 8, 0) == ("increase", 8.0)  # one day counts as a span of 1


def test_lookback(spark):
    t = Small(spark, products=[PRODUCT], orders=[order(1, days=29), order(2, days=30)], order_items=[item(1, 1), item(2, 2)])
    r = analytics.stock_recommendations(t, replace(P, lookback_days=30)).first()
    assert (r.order_count, r.velocity) == (1, 1.0)


def tips(spark, items, cost=4, margin=None):
    t = Small(
        spark,
        products=[{**PRODUCT, "cost_per_unit": cost}],
        order_items=items,
        margins=[{"product_id": "p", "profit_margin_pct": margin}] if margin else [],
    )
    return {r.rule: r for r in analytics.price_suggestions(t, P).collect()}


def test_price_suggestions(spark):
    busy = [item(n, 1, revenue=10, cost=8, price=p) for n, p in enumerate((9, 10, 12))]
    got = tips(spark, busy, cost=20)
    assert set(got) == {"raise_price", "standardise", "underpriced"}
    assert got["raise_price"].target_price == 11.0 and got["raise_price"].metric == pytest.approx(20.0)
    assert got["underpriced"].target_price == 23.0
    assert got["standardise"].metric == pytest.approx(100 / 3)
    quiet = tips(spark, [item(1, 1, revenue=10, cost=2)])
    assert set(quiet) == {"lower_price"} and quiet["lower_price"].metric == 80.0


def test_price_suggestion_limits(spark):
    assert tips(spark, [item(n, 1, revenue=4, cost=3, price=4) for n in range(3)], cost=0) == {}  # margin 25
    assert tips(spark, [item(1, 1, revenue=10, cost=6)], cost=0) == {}  # margin 40
    assert tips(spark, [item(1, 1, price=10), item(2, 1, price=12)], cost=0) == {}  # spread 20
    assert tips(spark, [item(1, 1, price=0), item(2, 1, price=12)], cost=0) == {}  # no lowest price


def test_cash(spark):
    ledger = [
        {"id": "1", "type": "initial", "amount": 100},
        {"id": "2", "type": "deposit", "amount": 50},
        {"id": "3", "type": "withdrawal", "amount": 30},
        {"id": "4", "type": "gift", "amount": 999},
    ]
    payments = [{"id": "1", "amount": 10, "status": "paid"}, {"id": "2", "amount": 7, "status": "pending"}, {"id": "3", "amount": 1, "status": None}]
    t = Small(spark, ledger=ledger, payments=payments, orders=[order(1)], order_items=[item(1, 1, cost=4)])
    r = dashboard.cash_position(t, P).first()
    assert [float(v) for v in (r.manual_cash, r.collected, r.expected_in, r.farmer_owed, r.cash_in_hand, r.projected)] == [120, 10, 8, 4, 130, 134]
    empty = dashboard.cash_position(Small(spark), P).first()
    assert float(empty.projected) == 0.0


def test_base_cost_counts_once_per_paid_payment(spark):
    pays = [{"id": "1", "order_id": "1", "status": "paid"}, {"id": "2", "order_id": "1", "status": "paid"}, {"id": "3", "order_id": "2", "status": "pending"}]
    t = Small(spark, payments=pays, order_items=[item(1, 1, cost=4), item(2, 1, cost=6), item(3, 2, cost=100)])
    assert float(dashboard.base_cost_collected(t, P).first()[0]) == 20.0


def test_aging(spark):
    def pay(i, days, status="pending"):
        return {"id": i, "order_id": "1", "amount": 1, "due_date": back(days), "status": status}

    t = Small(spark, payments=[pay("today", 0), pay("yesterday", 1), pay("tomorrow", -1), pay("paid", 9, "paid")], orders=[order(1)])
    got = {r.id: (r.is_overdue, r.badge, r.days_text, r.client_name) for r in catalog.receivables_aging(t, P).collect()}
    assert got == {
        "today": (False, "pending", "0d left", "—"),
        "yesterday": (True, "overdue", "1d overdue", "—"),
        "tomorrow": (False, "pending", "1d left", "—"),
        "paid": (False, "paid", "—", "—"),
    }


def test_totals_agree(spark):
    t = Small(
        spark,
        products=[PRODUCT],
        payments=[{"id": str(n), "amount": n + 0.25, "status": ["paid", "pending", None][n % 3]} for n in range(20)],
        orders=[order(1), order(2, "d")],
        order_items=[item(1, 1, revenue=3), item(2, 2, None, revenue=5), item(3, 9, revenue=11)],
    )
    r = dashboard.receivables_totals(t, P).first()
    assert r.outstanding + r.collected == t.payments().agg(F.sum("amount")).first()[0]
    products = analytics.product_stats(t, P).agg(F.sum("total_revenue")).first()[0]
    clients = analytics.client_stats(t, P).agg(F.sum("total_revenue")).first()[0]
    assert products + Decimal(5) == clients


def test_orders_without_a_date(spark):
    t = Small(spark, orders=[order(1, total_revenue=5), order(2, delivery_date=None, total_revenue=7)])
    got = {r.delivery_day: float(r.total_revenue) for r in orders.orders_by_delivery_date(t, P).collect()}
    assert got == {"2001-08-01": 5.0, "Unknown": 7.0}


def test_order_numbers(spark):
    rows = [order("b", days=3), order("a", days=3), order("c", days=9), order("d", None, days=1), order("e", days=0, order_date=None)]
    got = {r.order_id: (r.client_id, r.order_number) for r in orders.client_order_number(Small(spark, orders=rows), P).collect()}
    assert got == {"e": ("c", 1), "c": ("c", 2), "a": ("c", 3), "b": ("c", 4), "d": ("", 1)}


def test_line_quantities(spark):
    def line(i, product, size="", packs="", qty=""):
        return {"id": i, "product_id": product, "package_size": size, "num_packages": packs, "qty": qty}

    t = Small(
        spark,
        products=[PRODUCT, {"id": "q", "unit": "pc"}],
        draft_lines=[line("kg", "p", "0.25kg", "4.9", "99"), line("blank", "p", "", "4"), line("pc", "q", "0.5", "9", "3 pcs"), line("none", "q"), line("lost", "zz", "1", "1", "2")],
    )
    got = {r.item_id: (r.quantity, r.accepted) for r in orders.line_quantity(t, P).collect()}
    assert got == {"kg": (1.0, True), "blank": (0.0, False), "pc": (3.0, True), "none": (0.0, False), "lost": (2.0, True)}


def test_order_rules(spark):
    t = Small(
        spark,
        orders=[
            order("ok"), order("none"), order("anon", None), order("late", delivery_date=back(5)), order("neg", transport_cost=-1),
            order("bad"), order("many", "", transport_cost=-1),
        ],
        order_items=[item(n, o) for n, o in enumerate(("ok", "anon", "late", "neg"))]
        + [item("z", "bad", price=0), item("y", "bad", qty=0), item("w", "bad")],
    )
    got = {r.order_id: r.failures for r in orders.dq_orders(t, P).collect()}
    assert got == {
        "ok": "", "none": "no_items", "anon": "client_missing", "late": "delivery_before_order", "neg": "transport_negative",
        "bad": "bad_line", "many": "client_missing,no_items,transport_negative",
    }


def test_waste_links(spark):
    def batch(i):
        return {"id": i, "product_id": "p" + i, "harvest_date": "2001-01-01"}

    def link(key, to):
        return {"link_key": key, "client_id": to, "order_id": to}

    t = Small(
        spark,
        batches=[batch(i) for i in "1234"],
        waste_links=[link("1", "by id"), link("p2_2001-01-01", "by date"), link("3", "first"), link("p3_2001-01-01", "second")],
    )
    got = {r.batch_id: r.order_id for r in stock.batch_order_links(t, P).collect()}
    assert got == {"1": "by id", "2": "by date", "3": "first", "4": None}


def test_calculator(spark):
    t = Small(
        spark,
        products=[{"id": "a", "cost_per_unit": 10}, {"id": "b", "cost_per_unit": 10}, {"id": "z", "cost_per_unit": 0}],
        variants=[{"product_id": "a", "position": 0, "weight": 0.5, "price": 7}, {"product_id": "a", "position": 1, "weight": 1.0, "price": 1}, {"product_id": "z", "position": 0, "weight": 1.0, "price": 3}],
        pricing_entries=[{"product_id": p, "new_size": s, "new_price": "20 EGP", "new_margin": "10"} for p, s in (("a", "2"), ("b", ""), ("z", "0"))],
    )
    got = {r.product_id: tuple(r)[1:] for r in pricing.pricing_rows(t, P).collect()}
    assert got == {"a": (0.5, 7.0, 21.7), "b": (1.0, 11.5, 0.0), "z": (1.0, 3.0, 0.0)}
    sized = {r.product_id: (r.pack_size, r.pack_price) for r in pricing.reprice_pack_size(t, P).collect()}
    assert sized == {"a": (2.0, 27.99), "b": (1.0, 11.5), "z": (1.0, 0.0)}
    margins = {r.product_id: r.profit_margin for r in pricing.margin_from_price(t, P).collect()}
    assert margins == {"a": 247.8, "b": 73.9, "z": 0.0}


def test_nested_orders(spark):
    t = Small(spark, products=[PRODUCT], clients=[{"id": "c", "name": "Nile"}], orders=[order(1), order(2)], order_items=[item("x", 1), item("w", 1)])
    got = sorted((r.order_id, r.position, r.item_id, r.client_name) for r in catalog.order_documents(t, P).collect())
    assert got == [("1", 1, "w", "Nile"), ("1", 2, "x", "Nile"), ("2", 0, None, "Nile")]
    flat = [(r.order_id, r.item_id) for r in catalog.order_documents_flat(t, P).collect()]
    assert sorted(flat, key=str) == [("1", "w"), ("1", "x"), ("2", None)]


def test_history_needs_both_ids(spark):
    t = Small(spark, price_history=[{"id": str(n), "client_id": "c", "product_id": "p", "selling_price": n, "changed_at": dt.datetime(2001, 1, n)} for n in (1, 3, 2)])
    assert [r.id for r in catalog.price_history_of(t, P, "c", "p").collect()] == ["3", "2", "1"]
    assert catalog.price_history_of(t, P, "c", None).count() == 0
    assert {r.id: r.version for r in catalog.price_history(t, P).collect()} == {"3": 1, "2": 2, "1": 3}
