"""Snapshots under change tables."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from packhouse.config import Params, Settings
from packhouse.operators.changes import apply_changes
from packhouse.plans import maintenance as m
from small import Small, day, frame

P = Params(as_of=day("2001-08-01"))
T0 = dt.datetime(2001, 1, 1)


def at(minutes):
    return T0 + dt.timedelta(minutes=minutes)


@pytest.fixture(scope="module")
def snapshot(spark):
    return frame(spark, "id string, name string, unit string", [{"id": "a", "name": "A", "unit": "kg"}, {"id": "b", "name": "B", "unit": "pc"}, {"id": "c", "name": "C", "unit": "kg"}])


CHANGES = "id string, name string, op string, changed_at timestamp, seq long"


def result(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


def test_upsert_and_delete(spark, snapshot):
    changes = frame(
        spark,
        CHANGES,
        [
            {"id": "a", "name": "first", "op": "upsert", "changed_at": at(1), "seq": 1},
            {"id": "a", "name": "last", "op": "upsert", "changed_at": at(1), "seq": 2},
            {"id": "b", "name": "gone", "op": "delete", "changed_at": at(1), "seq": 1},
            {"id": "b", "name": "back", "op": "upsert", "changed_at": at(2), "seq": 1},
            {"id": "c", "name": None, "op": "upsert", "changed_at": at(2), "seq": 1},
            {"id": "d", "name": "new", "op": "upsert", "changed_at": at(2), "seq": 1},
            {"id": "e", "name": "x", "op": "delete", "changed_at": at(2), "seq": 1},
        ],
    )
    once = apply_changes(snapshot, changes, ["id"], ["name"])
    assert result(once) == {"a": ("last", "kg"), "b": ("back", None), "c": (None, "kg"), "d": ("new", None)}
    twice = apply_changes(once, changes, ["id"], ["name"])
    assert result(twice) == result(once)


def test_repartitioning_changes_nothing(spark, snapshot):
    changes = frame(spark, CHANGES, [{"id": "a", "name": str(i), "op": "upsert", "changed_at": at(i % 3), "seq": i} for i in range(50)])
    one = apply_changes(snapshot, changes.coalesce(1), ["id"], ["name"])
    many = apply_changes(snapshot.repartition(7), changes.repartition(11), ["id"], ["name"])
    assert result(one) == result(many) and result(one)["a"][0] == "47"


def small_shop(spark):
    return Small(
        spark,
        clients=[{"id": "s", "name": "Super", "type": "supermarket", "credit_days": 0}, {"id": "r", "name": "Rest", "type": "restaurant", "credit_days": 15}],
        products=[{"id": "p", "name": "Tomato", "unit": "kg", "cost_per_unit": 10}, {"id": "q", "name": "Melon", "unit": "pc", "cost_per_unit": 5}],
        orders=[
            {"id": "1", "client_id": "s", "order_date": "2001-01-01", "delivery_date": "2001-01-02", "transport_cost": 1, "packaging_cost": 1, "total_revenue": 100, "total_cost": 40, "net_profit": 60, "margin_percentage": 60, "margin_zone": "red"},
            {"id": "2", "client_id": "r", "order_date": "2001-01-01", "delivery_date": "2001-01-02", "transport_cost": 0, "packaging_cost": 0, "total_revenue": 50, "total_cost": 10, "net_profit": 40, "margin_percentage": 80, "margin_zone": "green"},
        ],
        order_items=[
            {"id": "i1", "order_id": "1", "product_id": "p", "quantity": 3, "selling_price_used": 5, "cost_used": 10, "total_revenue": 60, "total_cost": 30},
            {"id": "i2", "order_id": "1", "product_id": "q", "quantity": 2, "selling_price_used": 20, "cost_used": 5, "total_revenue": 40, "total_cost": 10},
            {"id": "i3", "order_id": "2", "product_id": "q", "quantity": 2, "selling_price_used": 25, "cost_used": 5, "total_revenue": 50, "total_cost": 10},
        ],
        payments=[{"id": "y1", "order_id": "1", "amount": 100, "due_date": "2001-02-01", "status": "pending"}],
    )


def test_order_delete_takes_dependents(spark):
    t = small_shop(spark)
    ids = frame(spark, "id string", [{"id": "1"}, {"id": "1"}, {"id": "9"}])
    orders, items, payments = m.delete_orders(t.orders(), t.order_items(), t.payments(), ids)
    assert [r.id for r in orders.collect()] == ["2"]
    assert [r.id for r in items.collect()] == ["i3"]
    assert payments.count() == 0


def test_create_orders(spark):
    t = small_shop(spark)
    headers = t.orders("id", "client_id", "order_date", "delivery_date", "transport_cost", "packaging_cost")
    lines = t.order_items("id", "order_id", "product_id", "quantity", "selling_price_used", "cost_used").withColumn(
        "num_packages", F.when(F.col("product_id") == "p", 12.0)
    )
    orders, items, payments = m.create_orders(headers, lines, t.clients(), P)
    got = {r.id: r for r in orders.collect()}
    assert got["1"].total_revenue == Decimal("100.00")  # 5 x 12 packs + 20 x 2
    assert got["1"].total_cost == Decimal("42.00") and got["1"].net_profit == Decimal("58.00")
    assert got["1"].margin_percentage == 58.0 and got["1"].margin_zone == "red"
    due = {r.order_id: (r.amount, str(r.due_date)) for r in payments.collect()}
    assert due == {"1": (Decimal("100.00"), "2001-02-01"), "2": (Decimal("50.00"), "2001-01-17")}
    assert items.count() == 3


def test_update_replaces_all_lines(spark):
    t = small_shop(spark)
    headers = t.orders("id", "client_id", "order_date", "delivery_date", "transport_cost", "packaging_cost")
    lines = frame(
        spark,
        "id string, order_id string, product_id string, quantity decimal(18,2), selling_price_used double, cost_used decimal(18,2), num_packages double",
        [
            {"id": "n1", "order_id": "1", "product_id": "q", "quantity": 4, "selling_price_used": 30, "cost_used": 5},
            {"id": "n2", "order_id": "2", "product_id": "q", "quantity": 1, "selling_price_used": 30, "cost_used": 5},
            {"id": "n3", "order_id": "77", "product_id": "q", "quantity": 1, "selling_price_used": 30, "cost_used": 5},
        ],
    )
    args = (headers.withColumn("delivery_date", F.lit(day("2001-03-01"))), lines, t.clients(), P)
    orders, items, payments = m.update_orders(t.orders(), t.order_items(), t.payments("id", "order_id", "amount", "due_date"), *args)
    assert sorted(r.id for r in items.collect()) == ["n1", "n2"]
    got = {r.id: (r.total_revenue, str(r.delivery_date)) for r in orders.collect()}
    assert got == {"1": (Decimal("120.00"), "2001-03-01"), "2": (Decimal("30.00"), "2001-03-01")}
    # Order 2 has no payment, and gets none.
    assert [(r.order_id, r.amount, str(r.due_date)) for r in payments.collect()] == [("1", Decimal("120.00"), "2001-03-31")]
    again = m.update_orders(orders, items, payments, *args)
    assert sorted(again[0].collect()) == sorted(orders.collect())
    assert sorted(again[1].collect()) == sorted(items.collect())


def test_waste_deduction(spark):
    t = small_shop(spark)
    taken = frame(
        spark,
        "order_id string, waste_value decimal(18,4)",
        [{"order_id": "1", "waste_value": 30}, {"order_id": "1", "waste_value": 90}, {"order_id": "2", "waste_value": 10}, {"order_id": "2", "waste_value": -5}, {"order_id": "9", "waste_value": 1}],
    )
    orders, payments = m.subtract_waste(t.orders(), t.payments(), taken)
    got = {r.id: (r.total_revenue, r.net_profit, r.margin_percentage) for r in orders.collect()}
    assert got == {"1": (0, -60, 60.0), "2": (40, 30, 80.0)}
    assert [r.amount for r in payments.collect()] == [0]


def test_batches(spark):
    t = Small(
        spark,
        products=[{"id": "p", "unit": "kg", "cost_per_unit": 10}, {"id": "q", "unit": "pc", "cost_per_unit": 4}],
        batches=[
            {"id": "b1", "product_id": "p", "harvest_date": "2001-01-01", "harvested_qty": 10, "sold_qty": 1, "damaged_qty": 1, "expired_qty": 0, "waste_percentage": 10, "waste_value": 12.5},
            {"id": "b2", "product_id": "q", "harvest_date": "2001-01-01", "harvested_qty": 10, "sold_qty": 1, "damaged_qty": 1, "expired_qty": 0, "waste_percentage": 10, "waste_value": 7.77},
        ],
    )
    forms = frame(
        spark,
        "id string, product_id string, harvest_date date, harvested_qty decimal(18,2), sold_qty decimal(18,2), damaged_pkg_size double, "
        "damaged_count long, expired_pkg_size double, expired_count long, packaging_cost decimal(18,2)",
        [
            {"id": "n1", "product_id": "p", "harvest_date": "2001-02-01", "harvested_qty": 20, "damaged_pkg_size": 0.25, "damaged_count": 4, "expired_pkg_size": 0.5, "expired_count": 2, "packaging_cost": 0.5},
            {"id": "n2", "product_id": "q", "harvest_date": "2001-02-01", "harvested_qty": 0, "damaged_pkg_size": 0.25, "damaged_count": 4},
            {"id": "n3", "product_id": "q", "harvest_date": "2001-02-01", "harvested_qty": None},
            {"id": "n4", "product_id": "q", "harvest_date": "2001-02-01", "harvested_qty": 5, "damaged_count": -1},
        ],
    )
    edits = frame(
        spark,
        "id string, harvested_qty decimal(18,2), damaged_qty decimal(18,2), expired_qty decimal(18,2)",
        [{"id": "b1", "harvested_qty": 20, "damaged_qty": 2, "expired_qty": None}],
    )
    got = {r.id: (float(r.damaged_qty), float(r.expired_qty), r.waste_percentage, float(r.waste_value)) for r in m.apply_batches(t.batches(), forms, edits, t.products()).collect()}
    assert got == {
        "b1": (2.0, 0.0, 10.0, 20.0),  # the edit knows no packaging cost
        "b2": (1.0, 0.0, 10.0, 7.77),
        "n1": (1.0, 1.0, 10.0, 21.0),
        "n2": (4.0, 0.0, 0.0, 16.0),
    }


def test_payments(spark):
    t = Small(spark, payments=[{"id": i, "order_id": i, "amount": 10, "status": "pending"} for i in "abcd"])
    actions = frame(
        spark,
        "id string, action string, amount decimal(18,2), changed_at timestamp, seq long",
        [
            {"id": "a", "action": "mark_paid", "changed_at": at(0), "seq": 1},
            {"id": "b", "action": "set_amount", "amount": 7, "changed_at": at(2), "seq": 1},
            {"id": "b", "action": "set_amount", "amount": 8, "changed_at": at(1), "seq": 9},
            {"id": "c", "action": "set_amount", "amount": 1, "changed_at": at(9), "seq": 1},
            {"id": "c", "action": "delete", "changed_at": at(1), "seq": 1},
        ],
    )
    got = {r.id: (float(r.amount), r.status, r.paid_date and str(r.paid_date)) for r in m.change_payments(t.payments(), actions).collect()}
    assert got == {"a": (10.0, "paid", "2001-01-01"), "b": (7.0, "pending", None), "d": (10.0, "pending", None)}


def test_ledger(spark):
    ddl = "id string, date date, type string, amount decimal(18,2), description string"
    old = frame(spark, ddl, [{"id": "1", "amount": 5, "description": "x"}, {"id": "2", "amount": 5, "description": "y"}])
    new = frame(spark, ddl, [{"id": "3", "amount": 5, "description": " z "}, {"id": "4", "amount": 0, "description": "z"}, {"id": "5", "amount": 1, "description": "  "}])
    left = m.change_ledger(old, new, frame(spark, "id string", [{"id": "1"}]))
    assert {r.id: r.description for r in left.collect()} == {"2": "y", "3": "z"}


def test_fanout_skips_offers_without_a_price(spark):
    offers = frame(spark, "request_id string, product_id string, selling_price decimal(18,2)", [{"request_id": "1", "product_id": "p", "selling_price": 3}, {"request_id": "2", "product_id": "q", "selling_price": 0}])
    picks = frame(spark, "request_id string, client_id string", [{"request_id": "1", "client_id": "a"}, {"request_id": "1", "client_id": "b"}, {"request_id": "2", "client_id": "a"}])
    assert sorted((r.client_id, r.product_id) for r in m.offered_prices(offers, picks).collect()) == [("a", "p"), ("b", "p")]


def test_settings_are_replaced_whole():
    assert m.replaced_settings(Settings(15, 3), overhead_pct=20) == Settings(20, 0)
    assert m.replaced_settings(Settings(15, 3)) == Settings(15, 3)
