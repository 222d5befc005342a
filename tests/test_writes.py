"""Writes with their rules: what is refused, and what an intake and a delete take along."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from packhouse.config import Params
from packhouse.operators import quality
from packhouse.plans import maintenance as m
from packhouse.sources.lake import Lake
from packhouse.sources.testdata import Testdata
from small import Small, day, frame

SF = "/root/testdata/sf0.001"
P = Params(as_of=day("2001-08-01"))
FORMS = (
    "id string, product_id string, harvest_date date, harvested_qty decimal(18,2), sold_qty decimal(18,2), damaged_pkg_size double, "
    "damaged_count double, expired_pkg_size double, expired_count double, packaging_cost decimal(18,2), order_id string"
)
LINES = "id string, order_id string, product_id string, quantity decimal(18,2), selling_price_used double, cost_used decimal(18,2), num_packages double"


def shop(spark):
    return Small(
        spark,
        clients=[{"id": "s", "name": "Super", "type": "supermarket"}, {"id": "n", "name": None}],
        products=[{"id": "p", "unit": "kg", "cost_per_unit": 10}, {"id": "q", "unit": "pc", "cost_per_unit": 4}],
        orders=[
            {"id": "order-number-1", "client_id": "s", "order_date": "2001-01-01", "delivery_date": "2001-01-02", "transport_cost": 0, "total_revenue": 30, "net_profit": 5},
            {"id": "order-number-2", "client_id": "n", "order_date": "2001-01-01", "delivery_date": "2001-01-02", "transport_cost": 0, "total_revenue": 100, "net_profit": 50},
        ],
        payments=[{"id": "y1", "order_id": "order-number-1", "amount": 30}],
        batches=[{"id": "b1", "product_id": "p", "harvest_date": "2001-01-01", "harvested_qty": 10}, {"id": "b2", "product_id": "p", "harvest_date": "2001-01-01"}, {"id": "b3", "product_id": "q", "harvest_date": "2001-01-05"}],
        waste_links=[{"link_key": k, "order_id": "x"} for k in ("b1", "b3", "p_2001-01-01", "q_2001-01-05", "q_1999-09-09")],
    )


def intake(spark, forms):
    t = shop(spark)
    return m.take_in(t, frame(spark, FORMS, forms), t.batches(), t.orders(), t.payments())


def test_intake_takes_waste_off_its_order(spark):
    form = {"product_id": "p", "harvest_date": "2001-02-01", "harvested_qty": 20, "damaged_pkg_size": 0.333, "damaged_count": 1.0, "expired_pkg_size": 0.5, "expired_count": 2.0, "packaging_cost": "0.5"}
    done = intake(
        spark,
        [
            {"id": "n1", **form, "order_id": "order-number-1"},  # 1.333 kg x 10.50, not rounded
            {"id": "n2", **form, "product_id": "q", "harvest_date": "2001-01-05", "order_id": "order-number-2"},  # 3 pieces x 4.50
            {"id": "n3", **form, "order_id": None},
            {"id": "n4", **form, "order_id": "unknown"},
            {"id": "n5", **form, "damaged_count": 0.0, "expired_count": 0.0, "order_id": "order-number-2"},
            {"id": "n6", **form, "harvested_qty": -1, "order_id": "order-number-2"},
            {"id": "n7", **form, "order_id": "order-number-1"},
        ],
    )
    assert {r.batch_id: r.waste_value for r in done.deductions.collect()} == {"n1": Decimal("13.9965"), "n2": Decimal("13.5"), "n7": Decimal("13.9965")}
    assert {r.id: (r.total_revenue, r.net_profit) for r in done.orders.collect()} == {
        "order-number-1": (Decimal("2.007"), Decimal("-22.993")), "order-number-2": (Decimal("86.5"), Decimal("36.5")),
    }
    assert [(r.order_id, r.amount) for r in done.payments.collect()] == [("order-number-1", Decimal("2.007"))]
    links = {r.link_key: (r.order_id, r.client_name, r.order_label) for r in done.links.collect()}
    assert links["p_2001-02-01"] == ("order-number-1", "Super", "Super - 2001-01-02")
    assert links["q_2001-01-05"] == ("order-number-2", "", "order-nu") and len(links) == 6
    assert {r.id for r in done.batches.collect()} == {"b1", "b2", "b3", "n1", "n2", "n3", "n4", "n5", "n7"}
    assert [(r.id, r.failures) for r in done.rejected.collect()] == [("n6", ["harvested_negative"])]


def test_deletes_leave_no_dangling_link(spark):
    t = shop(spark)

    def after(*ids):
        left, links = m.delete_batches(t.batches(), t.waste_links(), frame(spark, "id string", [{"id": i} for i in ids]))
        return sorted(r.id for r in left.collect()), sorted(r.link_key for r in links.collect())

    # Another batch of that product and day keeps the link by product and day.
    assert after("b1") == (["b2", "b3"], ["b3", "p_2001-01-01", "q_1999-09-09", "q_2001-01-05"])
    assert after("b1", "b2", "b2") == (["b3"], ["b3", "q_1999-09-09", "q_2001-01-05"])
    assert after("b3", "unknown") == (["b1", "b2"], ["b1", "p_2001-01-01", "q_1999-09-09"])
    assert after() == (["b1", "b2", "b3"], ["b1", "b3", "p_2001-01-01", "q_1999-09-09", "q_2001-01-05"])


def test_refused_order_forms(spark):
    """Each rule, alone and together; a refused update leaves its order as it was."""
    t = shop(spark)
    ddl = "id string, client_id string, order_date date, delivery_date date, transport_cost decimal(18,2), packaging_cost decimal(18,2)"
    fine = {"client_id": "s", "order_date": "2001-01-01", "delivery_date": "2001-01-01", "transport_cost": 0, "packaging_cost": 0}
    headers = frame(
        spark,
        ddl,
        [
            {"id": "order-number-1", **fine, "transport_cost": -1}, {"id": "order-number-2", **fine}, {"id": "3", **fine, "client_id": None},
            {"id": "4", **fine, "delivery_date": "2000-12-31"}, {"id": "5", **fine}, {"id": "6", **fine},
        ],
    )
    line = {"product_id": "q", "quantity": 2, "selling_price_used": 5, "cost_used": 1}
    lines = frame(
        spark,
        LINES,
        [
            {"id": "a", "order_id": "order-number-1", **line}, {"id": "b", "order_id": "order-number-2", **line}, {"id": "c", "order_id": "order-number-2", **line, "quantity": 1},
            {"id": "d", "order_id": "4", **line}, {"id": "e", "order_id": "5", **line}, {"id": "f", "order_id": "5", **line, "selling_price_used": 0, "quantity": -1}, {"id": "g", "order_id": "lost", **line},
        ],
    )
    clients = t.clients("id", "type", "credit_days")
    refused = {r.id: r.failures for r in m.refused_forms(headers, lines, clients).collect()}
    assert refused == {
        "order-number-1": ["transport_negative"], "3": ["client_missing", "no_items"], "4": ["delivery_before_order"],
        "5": ["price_missing", "quantity_not_positive"], "6": ["no_items"],
    }
    orders, items, payments = m.create_orders(headers, lines, clients, P)
    assert ([r.id for r in orders.collect()], sorted(r.id for r in items.collect()), [r.amount for r in payments.collect()]) == (["order-number-2"], ["b", "c"], [15])
    orders, items, payments = m.update_orders(t.orders(), t.order_items(), t.payments("order_id", "amount", "due_date"), headers, lines, clients, P)
    assert {r.id: r.total_revenue for r in orders.collect()} == {"order-number-1": 30, "order-number-2": 15}
    assert [r.amount for r in payments.collect()] == [30]


def test_refused_changes(spark):
    ddl = "client_id string, product_id string, selling_price decimal(18,2), op string, changed_at timestamp, seq long"
    at = {"changed_at": dt.datetime(2001, 1, 1), "seq": 1}
    changes = frame(spark, ddl, [{"client_id": "", "op": "upsert", **at}, {"client_id": "a", "product_id": "p", "op": "delete", **at}, {"client_id": "a", "product_id": "p", "selling_price": 0, "op": "upsert", **at}])
    good, bad = quality.split_changes(changes, quality.price_rules())
    assert good.count() == 2 and [r.failures for r in bad.collect()] == [["client_missing", "product_missing", "price_missing"]]


def test_rejects_are_counted_while_rows_are_written(spark, tmp_path):
    rows = frame(spark, "id string, amount decimal(18,2), description string", [{"id": "1", "amount": 1, "description": "x"}, {"id": "2", "amount": 0, "description": " "}])
    counts = Observation("ledger")
    quality.watched(quality.with_failures(rows, quality.ledger_rules()), counts).write.parquet(str(tmp_path / "out"))
    assert counts.get == {"rows": 2, "rejected": 1}


def test_every_rule_is_broken_by_some_write(spark):
    seen = {f for r in m.rejected_writes(Testdata(spark, SF), P).select("failures").distinct().collect() for f in r[0].split(",")}
    rules = [quality.order_form_rules(), quality.batch_rules(), quality.ledger_rules(), quality.product_rules(), quality.client_rules(), quality.price_rules(), quality.payment_rules()]
    assert seen == {n for r in rules for n in r}


@pytest.mark.parametrize("plan,most", [(m.create_orders_payments, {"order_items": 1, "orders": 3}), (m.apply_order_updates, {"order_update_lines": 1, "order_update_headers": 2, "order_items": 1, "orders": 1})])
def test_inputs_are_read_once(spark, tmp_path_factory, plan, most):
    """How often a job on stored tables reads each: lines once, headers for their lines' client type as well."""
    t, base = Testdata(spark, SF), str(tmp_path_factory.mktemp("lake"))
    for name, rows in {"orders": t.orders(), "order_items": t.order_items(), "clients": t.clients(), "products": t.products(), "payments": t.payments()}.items():
        rows.limit(50).write.parquet(f"{base}/{name}")
    for name, forms in {"form": t.order_forms(), "update": t.order_updates()}.items():
        for part, rows in zip(("headers", "lines"), forms):
            rows.limit(5).write.parquet(f"{base}/changes/order_{name}_{part}")
    text = plan(Lake(spark, base), P)._jdf.queryExecution().optimizedPlan().toString()
    leaves = plan(Lake(spark, base), P)._jdf.queryExecution().optimizedPlan().collectLeaves()
    files = [leaves.apply(i).relation().location().rootPaths().head().toString() for i in range(leaves.size())]
    found = {n: sum(f.endswith(f"/{n}") for f in files) for n in most}
    assert all(found[n] <= k for n, k in most.items()), (found, text)
