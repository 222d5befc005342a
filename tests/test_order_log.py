"""The order log: all actions at once against one after the other."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from packhouse.operators.slices import dealt, since_last
from packhouse.plans import order_log
from packhouse.sources.schemas import schema
from small import day, frame

T0 = dt.datetime(2001, 1, 1)
ZERO = Decimal(0)
ORDERS = ["id", *order_log.HEADER]
PAYMENTS = ["id", "order_id", "amount", "due_date", "paid_date", "status"]


def money(pick):
    return Decimal(pick.randrange(-2000, 30000)) / 100


def some(seed, n):
    pick = random.Random(seed)
    orders = [{"id": f"o{i}", "client_id": "c", "delivery_date": day("2001-01-05"), "total_revenue": pick.choice([None, money(pick)]), "net_profit": money(pick), "margin_zone": "green"} for i in range(8)]
    payments = [{"id": f"p{i}", "order_id": f"o{i}", "amount": money(pick), "due_date": day("2001-02-01"), "status": "pending"} for i in range(7)]
    payments.append({"id": "p6b", "order_id": "o6", "amount": Decimal(7), "status": "pending"})
    log = []
    for k in range(n):
        kind = pick.choice(["update", "deduct", "deduct", "deduct", "set_amount", "mark_paid"] + (["delete_payment", "delete_order"] if pick.random() < 0.15 else []))
        a = {"action_id": f"a{pick.randrange(n)}x{k % 7}", "order_id": f"o{min(pick.randrange(12), 9)}", "kind": kind, "changed_at": T0 + dt.timedelta(hours=pick.randrange(n))}
        if kind == "update":
            a |= {"client_id": "d", "delivery_date": day("2001-03-03"), "total_revenue": money(pick), "total_cost": ZERO, "net_profit": money(pick), "margin_percentage": 5.0, "margin_zone": "red", "due_date": day("2001-04-04")}
        if kind == "deduct":
            a["waste_value"] = Decimal(pick.randrange(-15000, 90000)) / 10000
        if kind == "set_amount":
            a["amount"] = pick.choice([None, ZERO, money(pick)])
        if not any(b["action_id"] == a["action_id"] for b in log):
            log.append(a)
    return orders, payments, log


def one_by_one(orders, payments, log, done=()):
    orders, payments = {o["id"]: dict(o) for o in orders}, [dict(y) for y in payments]
    for a in sorted(log, key=lambda a: (a["changed_at"], a["action_id"])):
        w, amount, kind = a.get("waste_value"), a.get("amount"), a["kind"]
        if a["action_id"] in done or (kind == "deduct" and not (w and w > 0)) or (kind == "set_amount" and not (amount and amount > 0)):
            continue
        order, mine = orders.get(a["order_id"]), [y for y in payments if y["order_id"] == a["order_id"]]
        if kind == "update" and order:
            order |= {c: a.get(c) for c in order_log.HEADER}
        if kind == "deduct" and order:
            order |= {"total_revenue": max(ZERO, (order.get("total_revenue") or ZERO) - w), "net_profit": (order.get("net_profit") or ZERO) - w}
        if kind == "delete_order":
            orders.pop(a["order_id"], None)
        if kind in ("delete_payment", "delete_order"):
            payments = [y for y in payments if y["order_id"] != a["order_id"]]
            continue
        for y in mine:
            if kind == "update":
                y |= {"amount": a["total_revenue"], "due_date": a["due_date"]}
            if kind == "deduct":
                y["amount"] = max(ZERO, (y["amount"] or ZERO) - w)
            if kind == "set_amount":
                y["amount"] = amount
            if kind == "mark_paid":
                y |= {"status": "paid", "paid_date": max(y.get("paid_date") or a["changed_at"].date(), a["changed_at"].date())}
    return list(orders.values()), payments


def table(spark, name, columns, rows):
    wide = {"total_revenue", "net_profit", "amount"}
    fields = [f"{f.name} decimal(18,4)" if f.name in wide else f"{f.name} {f.dataType.simpleString()}" for f in schema(name) if f.name in columns]
    return frame(spark, T.StructType.fromDDL(", ".join(fields)), rows).select(*columns)


def shown(rows, names):
    plain = lambda v: float(v) if isinstance(v, Decimal) else v
    return sorted((tuple(plain(r.get(n)) for n in names) for r in rows), key=str)


def run(spark, orders, payments, log, applied=None):
    return order_log.apply_log(table(spark, "orders", ORDERS, orders), table(spark, "payments", PAYMENTS, payments), frame(spark, order_log.ACTION, log), applied)


def equal(done, orders, payments):
    assert shown([r.asDict() for r in done.orders.collect()], ORDERS) == shown(orders, ORDERS)
    assert shown([r.asDict() for r in done.payments.collect()], PAYMENTS) == shown(payments, PAYMENTS)


@pytest.mark.parametrize("seed,n", [(1, 30), (2, 120)])
def test_a_log_equals_its_actions_one_by_one(spark, seed, n):
    orders, payments, log = some(seed, n)
    done = run(spark, orders, payments, log)
    equal(done, *one_by_one(orders, payments, log))
    refused = {r["action_id"]: r["failures"] for r in done.rejected.collect()}
    assert set(refused) == {a["action_id"] for a in log if (a["kind"] == "deduct" and a["waste_value"] <= 0) or (a["kind"] == "set_amount" and not (a["amount"] and a["amount"] > 0))}
    assert n < 100 or {f for fs in refused.values() for f in fs} == {"amount_invalid", "waste_not_positive"}


def test_actions_are_applied_once(spark):
    orders, payments, log = some(3, 40)
    first = run(spark, orders, payments, log + log[:5])
    want = one_by_one(orders, payments, log)
    equal(first, *want)
    rows = [[r.asDict() for r in f.collect()] for f in (first.orders, first.payments)]
    again = run(spark, *rows, log[:20], first.action_ids)
    equal(again, *want)
    assert again.action_ids.count() == first.action_ids.count()


def test_one_order_has_all_actions(spark):
    """Slices of one key, in ranges, fold to what a loop gives."""
    pick = random.Random(4)
    rows = [("k", i, pick.random() < 0.002, pick.random() < 0.01, i % 97) for i in range(5000)] + [("z", 1, False, False, 5), (None, 1, False, False, 3)]
    df = spark.createDataFrame(rows, "key string, at long, a boolean, b boolean, n long")
    parts = dealt(df, ["key"], [F.col("at").asc()])
    assert parts.where("key = 'k'").select("_part").distinct().count() > 3
    got = {r["key"]: (r["a"], r["b"]) for r in since_last(parts, "key", ["at"], {"a": F.col("a"), "b": F.col("b")}, F.col("n")).collect()}

    def after(mark):
        last = max((i for i, r in enumerate(rows[:5000]) if r[mark]), default=-1)
        return sum(r[4] for r in rows[last + 1 : 5000]) if last < 4999 else None

    assert got == {"k": (after(2), after(3)), "z": (5, 5), None: (3, 3)}
