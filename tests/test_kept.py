"""Figures kept under a change feed, against the same report over the whole table."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from packhouse.config import Params
from packhouse.plans import dashboard, kept as plans
from packhouse.streaming import kept
from packhouse.streaming.state import KeyedState
from small import Small, day

P = Params(as_of=day("2001-08-01"))
T0 = dt.datetime(2001, 7, 1)
PAYMENTS = f"id string, {kept.PAYMENT_COLUMNS}, op string, changed_at timestamp, seq string"
ORDERS = f"id string, {kept.ORDER_COLUMNS}, op string, changed_at timestamp, seq string"


def event(n, row, op="upsert", at=None):
    return {**row, "op": op, "changed_at": T0 + dt.timedelta(minutes=n if at is None else at), "seq": f"{n:06d}"}


def frame(spark, ddl, events):
    from small import frame as build

    return build(spark, ddl, events)


def current(events):
    """The rows a feed leaves, one event at a time."""
    last = {}
    for e in events:
        if e["id"] not in last or (e["changed_at"], e["seq"]) > (last[e["id"]]["changed_at"], last[e["id"]]["seq"]):
            last[e["id"]] = e
    return [e for e in last.values() if e["op"] == "upsert"]


def test_receivables_after_each_batch(spark, tmp_path, monkeypatch):
    """Edits, deletes, rows that come back, and changes that come later than newer ones."""
    monkeypatch.setattr(KeyedState, "FULL", 2)
    pick = random.Random(1)
    events = [
        event(n, {"id": f"p{pick.randrange(12)}", "amount": pick.choice([None, "0", "10.25", "99.99", "-3"]), "status": pick.choice(["paid", "pending", None])}, pick.choice(["upsert", "upsert", "upsert", "delete"]), at=pick.randrange(60))
        for n in range(100)
    ]
    sink = kept.KeptFigure(str(tmp_path / "packhouse" / "k"), kept.RECEIVABLES)
    for b in range(4):
        for _ in range(2 if b == 2 else 1):  # a batch run again
            sink(frame(spark, PAYMENTS, events[25 * b : 25 * b + 25]), b)
        rows = [{k: e[k] for k in ("id", "amount", "status")} for e in current(events[: 25 * b + 25])]
        want = dashboard.receivables_totals(Small(spark, payments=rows), P).first()
        assert tuple(plans.receivables(sink.current(spark)).first()) == tuple(want)
    assert len(list((tmp_path / "packhouse" / "k" / "touched").iterdir())) == 2


def test_weekly_figures_after_each_batch(spark, tmp_path):
    """Orders move between days and clients; the twin reads the rows as they are."""
    pick = random.Random(2)
    clients = ["a", "b", None]

    def row():
        money = lambda: f"{pick.randrange(-500, 5000) / 100:.2f}"
        return {
            "id": f"o{pick.randrange(10)}", "client_id": pick.choice(clients), "order_date": day(f"2001-07-{pick.randrange(20, 32)}"),
            "total_revenue": money(), "net_profit": money(), "transport_cost": money(), "packaging_cost": money(),
            "margin_percentage": pick.randrange(-100, 9000) / 100, "base_cost": f"{pick.randrange(1000) / 10000:.4f}",
        }

    events = [event(n, row(), pick.choice(["upsert", "upsert", "delete"])) for n in range(45)]
    folder = str(tmp_path / "packhouse" / "k")
    days, clients_kept = kept.KeptFigure(f"{folder}/d", kept.DAYS), kept.KeptFigure(f"{folder}/c", kept.CLIENT_REVENUE)
    for b in range(3):
        batch = frame(spark, ORDERS, events[15 * b : 15 * b + 15])
        days(batch, b)
        clients_kept(batch, b)
        rows = current(events[: 15 * b + 15])
        items = [{"id": e["id"], "order_id": e["id"], "total_cost": e["base_cost"]} for e in rows]
        t = Small(spark, orders=[{k: v for k, v in e.items() if k not in ("op", "changed_at", "seq", "base_cost")} for e in rows], order_items=items)
        got = plans.weekly(days.current(spark), clients_kept.current(spark), P).first().asDict()
        assert {k: got[k] for k in ("top_client_pct", "top_client_alert")} == dict(zip(("top_client_pct", "top_client_alert"), dashboard.top_client_share(t, P).first()))
        assert {k: v for k, v in got.items() if not k.startswith("top")} == dashboard.weekly_kpis(t, P).first().asDict()


def test_empty_feed(spark, tmp_path):
    sink = kept.KeptFigure(str(tmp_path / "packhouse" / "k"), kept.WASTE)
    ddl = f"id string, {kept.BATCH_COLUMNS}, op string, changed_at timestamp, seq string"
    sink(frame(spark, ddl, []), 0)
    assert [tuple(r) for r in plans.waste(sink.current(spark), P).collect()] == [(0, 0, 0, 0.0, False)]
    sink(frame(spark, ddl, [event(1, {"id": "b", "harvested_qty": "10", "damaged_qty": None, "expired_qty": "2", "waste_value": "3"})]), 1)
    sink(frame(spark, ddl, [event(2, {"id": "b"}, "delete")]), 2)
    assert sink.current(spark).count() == 0


def test_hot_group_is_folded_before_it_is_shuffled(spark):
    """All rows in one group: partial sums leave the tasks."""
    rows = spark.range(1000).select(F.lit(1).cast("decimal(18,2)").alias("amount"), F.lit("paid").alias("status"))
    folded = kept.RECEIVABLES.of(rows)
    plan = folded._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan and [r["row_count"] for r in folded.collect()] == [1000]


@pytest.mark.parametrize("bad", ["/tmp/elsewhere", "s3a://bucket/tables"])
def test_only_working_folders_are_removed(spark, bad):
    from packhouse.session import remove

    with pytest.raises(ValueError):
        remove(spark, bad)
