"""One ordered log of everything that changes orders and their payments.

Actions of an order take effect in the order of (changed_at, action_id), one after the other:

- ``update``: header figures are set; the payment takes the new revenue as its amount, and the new due date
- ``deduct``: revenue and payment fall by the waste value, not below zero; the profit falls by it; the margin stays
- ``set_amount``: the payment's amount is set
- ``mark_paid``: the payment is paid, on that day
- ``delete_payment``, ``delete_order``: gone, and nothing later brings them back

Each value follows x -> max(a, x + b): a setting forgets x, a deduction of w is max(0, x - w).  These compose, so what a log does to
a value is its last setting and the deductions after it, which is summed slice by slice (``since_last``): the log
of one order, however long, is no sequence in one task.  Actions are applied once: ids that are known from
earlier runs, or come twice, do nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packhouse.config import Params
from packhouse.functions import rules
from packhouse.functions.numbers import LINE_MONEY, zero_if_null
from packhouse.operators import quality
from packhouse.operators.lookups import with_parent
from packhouse.operators.slices import crowded, dealt, since_last
from packhouse.session import work_dir

HEADER = ["client_id", "delivery_date", "total_revenue", "total_cost", "net_profit", "margin_percentage", "margin_zone"]
ACTION = (
    "action_id string, order_id string, kind string, changed_at timestamp, client_id string, delivery_date date, total_revenue decimal(18,2), "
    "total_cost decimal(18,2), net_profit decimal(18,2), margin_percentage double, margin_zone string, due_date date, waste_value decimal(18,4), "
    "amount decimal(18,2)"
)
ORDER = ["changed_at", "action_id"]


@dataclass
class Applied:
    orders: DataFrame
    payments: DataFrame
    action_ids: DataFrame  # of this run and those before
    rejected: DataFrame


def _is(*kinds: str) -> Column:
    return F.col("kind").isin(*kinds)


def apply_log(orders: DataFrame, payments: DataFrame, log: DataFrame, applied: DataFrame | None = None) -> Applied:
    """Orders and payments after a log of actions (see ``ACTION``); ``applied`` holds the ``action_id`` of actions done before."""
    accepted, rejected = quality.split(log, quality.action_rules())
    if applied is not None:
        accepted = accepted.join(applied.select("action_id").distinct(), "action_id", "left_anti")
    accepted = accepted.dropDuplicates(["action_id"])
    # Written once, as several folds read it; only the actions of very large orders are dealt out by ranges.
    folder = work_dir(log.sparkSession, "order-log")
    accepted.write.parquet(folder)
    written = log.sparkSession.read.schema(accepted.schema).parquet(folder)
    large = crowded(written.select("order_id"))
    parts = (written if large is None else written.filter(~large)).withColumn("_part", F.lit(0))
    if large is not None:
        parts = parts.unionByName(dealt(written.filter(large), ["order_id"], [F.col(c).asc() for c in ORDER]))

    at = F.struct(*ORDER)
    header = F.struct(*HEADER, "due_date")
    sets = F.when(_is("update"), F.col("total_revenue")).otherwise(F.col("amount"))
    last = parts.groupBy("order_id").agg(
        F.max_by(header, F.when(_is("update"), at)).alias("header"),
        F.max_by(F.struct(sets.alias("amount")), F.when(_is("update", "set_amount"), at)).alias("set"),
        F.max(F.when(_is("mark_paid"), F.col("changed_at"))).cast("date").alias("paid_on"),
        F.max(_is("delete_payment")).alias("payment_gone"),
        F.max(_is("delete_order")).alias("gone"),
    )
    taken = since_last(
        parts, "order_id", ORDER, {"order_waste": _is("update"), "payment_waste": _is("update", "set_amount")}, F.when(_is("deduct"), F.col("waste_value"))
    )
    acts = last.join(taken, "order_id")
    fields = ["header", "set", "paid_on", "payment_gone", "gone", "order_waste", "payment_waste"]
    names = {f"_{c}": c for c in fields}

    def less(value: Column, waste: str, floor: bool) -> Column:
        rest = zero_if_null(value) - F.col(waste)
        rest = F.greatest(rest, F.lit(0)) if floor else rest
        return F.when(F.col(waste).isNotNull(), rest).otherwise(value).cast(LINE_MONEY)

    old = with_parent(orders, acts, "id", names, parent_key="order_id").filter(~F.coalesce("_gone", F.lit(False)))
    now = {c: F.when(F.col("_header").isNotNull(), F.col(f"_header.{c}")).otherwise(F.col(c)) for c in HEADER}
    now |= {"total_revenue": less(now["total_revenue"], "_order_waste", True), "net_profit": less(now["net_profit"], "_order_waste", False)}
    new_orders = old.select(*[now[c].alias(c) if c in now else F.col(c) for c in orders.columns])

    old = with_parent(payments, acts, "order_id", names, parent_key="order_id").filter(~F.coalesce(F.col("_gone") | F.col("_payment_gone"), F.lit(False)))
    set_ = F.when(F.col("_set").isNotNull(), F.col("_set.amount")).otherwise(F.col("amount"))
    paid = F.col("_paid_on").isNotNull()
    now = {
        "amount": less(set_, "_payment_waste", True),
        "due_date": F.when(F.col("_header").isNotNull(), F.col("_header.due_date")).otherwise(F.col("due_date")),
        "status": F.when(paid, rules.PAID).otherwise(F.col("status")),
        "paid_date": F.coalesce("_paid_on", "paid_date"),
    }
    new_payments = old.select(*[now[c].alias(c) if c in now else F.col(c) for c in payments.columns])
    done = parts.select("action_id")
    return Applied(new_orders, new_payments, done if applied is None else done.unionByName(applied.select("action_id")).distinct(), rejected)


def apply_order_log(t, p: Params) -> DataFrame:
    """All orders that are left, each with its payment, if that is left."""
    done = apply_log(t.orders("id", *HEADER), t.payments("order_id", "amount", "due_date", "status", "paid_date"), t.order_log())
    fields = {c: c for c in ("amount", "due_date", "status", "paid_date")}
    return with_parent(done.orders, done.payments, "id", fields, parent_key="order_id").withColumnRenamed("id", "order_id")
