"""Table changes: snapshots in, new snapshots out."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packhouse.config import Params, Settings
from packhouse.functions import rules
from packhouse.functions.numbers import LINE_MONEY, cents, money, zero_if_null
from packhouse.functions.text import order_label
from packhouse.operators import quality
from packhouse.operators.changes import DELETE, UPSERT, apply_changes, without
from packhouse.operators.lookups import fold_children, with_parent
from packhouse.plans.orders import economics, lines_as_drafts
from packhouse.plans.pricing import calculator_rows
from packhouse.plans.stock import linked_batches, with_waste
from packhouse.sources.documents import resolved_settings, saved_settings

PRICE_KEY = ["client_id", "product_id"]


def _as_upserts(rows: DataFrame, p: Params) -> DataFrame:
    return rows.withColumns(
        {"op": F.lit(UPSERT), "changed_at": F.lit(p.as_of).cast("timestamp"), "seq": F.lit(0).cast("long")}
    )


# ------------------------------------------------------ products and clients


def checked_product_changes(t) -> tuple[DataFrame, DataFrame]:
    return quality.split_changes(t.product_changes(), quality.product_rules())


def checked_client_changes(t) -> tuple[DataFrame, DataFrame]:
    return quality.split_changes(t.client_changes(), quality.client_rules())


def checked_price_changes(t) -> tuple[DataFrame, DataFrame]:
    return quality.split_changes(t.price_changes(), quality.price_rules())


def apply_product_changes(t, p: Params) -> DataFrame:
    accepted, _ = checked_product_changes(t)
    return apply_changes(t.products("id", "name", "unit", "cost_per_unit"), accepted, ["id"], ["name", "cost_per_unit"])


def apply_client_changes(t, p: Params) -> DataFrame:
    accepted, _ = checked_client_changes(t)
    return apply_changes(t.clients("id", "name", "type", "credit_days"), accepted, ["id"], ["name", "credit_days"])


# -------------------------------------------------------------------- prices


def apply_price_changes(t, p: Params) -> DataFrame:
    prices = t.client_pricing("client_id", "product_id", "selling_price")
    accepted, _ = checked_price_changes(t)
    return apply_changes(prices, accepted, PRICE_KEY, ["selling_price"])


def offered_prices(offers: DataFrame, picks: DataFrame) -> DataFrame:
    """Each offer's price for each client picked for it; an offer without a price sets none.

    Of offers that reach one client and product, the last by (changed_at, seq) wins, then the one of the last request id.
    """
    usable = offers.filter(rules.truthy(F.col("selling_price")) & F.col("product_id").isNotNull())
    order = [F.col(c) if c in offers.columns else F.lit(None) for c in ("changed_at", "seq")]
    last = F.struct(*[c.alias(f"_{i}") for i, c in enumerate(order)], F.col("request_id"))
    return picks.join(usable, "request_id", "inner").groupBy(*PRICE_KEY).agg(F.max_by("selling_price", last).alias("selling_price"))


def price_fanout_clients(t, p: Params) -> DataFrame:
    rows = offered_prices(t.price_offers(), t.offer_picks())
    return apply_changes(
        t.client_pricing("client_id", "product_id", "selling_price"), _as_upserts(rows, p), PRICE_KEY, ["selling_price"]
    )


def price_apply_to_client(t, p: Params, client_id: str = "1") -> DataFrame:
    """Set every product's price per kg as one client's price."""
    price = cents(rules.price_per_kg(F.col("pack_price"), F.col("pack_size")))
    rows = calculator_rows(t, p).select(F.lit(client_id).alias("client_id"), "product_id", price.alias("selling_price"))
    return apply_changes(
        t.client_pricing("client_id", "product_id", "selling_price"), _as_upserts(rows, p), PRICE_KEY, ["selling_price"]
    )


def apply_margin_changes(t, p: Params) -> DataFrame:
    return apply_changes(t.margins(), t.margin_changes(), ["product_id"], ["profit_margin_pct"])


def apply_variant_changes(t, p: Params) -> DataFrame:
    """Replace whole pack-size lists; one row per pack size."""
    changed = t.variant_changes()
    keys = changed.select("product_id").distinct()
    kept = without(t.variants(), keys, "product_id", id_column="product_id")
    order = F.struct("changed_at", "seq")
    latest = changed.groupBy("product_id").agg(F.max_by("variants", order).alias("variants"))
    new = latest.select("product_id", F.posexplode("variants").alias("position", "v")).select(
        "product_id", "position", F.col("v.weight").alias("weight"), F.col("v.price").alias("price")
    )
    return kept.unionByName(new)


def replaced_settings(current: Settings, overhead_pct: float | None = None, labor_pct: float | None = None) -> Settings:
    """Settings are saved whole: a field left out counts as 0."""
    if overhead_pct is None and labor_pct is None:
        return current
    return Settings(overhead_pct or 0.0, labor_pct or 0.0)


def apply_settings_changes(t, p: Params) -> DataFrame:
    """Overhead and labor of each owner after the changes, as they are read from the documents that are saved."""
    return resolved_settings(saved_settings(t.settings_documents(), t.settings_changes()))


# -------------------------------------------------------------------- orders


def delete_orders(orders: DataFrame, items: DataFrame, payments: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Remove orders with their items and payments."""
    return without(orders, ids, "id"), without(items, ids, "order_id"), without(payments, ids, "order_id")


def apply_order_deletes(t, p: Params) -> DataFrame:
    """Rows left in each of the three tables."""
    left = delete_orders(t.orders("id"), t.order_items("order_id"), t.payments("order_id"), t.deleted_orders())
    names = ("orders", "order_items", "payments")
    counts = [f.agg(F.lit(n).alias("table_name"), F.count(F.lit(1)).alias("rows_left")) for n, f in zip(names, left)]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


def _typed_lines(headers: DataFrame, lines: DataFrame, clients: DataFrame) -> DataFrame:
    """Form lines as stored items: at the price that their client's type is charged."""
    types = with_parent(headers.select("id", "client_id"), clients, "client_id", {"client_type": "type"})
    typed = with_parent(lines, types, "order_id", {"client_type": "client_type"})
    revenue = rules.line_revenue(
        rules.is_supermarket(F.col("client_type")), F.col("selling_price_used"), F.col("quantity"), F.col("num_packages")
    )
    return typed.select(
        "id",
        "order_id",
        "product_id",
        "quantity",
        "selling_price_used",
        "cost_used",
        cents(revenue).alias("total_revenue"),
        (F.col("cost_used") * F.col("quantity")).cast(LINE_MONEY).alias("total_cost"),
    )


def _checked_forms(headers: DataFrame, items: DataFrame) -> DataFrame:
    """Headers with the sums of their items and the names of all rules that header or items break; items are read once.

    Items may come without money, which no rule asks for.
    """
    sums = {"line_count": F.count(F.lit(1))}
    sums |= {n: F.sum(c) for n, c in {"line_revenue": "total_revenue", "line_cost": "total_cost"}.items() if c in items.columns}
    sums |= {n: F.count_if(bad) for n, bad in quality.line_rules().items()}
    rows = with_parent(headers, fold_children(items, "order_id", **sums), "id", {n: n for n in sums}, parent_key="order_id")
    return quality.with_failures(rows, quality.order_form_rules())


def _placed(checked: DataFrame, clients: DataFrame, p: Params) -> DataFrame:
    """Accepted forms, one row an order: its header with figures, when it is due, and how many items it has."""
    rows = with_parent(economics(quality.valid(checked), p), clients, "client_id", {"_credit": "credit_days"})
    return rows.select(
        "id",
        "client_id",
        "order_date",
        "delivery_date",
        money(F.col("transport_cost")).alias("transport_cost"),
        money(F.col("packaging_cost")).alias("packaging_cost"),
        F.col("revenue").alias("total_revenue"),
        F.col("cost").alias("total_cost"),
        F.col("profit").alias("net_profit"),
        F.col("margin").alias("margin_percentage"),
        F.col("zone").alias("margin_zone"),
        rules.due_date(F.col("delivery_date"), F.col("_credit"), p.default_credit_days).alias("due_date"),
        F.col("line_count").alias("item_count"),
        F.col("line_revenue").alias("item_revenue"),
    )


# What a placed order has beyond its stored header.
_BESIDE = ["due_date", "item_count", "item_revenue"]


def create_orders(headers: DataFrame, lines: DataFrame, clients: DataFrame, p: Params) -> tuple[DataFrame, DataFrame, DataFrame]:
    """New orders, their items and one payment each, from one input; forms that break a rule leave none (``refused_forms``)."""
    items = _typed_lines(headers, lines, clients)
    placed = _placed(_checked_forms(headers, items), clients, p)
    items = items.join(placed.select(F.col("id").alias("order_id")), "order_id", "left_semi")
    payments = placed.select(F.concat(F.lit("pay-"), "id").alias("id"), F.col("id").alias("order_id"), F.col("total_revenue").alias("amount"), "due_date")
    return placed.drop(*_BESIDE), items, payments


def refused_forms(headers: DataFrame, lines: DataFrame, clients: DataFrame | None = None) -> DataFrame:
    """Headers of forms, for new orders or updates, that break a rule.

    Rules ask how many lines a form has, and how many are wrong by their own fields.  What a client's type makes of a line takes no
    part, so lines are counted as they come and don't meet their client.
    """
    return quality.rejected(_checked_forms(headers, lines))


def order_forms(t, typed_only: bool = False) -> tuple[DataFrame, DataFrame]:
    """Header and lines of every order as a form for a new one, and the forms that were handed in.

    ``typed_only`` gives lines without cost and packs, which are looked up.
    """
    drafts = lines_as_drafts(t, typed_only=typed_only)
    lines = drafts.select(
        F.concat(F.lit("new-"), F.col("item_id")).alias("id"),
        F.concat(F.lit("new-"), F.col("order_id")).alias("order_id"),
        "product_id",
        "quantity",
        F.col("selling_price").alias("selling_price_used"),
        *([] if typed_only else [F.col("cost").alias("cost_used"), "num_packages"]),
    )
    headers = t.orders("id", "client_id", "order_date", "delivery_date", "transport_cost", "packaging_cost")
    headers = headers.withColumn("id", F.concat(F.lit("new-"), F.col("id")))
    more_headers, more_lines = t.order_forms()
    return headers.unionByName(more_headers), lines.unionByName(more_lines.select(*lines.columns))


def create_orders_payments(t, p: Params) -> DataFrame:
    """Every valid order placed once more: the new order, its number of items, its payment."""
    headers, lines = order_forms(t)
    clients = t.clients("id", "type", "credit_days")
    placed = _placed(_checked_forms(headers, _typed_lines(headers, lines, clients)), clients, p)
    return placed.select(
        F.col("id").alias("order_id"),
        "client_id",
        "total_revenue",
        "total_cost",
        "net_profit",
        "margin_percentage",
        "margin_zone",
        "item_count",
        "item_revenue",
        F.col("total_revenue").alias("amount"),
        "due_date",
    )


def _overwritten(rows: DataFrame, new: DataFrame, key: str, fields: dict[str, str]) -> DataFrame:
    """Rows with ``fields`` (column -> column of ``new``) replaced where ``new`` has their key; ``_hit`` tells where."""
    merged = with_parent(rows, new.withColumn("_hit", F.lit(True)), key, {"_hit": "_hit", **{f"_new_{c}": n for c, n in fields.items()}})
    hit = F.col("_hit").isNotNull()
    return merged.select(
        *[F.when(hit, F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in fields else F.col(c) for c in rows.columns], hit.alias("_hit")
    )


def update_orders(
    orders: DataFrame, items: DataFrame, payments: DataFrame, headers: DataFrame, lines: DataFrame, clients: DataFrame, p: Params
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Overwrite headers, replace all their lines, and bring an existing payment in line; forms that break a rule change nothing."""
    typed = _typed_lines(headers, lines, clients)
    new = _placed(_checked_forms(headers, typed), clients, p)
    fields = [c for c in new.columns if c != "id" and c not in _BESIDE]
    updated = _overwritten(orders, new, "id", {c: c for c in fields if c in orders.columns}).drop("_hit")
    known = new.select("id").join(orders.select("id"), "id", "left_semi")
    fresh = typed.join(known.withColumnRenamed("id", "order_id"), "order_id", "left_semi")
    replaced = without(items, known, "order_id").unionByName(fresh.select(*items.columns))
    paid = _overwritten(payments, new, "order_id", {"amount": "total_revenue", "due_date": "due_date"}).drop("_hit")
    return updated, replaced, paid


def apply_order_updates(t, p: Params) -> DataFrame:
    """All orders after the update, each with its number of items and its payment.

    The same as ``update_orders``, on one row an order: what an updated order shows of its items and payment is what its form
    gives, and only the others' items are counted.
    """
    headers, lines = t.order_updates()
    clients = t.clients("id", "type", "credit_days")
    new = _placed(_checked_forms(headers, _typed_lines(headers, lines, clients)), clients, p)
    rows = t.orders("id", "client_id", "delivery_date", "total_revenue", "total_cost", "net_profit", "margin_percentage", "margin_zone")
    fields = [c for c in rows.columns if c != "id"]
    counts = fold_children(t.order_items("order_id", "total_revenue"), "order_id", item_count=F.count(F.lit(1)), item_revenue=F.sum("total_revenue"))
    rows = with_parent(rows, counts, "id", {"item_count": "item_count", "item_revenue": "item_revenue"}, parent_key="order_id")
    rows = with_parent(rows, t.payments("order_id", "amount", "due_date"), "id", {"_paying": "order_id", "amount": "amount", "due_date": "due_date"}, parent_key="order_id")
    rows = rows.withColumns({c: zero_if_null(F.col(c)).cast(rows.schema[c].dataType) for c in ("item_count", "item_revenue")})
    own = {c: c for c in [*fields, "item_count", "item_revenue"]} | {"amount": "total_revenue", "due_date": "due_date"}
    rows = _overwritten(rows, new, "id", own)
    # An order without payment gets none.
    kept = {c: F.when(F.col("_paying").isNotNull(), F.col(c)) for c in ("amount", "due_date")}
    return rows.withColumns(kept).drop("_paying", "_hit").withColumnRenamed("id", "order_id")


# --------------------------------------------------------------- waste, stock


def subtract_waste(orders: DataFrame, payments: DataFrame, deductions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Take waste off orders and their payments.

    ``deductions`` holds ``order_id`` and a positive ``waste_value``.  Taking several
    off one after the other, with a floor at zero, equals taking off their sum.
    """
    taken = deductions.filter(F.col("waste_value") > 0)
    taken = fold_children(taken, "order_id", waste=F.sum("waste_value"))

    def less(column: str, floor: bool) -> Column:
        rest = zero_if_null(F.col(column)) - F.col("_waste")
        rest = F.greatest(rest, F.lit(0)) if floor else rest
        return F.when(F.col("_waste").isNotNull(), rest).otherwise(F.col(column)).cast(LINE_MONEY)

    hit = with_parent(orders, taken, "id", {"_waste": "waste"}, parent_key="order_id")
    hit = hit.withColumns({"total_revenue": less("total_revenue", True), "net_profit": less("net_profit", False)}).drop("_waste")
    paid = with_parent(payments, taken, "order_id", {"_waste": "waste"}, parent_key="order_id")
    return hit, paid.withColumn("amount", less("amount", True)).drop("_waste")


def waste_deductions(t, p: Params) -> DataFrame:
    """Unrounded waste value of every batch that is linked to an order."""
    batches = t.batches("id", "product_id", "harvest_date", "harvested_qty", "damaged_qty", "expired_qty")
    valued = with_waste(batches, t.products("id", "cost_per_unit")).select("id", "product_id", "harvest_date", "raw_waste_value")
    linked = linked_batches(valued, t.waste_links()).filter(F.col("order_id").isNotNull())
    return linked.select(F.col("id").alias("batch_id"), "order_id", F.col("raw_waste_value").alias("waste_value"))


def deduct_waste(t, p: Params) -> DataFrame:
    orders, payments = subtract_waste(
        t.orders("id", "total_revenue", "net_profit", "margin_percentage"), t.payments("order_id", "amount"), waste_deductions(t, p)
    )
    rows = with_parent(orders, payments, "id", {"amount": "amount"}, parent_key="order_id")
    return rows.withColumnRenamed("id", "order_id")


def checked_batch_forms(forms: DataFrame, products: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Intake forms with their waste, counted in packs, as quantities; and those that break a rule.

    ``waste_taken`` is the waste quantity before it is stored with two decimals.
    """
    unit = with_parent(forms, products, "product_id", {"unit": "unit"})
    is_kg = F.coalesce(F.col("unit") == rules.KG, F.lit(False))
    damaged = rules.packed_quantity(is_kg, F.col("damaged_pkg_size"), F.col("damaged_count"))
    expired = rules.packed_quantity(is_kg, F.col("expired_pkg_size"), F.col("expired_count"))
    taken_in = unit.select(
        "id",
        "product_id",
        "harvest_date",
        "harvested_qty",
        money(zero_if_null(F.col("sold_qty"))).alias("sold_qty"),
        money(damaged).alias("damaged_qty"),
        money(expired).alias("expired_qty"),
        zero_if_null(F.col("packaging_cost")).alias("packaging_cost"),
        (damaged + expired).cast("decimal(18,6)").alias("waste_taken"),
        *[F.col(c) for c in ("order_id",) if c in forms.columns],
    )
    return quality.split(taken_in, quality.batch_rules())


def apply_batches(batches: DataFrame, forms: DataFrame, edits: DataFrame, products: DataFrame) -> DataFrame:
    """New batches from intake forms, and edits of old ones.

    An intake form counts waste in packs and may add packaging cost; an edit knows
    no packaging cost, so it works the waste value out again without.
    """
    taken_in, _ = checked_batch_forms(forms, products)
    columns = [*batches.columns]
    new = with_waste(taken_in, products, F.col("packaging_cost"))
    new = new.select(*[c for c in columns if c in new.columns])
    edited = edits.select("id", F.lit(True).alias("_hit"), *[F.col(c).alias(f"_{c}") for c in edits.columns if c != "id"])
    old = batches.join(edited, "id", "left").withColumn("_hit", F.coalesce("_hit", F.lit(False)))
    hit = F.col("_hit")
    quantities = ["harvested_qty", "damaged_qty", "expired_qty"]
    stored = {c: F.col(c) for c in ("waste_percentage", "waste_value")}
    old = old.withColumns({f"_old_{c}": col for c, col in stored.items()})
    old = old.withColumns({c: F.when(hit, zero_if_null(F.col(f"_{c}"))).otherwise(F.col(c)) for c in quantities})
    again = with_waste(old, products).withColumns(
        {c: F.when(F.col("_hit"), F.col(c)).otherwise(F.col(f"_old_{c}")) for c in stored}
    )
    return again.select(*columns).unionByName(new, allowMissingColumns=True)


def batch_intake(t, p: Params) -> DataFrame:
    batches = t.batches(
        "id", "product_id", "harvest_date", "harvested_qty", "sold_qty", "damaged_qty", "expired_qty", "waste_percentage", "waste_value"
    )
    return apply_batches(batches, t.batch_forms(), t.batch_edits(), t.products("id", "unit", "cost_per_unit"))


def batch_key(product: str = "product_id", day: str = "harvest_date") -> Column:
    """The key of a link that was made before its batch had an id."""
    return F.concat_ws("_", product, F.col(day).cast("string"))


def form_deductions(taken_in: DataFrame, products: DataFrame, orders: DataFrame, clients: DataFrame) -> DataFrame:
    """What accepted forms take off the order they name, and the link to it that they leave.

    The waste value is not rounded and includes packaging; a form without waste, or of an order that isn't
    known, takes nothing off and leaves no link.
    """
    rows = with_parent(taken_in, products, "product_id", {"_cost": "cost_per_unit"})
    value = rules.raw_waste_value(F.col("waste_taken"), F.col("_cost"), F.col("packaging_cost")).cast(LINE_MONEY)
    heads = with_parent(orders.select("id", "client_id", "delivery_date"), clients, "client_id", {"client_name": "name"})
    order = {"_known": "id", "client_id": "client_id", "client_name": "client_name", "delivery_date": "delivery_date"}
    rows = with_parent(rows.withColumn("waste_value", value), heads, "order_id", order)
    rows = rows.filter(F.col("_known").isNotNull() & (F.col("waste_value") > 0))
    return rows.select(
        F.col("id").alias("batch_id"),
        "order_id",
        "waste_value",
        batch_key().alias("link_key"),
        "client_id",
        F.coalesce("client_name", F.lit("")).alias("client_name"),
        order_label(F.col("client_name"), F.col("delivery_date"), F.col("order_id")).alias("order_label"),
    )


LINK = ["link_key", "client_id", "client_name", "order_id", "order_label"]


@dataclass
class Intake:
    """The four tables that an intake changes, what was taken off orders, and the forms that were refused."""

    batches: DataFrame
    links: DataFrame
    orders: DataFrame
    payments: DataFrame
    deductions: DataFrame
    rejected: DataFrame


def take_in(t, forms: DataFrame, batches: DataFrame, orders: DataFrame, payments: DataFrame) -> Intake:
    """Intake forms and all that follows: new batches, waste off the orders they name and off the payments, links to these orders.

    Of forms that leave the same link, the one of the last id counts.
    """
    products, clients = t.products("id", "unit", "cost_per_unit"), t.clients("id", "name")
    taken_in, rejected = checked_batch_forms(forms, products)
    new = with_waste(taken_in, products, F.col("packaging_cost"))
    new = batches.unionByName(new.select(*[c for c in batches.columns if c in new.columns]), allowMissingColumns=True)
    taken = form_deductions(taken_in, products, t.orders("id", "client_id", "delivery_date"), clients)
    newest = taken.groupBy("link_key").agg(F.max_by(F.struct(*LINK[1:]), "batch_id").alias("l")).select("link_key", "l.*")
    links = without(t.waste_links().select(*LINK), newest, "link_key", id_column="link_key").unionByName(newest.select(*LINK))
    after = subtract_waste(orders, payments, taken)
    return Intake(new, links, *after, taken, rejected)


def _intake(t) -> Intake:
    batches = t.batches("id", "product_id", "harvest_date", "harvested_qty", "damaged_qty", "expired_qty", "waste_percentage", "waste_value")
    return take_in(t, t.batch_forms(), batches, t.orders("id", "total_revenue", "net_profit"), t.payments("order_id", "amount"))


def intake_deductions(t, p: Params) -> DataFrame:
    """What each intake form takes off its order."""
    return _intake(t).deductions


def intake_orders(t, p: Params) -> DataFrame:
    """All orders and their payments after the waste of intake forms was taken off."""
    done = _intake(t)
    return with_parent(done.orders, done.payments, "id", {"amount": "amount"}, parent_key="order_id").withColumnRenamed("id", "order_id")


def intake_links(t, p: Params) -> DataFrame:
    return _intake(t).links


def delete_batches(batches: DataFrame, links: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Batches without those of the given ids, and links without those that lead to none of the batches left.

    A link by batch id goes with its batch; one by product and harvest date stays as long as any batch of that
    product and date does.  Links that led to no batch before are left alone.
    """
    left = without(batches, ids, "id")
    gone = batches.join(ids.select("id").distinct(), "id", "left_semi")
    keys = batch_key().alias("id")
    dangling = gone.select("id").unionByName(without(gone.select(keys).distinct(), left.select(keys), "id"))
    return left, without(links, dangling, "link_key")


def apply_batch_deletes(t, p: Params) -> DataFrame:
    """Batches and links that are left, by their keys."""
    left, links = delete_batches(t.batches("id", "product_id", "harvest_date"), t.waste_links(), t.deleted_batches())
    rows = left.select(F.lit("batch").alias("kind"), F.col("id").alias("key"), F.lit(None).cast("string").alias("order_id"))
    return rows.unionByName(links.select(F.lit("link").alias("kind"), F.col("link_key").alias("key"), "order_id"))


# ------------------------------------------------------- payments and ledger


def checked_payment_actions(actions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """An amount that is set has to be one; the other actions carry none."""
    asked = {n: (F.col("action") == "set_amount") & bad for n, bad in quality.payment_rules().items()}
    return quality.split(actions, asked)


def change_payments(payments: DataFrame, actions: DataFrame) -> DataFrame:
    """Mark paid (with the day it was done), set amounts, delete.

    Each kind of action touches its own columns, so only the last of each kind
    counts; a deleted payment stays deleted.
    """
    actions, _ = checked_payment_actions(actions)
    order = F.struct("changed_at", "seq")
    is_paid, is_set = F.col("action") == "mark_paid", F.col("action") == "set_amount"
    last = actions.groupBy("id").agg(
        F.coalesce(F.max(F.col("action") == DELETE), F.lit(False)).alias("_deleted"),
        F.max(F.when(is_paid, F.col("changed_at"))).cast("date").alias("_paid_on"),
        F.max_by("amount", F.when(is_set, order)).alias("_amount"),
    )
    rows = with_parent(payments, last, "id", {c: c for c in ("_deleted", "_paid_on", "_amount")})
    paid = F.col("_paid_on").isNotNull()
    values = {
        "amount": F.coalesce(F.col("_amount"), F.col("amount")),
        "status": F.when(paid, rules.PAID).otherwise(F.col("status")),
        "paid_date": F.coalesce(F.col("_paid_on"), F.col("paid_date")),
    }
    kept = rows.filter(~F.coalesce("_deleted", F.lit(False)))
    return kept.select(*[values[c].alias(c) if c in values else F.col(c) for c in payments.columns])


def apply_payment_changes(t, p: Params) -> DataFrame:
    return change_payments(t.payments("id", "order_id", "amount", "due_date", "paid_date", "status"), t.payment_actions())


def change_ledger(ledger: DataFrame, added: DataFrame, deleted_ids: DataFrame) -> DataFrame:
    """Append the valid new entries, descriptions trimmed, and take out deleted ones."""
    sound, _ = quality.split(added, quality.ledger_rules())
    sound = sound.withColumn("description", F.trim("description"))
    return without(ledger.unionByName(sound), deleted_ids, "id")


def apply_ledger_changes(t, p: Params) -> DataFrame:
    changed = change_ledger(t.ledger(), t.ledger_additions(), t.ledger_deletes())
    return changed.orderBy(F.col("date").desc(), "id")


# ------------------------------------------------------------------- rejects


def rejected_writes(t, p: Params) -> DataFrame:
    """What the writes refuse: each row with all rules it breaks."""
    key = F.concat_ws("/", "client_id", "product_id", "seq")
    refused = [
        ("products", checked_product_changes(t)[1], F.concat_ws("/", "id", "seq")),
        ("clients", checked_client_changes(t)[1], F.concat_ws("/", "id", "seq")),
        ("prices", checked_price_changes(t)[1], key),
        ("new orders", refused_forms(*order_forms(t, typed_only=True)), F.col("id")),
        ("order updates", refused_forms(*t.order_updates()), F.col("id")),
        ("batch intake", checked_batch_forms(t.batch_forms(), t.products("id", "unit"))[1], F.col("id")),
        ("payments", checked_payment_actions(t.payment_actions())[1], F.concat_ws("/", "id", "seq")),
        ("ledger", quality.split(t.ledger_additions(), quality.ledger_rules())[1], F.col("id")),
    ]
    return reduce(DataFrame.unionByName, [quality.as_rejects(rows, write, row_id) for write, rows, row_id in refused])
