"""Jobs that read one version of the stored tables and publish the next: all tables they change, or none."""

from __future__ import annotations

from pyspark.sql import DataFrame

from packhouse.config import Params
from packhouse.operators.changes import apply_changes
from packhouse.plans import maintenance as m
from packhouse.plans.order_log import apply_log
from packhouse.sinks.snapshots import Manifest, Snapshots
from packhouse.sources import documents
from packhouse.sources.lake import Lake


def _publish(lake: Lake, tables: dict[str, DataFrame]) -> Manifest:
    """The next version: what a job gives, in the columns and types that are stored."""
    known = {"orders": lake.orders, "order_items": lake.order_items, "payments": lake.payments, "inventory_batches": lake.batches}
    shaped = {}
    for name, table in tables.items():
        if name in known:
            shape = known[name]().schema
            table = table.select(*[table[f.name].cast(f.dataType).alias(f.name) for f in shape])
        shaped[name] = table
    return Snapshots(lake.spark, lake.root).publish(shaped, lake.manifest)


def new_orders(lake: Lake, p: Params) -> Manifest:
    """Accepted order forms as orders, items and payments."""
    headers, lines = lake.order_forms()
    made = m.create_orders(headers, lines, lake.clients("id", "type", "credit_days"), p)
    old = {"orders": lake.orders(), "order_items": lake.order_items(), "payments": lake.payments()}
    return _publish(lake, {n: rows.unionByName(more, allowMissingColumns=True) for (n, rows), more in zip(old.items(), made)})


def order_updates(lake: Lake, p: Params) -> Manifest:
    headers, lines = lake.order_updates()
    changed = m.update_orders(lake.orders(), lake.order_items(), lake.payments(), headers, lines, lake.clients("id", "type", "credit_days"), p)
    return _publish(lake, dict(zip(("orders", "order_items", "payments"), changed)))


def intake(lake: Lake, p: Params) -> Manifest:
    """Accepted intake forms: batches, what they take off orders and payments, and the links they leave."""
    done = m.take_in(lake, lake.batch_forms(), lake.batches(), lake.orders(), lake.payments())
    links = documents.waste_link_documents(done.links)
    return _publish(lake, {"inventory_batches": done.batches, "orders": done.orders, "payments": done.payments, "waste_links": links})


def batch_deletes(lake: Lake, p: Params) -> Manifest:
    left, links = m.delete_batches(lake.batches(), lake.waste_links(), lake.deleted_batches())
    return _publish(lake, {"inventory_batches": left, "waste_links": documents.waste_link_documents(links)})


def order_log(lake: Lake, p: Params) -> Manifest:
    """The order log; the ids of its actions are a table of the version, so that none is applied twice."""
    folder = lake.manifest.tables.get("applied_actions")
    applied = lake.spark.read.parquet(f"{lake.root.rstrip('/')}/{folder}") if folder else None
    done = apply_log(lake.orders(), lake.payments(), lake.order_log(), applied)
    return _publish(lake, {"orders": done.orders, "payments": done.payments, "applied_actions": done.action_ids})


def margins_and_variants(lake: Lake, p: Params) -> Manifest:
    """Margins and pack sizes after their changes, as documents."""
    changed = apply_changes(lake.margins(), lake.margin_changes(), ["product_id"], ["profit_margin_pct"])
    return _publish(
        lake,
        {
            "product_margins": documents.margin_documents(changed),
            "weight_variants": documents.variant_documents(m.apply_variant_changes(lake, p)),
        },
    )


def ledger(lake: Lake, p: Params) -> Manifest:
    changed = m.change_ledger(lake.ledger(), lake.ledger_additions(), lake.ledger_deletes())
    return _publish(lake, {"capital_ledger": documents.ledger_documents(changed)})
