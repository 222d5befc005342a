"""The given star-schema tables, read as the business tables of a wholesaler.

Same interface as :class:`packhouse.sources.lake.Lake`, plus the change requests
and JSON documents the jobs take as input.  Everything is derived by Spark from
the whole tables, lazily, and only as far as the requested columns need.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce, wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from packhouse.config import Settings
from packhouse.functions import rules
from packhouse.functions.numbers import cents, dbl, from_units, hundredths, money, pct, round_half_up
from packhouse.operators.lookups import with_parent
from packhouse.sources import documents
from packhouse.sources.schemas import schema

ITEM_PRICE = {"selling_price_used"}
ITEM_COST = {"cost_used", "total_cost"}
ORDER_REVENUE = {"total_revenue", "transport_cost", "packaging_cost"}
ORDER_COST = {"total_cost", "net_profit", "margin_percentage", "margin_zone"}


def text(c):
    return c.cast("string")


def once(build):
    """Build a frame once per binding and arguments: later plans share it, and Spark its exchanges."""

    @wraps(build)
    def shared(self, *args):
        key = (build.__name__, args)
        if key not in self._frames:
            self._frames[key] = build(self, *args)
        return self._frames[key]

    return shared


class Testdata:
    __test__ = False  # not a test class

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._frames: dict[tuple, DataFrame] = {}

    @once
    def _read(self, table: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{table}.parquet")

    @staticmethod
    def _columns(table: str, cols: tuple[str, ...]) -> list[str]:
        return list(cols) or schema(table).names

    # ------------------------------------------------------------ dimensions

    @once
    def clients(self, *cols: str) -> DataFrame:
        key = F.col("c_custkey")
        known = key % 3 != 0
        credit = F.col("c_nationkey") % 4
        return (
            self._read("customer")
            .select(
                text(key).alias("id"),
                F.col("c_name").alias("name"),
                F.when(known, F.concat(F.lit("ar-"), text(key))).alias("name_ar"),
                F.when(F.col("c_mktsegment").isin("HOUSEHOLD", "FURNITURE"), rules.SUPERMARKET)
                .otherwise("restaurant")
                .alias("type"),
                F.when(known, F.concat(F.lit("+20 (10) "), text(key))).alias("phone"),
                F.when(credit == 0, 0).when(credit == 2, 15).when(credit == 3, 45).alias("credit_days"),
                F.lit(None).cast("timestamp").alias("created_at"),
            )
            .select(*self._columns("clients", cols))
        )

    @once
    def products(self, *cols: str) -> DataFrame:
        key = F.col("p_partkey")
        return (
            self._read("part")
            .select(
                text(key).alias("id"),
                F.col("p_name").alias("name"),
                F.when(key % 3 != 0, F.concat(F.lit("ar-"), text(key))).alias("name_ar"),
                F.when(key % 2 == 0, rules.KG).otherwise("pc").alias("unit"),
                cents(F.col("p_retailprice")).alias("cost_per_unit"),
                F.lit(0.0).alias("profit_margin_pct"),
                F.col("p_size").alias("shelf_life_days"),
                F.lit(None).cast("timestamp").alias("created_at"),
            )
            .select(*self._columns("products", cols))
        )

    # ---------------------------------------------------------- order lines

    @once
    def _facts(self) -> DataFrame:
        """What is known of an order line: the least that has to go along until it has met its parents."""
        return self._read("lineitem").select(
            F.col("l_orderkey").alias("order_key"),
            F.col("l_partkey").alias("product_key"),
            F.col("l_suppkey").alias("supplier_key"),
            F.col("l_linenumber").alias("line_number"),
            F.col("l_quantity").alias("quantity_d"),
            F.col("l_extendedprice").alias("revenue_d"),
            F.col("l_discount").alias("discount_d"),
            F.col("l_tax").alias("tax_d"),
            F.col("l_returnflag").alias("return_flag"),
            F.col("l_linestatus").alias("line_status"),
            F.col("l_shipdate").cast("date").alias("ship_date"),
        )

    @staticmethod
    def _derived(facts: DataFrame) -> DataFrame:
        """Add what follows from the facts of a line, but for what is there.

        Quantities and amounts come as whole hundredths (``_c``): sums of their products
        are exact in plain integers, and cheaper than in wide decimals.
        """
        made = {
            "order_id": text(F.col("order_key")),
            "product_id": text(F.col("product_key")),
            "supplier": text(F.col("supplier_key")),
            **{f"{n}_c": hundredths(F.col(f"{n}_d")) for n in ("quantity", "revenue", "discount", "tax")},
            "unit": F.when(F.col("product_key") % 2 == 0, rules.KG).otherwise("pc"),
        }
        return facts.withColumns({n: c for n, c in made.items() if n not in facts.columns})

    @once
    def lines(self) -> DataFrame:
        """Order lines with the raw facts the bindings draw on, and what follows from them."""
        return self._derived(self._facts())

    @staticmethod
    def _named(lines: DataFrame) -> DataFrame:
        """Add the id, quantity and revenue of a line.  Done after joins, so that a shuffle carries plain numbers."""
        parts = ["order_id", "line_number", "product_id", "supplier", "quantity_c", "revenue_c"]
        return lines.withColumns(
            {
                "id": F.concat_ws("-", *[text(F.col(c)) for c in parts], text(F.unix_date("ship_date"))),
                "quantity": from_units(F.col("quantity_c"), 2),
                "total_revenue": from_units(F.col("revenue_c"), 2),
            }
        )

    @once
    def _headers(self) -> DataFrame:
        day = F.col("o_orderdate").cast("date")
        return self._read("orders").select(
            text(F.col("o_orderkey")).alias("id"),
            F.col("o_orderkey").alias("order_key"),
            text(F.col("o_custkey")).alias("client_id"),
            day.alias("order_date"),
            F.date_add(day, (F.col("o_orderkey") % 5).cast("int")).alias("delivery_date"),
            F.col("o_orderdate").cast("timestamp").alias("created_at"),
            F.col("o_orderstatus").alias("order_status"),
            F.col("o_orderpriority").alias("priority"),
            cents(F.col("o_totalprice")).alias("quoted_price"),
        )

    @once
    def _order_types(self) -> DataFrame:
        heads = self._headers().select("id", "order_key", "client_id", "created_at")
        return with_parent(heads, self.clients("id", "type"), "client_id", {"client_type": "type"})

    @staticmethod
    def _price() -> Column:
        """The price a line was sold at: per quarter-kilo pack for a supermarket's kg goods, else per unit."""
        revenue, quantity = F.col("revenue_d"), F.col("quantity_d")
        packed = F.col("to_supermarket") & (F.col("unit") == rules.KG)
        return F.when(quantity > 0, F.when(packed, revenue / (quantity * 4)).otherwise(revenue / quantity))

    def _priced(self, facts: DataFrame) -> DataFrame:
        """Lines with the price that they were sold at, and what their order tells."""
        head = {"client_id": "client_id", "client_type": "client_type", "ordered_at": "created_at"}
        lines = self._derived(with_parent(facts, self._order_types(), "order_key", head, parent_key="order_key"))
        lines = lines.withColumn("to_supermarket", rules.is_supermarket(F.col("client_type")))
        return self._named(lines.withColumn("selling_price_used", self._price()))

    def _as_items(self, lines: DataFrame) -> DataFrame:
        """Lines that have met their parents as items, with what those parents tell."""
        items = self._named(self._derived(lines))
        if "to_supermarket" in lines.columns:
            items = items.withColumn("selling_price_used", self._price())
        if "cost_c" in lines.columns:
            items = items.withColumn("cost_used", from_units(F.col("cost_c"), 2))
            items = items.withColumn("total_cost", from_units(F.col("cost_c") * F.col("quantity_c"), 4))
        return items

    def _with_type(self, lines: DataFrame, key: str, parent_key: str) -> DataFrame:
        typed = with_parent(lines, self._order_types(), key, {"_client_type": "client_type"}, parent_key)
        return typed.withColumn("to_supermarket", rules.is_supermarket(F.col("_client_type"))).drop("_client_type")

    @once
    def order_items(self, *cols: str) -> DataFrame:
        wanted = self._columns("order_items", cols)
        lines = self._facts()
        if ITEM_PRICE & set(wanted):
            lines = self._with_type(lines, "order_key", "order_key")
        if ITEM_COST & set(wanted):
            lines = lines.withColumn("product_id", text(F.col("product_key")))
            lines = with_parent(lines, self._costs(), "product_id", {"cost_c": "cost_c"})
        return self._as_items(lines).select(*wanted)

    def order_items_in_two(self, *cols: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
        """Items by their keys and facts, and what adds the other columns, after lookups by product: first the product's cost, then,
        by ``order_id``, the price."""
        wanted = self._columns("order_items", cols)
        keys = {"order_id": "order_key", "product_id": "product_key"}
        facts = [c for c in self._facts().columns if c not in keys.values()]
        first = self._facts().select(*[text(F.col(c)).alias(n) for n, c in keys.items()], *[F.col(c).alias(f"_{c}") for c in facts])

        def complete(rows: DataFrame) -> DataFrame:
            # Kept apart, as a parent's column may have the name of a line's.
            added = [F.struct(c).alias(f"_added_{c}") for c in rows.columns if c not in first.columns]
            if ITEM_COST & set(wanted):
                rows = with_parent(rows, self._costs(), "product_id", {"_cost_c": "cost_c"})
            if ITEM_PRICE & set(wanted):
                rows = self._with_type(rows, "order_id", "id").withColumnRenamed("to_supermarket", "_to_supermarket")
            parents = [c for c in ("cost_c", "to_supermarket") if f"_{c}" in rows.columns]
            lines = rows.select(
                *keys, *[F.col(n).cast("long").alias(c) for n, c in keys.items()], *[F.col(f"_{c}").alias(c) for c in [*facts, *parents]], *added
            )
            return self._as_items(lines).select(*wanted, *[f"{c}.*" for c in lines.columns if c.startswith("_added_")])

        return first, complete

    # --------------------------------------------------------------- orders

    @once
    def orders(self, *cols: str) -> DataFrame:
        first, complete = self.orders_in_two(*cols)
        return complete(first)

    def orders_in_two(self, *cols: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
        """Headers, and what adds the sums of their lines, by ``id``, after other lookups."""
        wanted = self._columns("orders", cols)
        first = self._headers()

        def complete(orders: DataFrame) -> DataFrame:
            added = [c for c in orders.columns if c not in first.columns]
            need_cost = bool(ORDER_COST & set(wanted))
            if need_cost or ORDER_REVENUE & set(wanted):
                orders = orders.join(self._order_totals(need_cost), "id", "left")
                zero = F.lit(0).cast("decimal(18,2)")
                names = ["total_revenue", "transport_cost", "packaging_cost"] + (["farmer_cost"] if need_cost else [])
                orders = orders.withColumns({n: F.coalesce(F.col(n), zero) for n in names})
            if need_cost:
                cost = money(F.col("farmer_cost") + F.col("transport_cost") + F.col("packaging_cost"))
                orders = orders.withColumn("total_cost", cost)
                orders = orders.withColumn("net_profit", money(F.col("total_revenue") - F.col("total_cost")))
                margin = pct(F.col("net_profit"), F.col("total_revenue"))
                orders = orders.withColumns(
                    {"margin_percentage": round_half_up(margin, 2), "margin_zone": rules.margin_zone(margin)}
                )
            return orders.select(*wanted, *added)

        return first, complete

    def _costs(self) -> DataFrame:
        return self._read("part").select(text(F.col("p_partkey")).alias("id"), hundredths(F.col("p_retailprice")).alias("cost_c"))

    @once
    def _order_totals(self, with_cost: bool) -> DataFrame:
        lines = self.lines()
        sums = {
            "total_revenue": from_units(F.sum("revenue_c"), 2),
            "transport_cost": money(from_units(F.sum(F.col("revenue_c") * F.col("tax_c")), 4)),
            "packaging_cost": money(from_units(F.sum(F.col("revenue_c") * F.col("discount_c")), 4)),
        }
        if with_cost:
            costs = self._read("part").select("p_partkey", hundredths(F.col("p_retailprice")).alias("cost_c"))
            lines = with_parent(lines.drop("order_id"), costs, "product_key", {"cost_c": "cost_c"}, parent_key="p_partkey")
            lines = self._derived(lines)
            sums["farmer_cost"] = money(from_units(F.sum(F.col("cost_c") * F.col("quantity_c")), 4))
        return lines.groupBy(F.col("order_id").alias("id")).agg(*[c.alias(name) for name, c in sums.items()])

    @once
    def payments(self, *cols: str) -> DataFrame:
        wanted = self._columns("payments", cols)
        orders = self.orders("id", "client_id", "order_date", "delivery_date", "total_revenue", "order_status", "created_at")
        if {"due_date", "paid_date"} & set(wanted):
            orders = with_parent(orders, self.clients("id", "credit_days"), "client_id", {"credit_days": "credit_days"})
            orders = orders.withColumn("due_date", rules.due_date(F.col("delivery_date"), F.col("credit_days"), 30))
            orders = orders.withColumn("paid_date", F.when(F.col("order_status") == "F", F.col("due_date")))
        return orders.select(
            "*",
            F.concat(F.lit("pay-"), F.col("id")).alias("payment_id"),
            F.col("id").alias("order_id"),
            F.col("total_revenue").alias("amount"),
            F.col("order_date").alias("invoice_date"),
            F.when(F.col("order_status") == "F", rules.PAID).otherwise("pending").alias("status"),
        ).select(*[F.col("payment_id").alias("id") if c == "id" else F.col(c) for c in wanted])

    # ----------------------------------------------------------- inventory

    @once
    def _batch_rollup(self) -> DataFrame:
        month = F.trunc("ship_date", "month")
        qty = F.col("quantity_c")
        returned, accepted = F.col("return_flag") == "R", F.col("return_flag") == "A"

        def total(condition, units, scale):
            return money(from_units(F.coalesce(F.sum(F.when(condition, units)), F.lit(0)), scale))

        return (
            self.lines()
            .groupBy("product_id", month.alias("harvest_date"))
            .agg(
                from_units(F.sum(qty), 2).alias("harvested_qty"),
                total(F.col("line_status") == "F", qty, 2).alias("sold_qty"),
                total(returned, qty * F.col("discount_c"), 4).alias("damaged_qty"),
                total(accepted, qty * F.col("tax_c") * 2, 4).alias("expired_qty"),
                F.count_if(returned).alias("returned_lines"),
                F.count_if(accepted).alias("accepted_lines"),
                from_units(F.sum("tax_c"), 2).alias("tax_sum"),
                F.min(F.when(returned, F.col("order_key"))).alias("linked_order"),
            )
            .withColumn("id", F.concat_ws("-", "product_id", F.date_format("harvest_date", "yyyyMM")))
        )

    @once
    def batches(self, *cols: str) -> DataFrame:
        wanted = self._columns("inventory_batches", cols)
        batches = self._batch_rollup()
        waste = rules.waste_quantity(F.col("damaged_qty"), F.col("expired_qty"))
        batches = batches.withColumn("waste_percentage", rules.waste_percentage(waste, F.col("harvested_qty")))
        if "waste_value" in wanted:
            batches = with_parent(batches, self.products("id", "cost_per_unit"), "product_id", {"cost": "cost_per_unit"})
            value = rules.raw_waste_value(waste, F.col("cost"), F.lit(0))
            batches = batches.withColumn("waste_value", cents(value))
        return batches.withColumn("created_at", F.col("harvest_date").cast("timestamp")).select(*wanted)

    @once
    def waste_links(self) -> DataFrame:
        """Batch to order links, keyed by batch id (kg goods) or by product and harvest date."""
        linked = self._batch_rollup().filter(F.col("linked_order").isNotNull())
        linked = linked.select("id", "product_id", "harvest_date", text(F.col("linked_order")).alias("order_id"))
        orders = with_parent(
            self.orders("id", "client_id", "delivery_date"), self.clients("id", "name"), "client_id", {"client_name": "name"}
        )
        linked = with_parent(
            linked,
            orders,
            "order_id",
            {"client_id": "client_id", "client_name": "client_name", "delivery_date": "delivery_date"},
        )
        by_id = F.col("product_id").cast("long") % 2 == 0
        return linked.select(
            F.when(by_id, F.col("id")).otherwise(F.concat_ws("_", "product_id", text(F.col("harvest_date")))).alias("link_key"),
            "client_id",
            "client_name",
            "order_id",
            F.concat(F.col("client_name"), F.lit(" - "), text(F.col("delivery_date"))).alias("order_label"),
        )

    # ------------------------------------------------------------- prices

    @once
    def price_history(self, *cols: str) -> DataFrame:
        wanted = self._columns("client_pricing_history", cols)
        if wanted == ["product_id"]:
            return self.lines().select(*wanted)
        priced = self._priced(self._facts()).withColumnRenamed("ordered_at", "changed_at")
        return priced.withColumn("selling_price", cents(F.col("selling_price_used"))).select(*wanted)

    @once
    def client_pricing(self, *cols: str) -> DataFrame:
        wanted = self._columns("client_pricing", cols)
        latest = (
            self.price_history()
            .groupBy("client_id", "product_id")
            .agg(
                F.max_by("selling_price", F.struct("changed_at", "id")).alias("selling_price"),
                F.max("changed_at").alias("last_updated"),
            )
        )
        return latest.withColumn("id", F.concat_ws("-", F.lit("cp"), "client_id", "product_id")).select(*wanted)

    @once
    def margins(self) -> DataFrame:
        key = F.col("p_partkey")
        return (
            self._read("part")
            .filter(key % 10 != 0)  # products without a stored margin
            .select(text(key).alias("product_id"), dbl((key % 7) * 5).alias("profit_margin_pct"))
        )

    @once
    def variants(self) -> DataFrame:
        stored = self.products("id", "cost_per_unit").filter(F.col("id").cast("long") % 3 != 0)  # the rest have none
        weights = F.posexplode(F.array(*[F.lit(w) for w in rules.DEFAULT_WEIGHTS])).alias("position", "weight")
        return stored.select(F.col("id").alias("product_id"), "cost_per_unit", weights).select(
            "product_id", "position", "weight", rules.default_price(F.col("cost_per_unit"), F.col("weight")).alias("price")
        )

    def settings(self) -> Settings:
        return Settings()

    # ---------------------------------------------------------- documents

    def settings_documents(self) -> DataFrame:
        """One settings document per client: absent, unreadable, partial or whole."""
        kind = F.col("c_nationkey") % 4
        overhead = text(F.col("c_nationkey"))
        doc = (
            F.when(kind == 1, F.lit('{"overhead_pct": '))
            .when(kind == 2, F.concat(F.lit('{"overhead_pct": '), overhead, F.lit("}")))
            .when(kind == 3, F.concat(F.lit('{"overhead_pct": '), overhead, F.lit(', "labor_pct": 2.5}')))
        )
        return self._read("customer").select(text(F.col("c_custkey")).alias("owner"), doc.alias("doc"))

    def settings_changes(self) -> DataFrame:
        """Settings saved with each order of a client: both fields, one of them, cut off, or nothing to save."""
        key = F.col("o_orderkey")
        overhead, labor = text(key % 30), text(key % 7)
        doc = (
            F.when(key % 5 == 0, F.concat(F.lit('{"overhead_pct": '), overhead, F.lit(', "labor_pct": '), labor, F.lit("}")))
            .when(key % 5 == 1, F.concat(F.lit('{"overhead_pct": '), overhead, F.lit("}")))
            .when(key % 5 == 2, F.concat(F.lit('{"labor_pct": '), labor, F.lit("}")))
            .when(key % 5 == 3, F.concat(F.lit('{"labor_pct": '), labor))
        )
        return self._read("orders").filter(F.col("o_custkey") % 3 != 0).select(
            text(F.col("o_custkey")).alias("owner"), doc.alias("doc"), F.col("o_orderdate").cast("timestamp").alias("changed_at"), key.alias("seq")
        )

    def margin_documents(self) -> DataFrame:
        entry = F.create_map("product_id", "profit_margin_pct")
        return self.margins().select(F.to_json(entry).alias("doc"))

    def variant_documents(self) -> DataFrame:
        products = self.products("id", "cost_per_unit").filter(F.col("id").cast("long") % 3 != 0)
        sizes = [
            F.struct(F.lit(w).alias("weight"), rules.default_price(F.col("cost_per_unit"), F.lit(w)).alias("price"))
            for w in rules.DEFAULT_WEIGHTS
        ]
        return products.select(F.to_json(F.create_map("id", F.array(*sizes))).alias("doc"))

    def ledger_documents(self) -> DataFrame:
        """One ledger document per entry; those of clicks are cut off and cannot be read."""
        fields = ["id", "date", "type", dbl(F.col("amount")).alias("amount"), "description"]
        entries = self.ledger().withColumn("date", text(F.col("date")))
        doc = F.to_json(F.array(F.struct(*fields)))
        broken = F.col("type") == "click"
        return entries.select(F.when(broken, F.left(doc, F.length(doc) - 2)).otherwise(doc).alias("doc"))

    def ledger_entries(self) -> DataFrame:
        return documents.ledger(self.ledger_documents())

    def ledger_document_counts(self) -> DataFrame:
        return documents.ledger_counts(self.ledger_documents())

    # ------------------------------------------------------------- ledger

    @once
    def ledger(self) -> DataFrame:
        kind = F.col("event_type")
        return self._read("events").select(
            text(F.col("event_id")).alias("id"),
            F.col("ts").cast("date").alias("date"),
            F.when(kind == "signup", "initial")
            .when(kind == "purchase", "deposit")
            .when(kind == "error", "withdrawal")
            .otherwise(kind)
            .alias("type"),
            cents(F.col("value")).alias("amount"),
            F.when(kind == "view", "  ").otherwise(F.col("props")).alias("description"),
        )

    def change_events(self) -> DataFrame:
        return self._read("events").select(
            text(F.col("user_id")).alias("key"),
            F.col("ts").cast("timestamp").alias("ts"),
            F.col("event_id").alias("seq"),
            F.col("value").alias("value"),
        )

    # -------------------------------------------------------- change feeds

    @staticmethod
    def _event(when, at, seq: str, op: str = "upsert", **values) -> tuple:
        """What rows with ``when`` give a feed: themselves, with some values changed."""
        return when, {**values, "op": F.lit(op), "changed_at": at.cast("timestamp"), "seq": F.lit(seq)}

    @staticmethod
    def _several(rows: DataFrame, columns: list[str], *made: tuple) -> DataFrame:
        """Of each row one row per (when, changed values) that holds for it, from one pass over the rows.

        Columns that none of them changes stay beside the list, where a filter on them reaches the rows.
        """
        types = dict(zip(rows.columns, (f.dataType for f in rows.schema)))
        changed = [c for c in columns if any(c in values for _, values in made)]

        def one(when, values):
            row = F.struct(*[(values[c].cast(types[c]) if c in types else values[c]).alias(c) if c in values else F.col(c) for c in changed])
            return F.when(when, row)

        same = [c for c in columns if c not in changed]
        return rows.select(*same, F.inline(F.array_compact(F.array(*[one(*m) for m in made])))).select(*columns)

    def _feed_of(self, rows: DataFrame, columns: list[str], *events: tuple) -> DataFrame:
        return self._several(rows, ["id", *columns, "op", "changed_at", "seq"], *events)

    def order_feed(self) -> DataFrame:
        """Orders as they came, were moved to another day or client, and were deleted."""
        columns = ["client_id", "order_date", "total_revenue", "net_profit", "transport_cost", "packaging_cost", "margin_percentage"]
        items = self.order_items("order_id", "total_cost").groupBy("order_id").agg(F.sum("total_cost").cast("decimal(18,4)").alias("base_cost"))
        rows = with_parent(self.orders("id", *columns), items, "id", {"base_cost": "base_cost"}, parent_key="order_id")
        heads = self._headers().select("id", "priority", "order_status", "quoted_price", F.col("created_at").cast("date").alias("came"))
        rows = rows.join(heads, "id")
        zero = F.lit(0).cast("decimal(18,2)")
        every, urgent = F.lit(True), F.col("priority") == "1-URGENT"
        return self._feed_of(
            rows,
            [*columns, "base_cost"],
            self._event(every, F.date_sub("came", 1), "draft", total_revenue=zero, net_profit=zero, base_cost=F.lit(None).cast("decimal(18,4)")),
            self._event(every, F.col("came"), "order"),
            self._event(urgent, F.date_add("came", 3), "moved", order_date=F.date_add("order_date", 2), total_revenue=F.col("quoted_price")),
            self._event(F.col("priority") == "2-HIGH", F.date_add("came", 3), "client", client_id=F.concat(F.lit("new-"), F.col("client_id"))),
            self._event(F.col("order_status") == "P", F.date_add("came", 5), "gone", "delete"),
        )

    def payment_feed(self) -> DataFrame:
        """Payments as they were due, paid, set to another amount, and deleted."""
        heads = self._headers().select(F.col("id").alias("order_id"), "priority", "order_status", "quoted_price", F.col("created_at").cast("date").alias("came"))
        rows = self.payments("id", "order_id", "amount").join(heads, "order_id").withColumn("status", F.lit("pending"))
        state = F.when(F.col("order_status") == "F", rules.PAID).otherwise("pending")
        return self._feed_of(
            rows,
            ["amount", "status"],
            self._event(F.lit(True), F.col("came"), "due"),
            self._event(F.col("order_status") == "F", F.date_add("came", 10), "paid", status=F.lit(rules.PAID)),
            self._event(F.col("priority") == "2-HIGH", F.date_add("came", 20), "set", status=state, amount=money(F.col("quoted_price") - 2)),
            self._event(F.col("priority") == "5-LOW", F.date_add("came", 30), "gone", "delete"),
        )

    def batch_feed(self) -> DataFrame:
        """Batches as they were taken in, edited, and deleted."""
        columns = ["harvested_qty", "damaged_qty", "expired_qty", "waste_value"]
        rows = self.batches("id", "product_id", "harvest_date", *columns)
        rows = with_parent(rows, self.products("id", "cost_per_unit"), "product_id", {"cost": "cost_per_unit"})
        day = F.col("harvest_date")
        return self._feed_of(
            rows,
            columns,
            self._event(F.lit(True), day, "in"),
            self._event(
                F.col("damaged_qty") > 0, F.date_add(day, 40), "edit", harvested_qty=money(F.col("harvested_qty") + 1),
                expired_qty=money(F.lit(0)), waste_value=cents(F.col("damaged_qty") * F.col("cost")),
            ),
            self._event(F.col("product_id").cast("long") % 7 == 0, F.date_add(day, 60), "gone", "delete"),
        )

    # ----------------------------------------------------- change requests

    @once
    def _feed(self) -> DataFrame:
        """The line table as a change feed: returned lines delete, seventh lines name new products."""
        return self._feed_of_lines(self.lines())

    def _feed_of_lines(self, lines: DataFrame, *more: str) -> DataFrame:
        price = F.col("revenue_d") / F.col("quantity_d")
        new = F.col("line_number") == 7
        return self._named(lines).select(
            *more,
            "order_id",
            F.when(new, F.concat(F.lit("new-"), F.col("product_id"))).otherwise(F.col("product_id")).alias("product_id"),
            F.col("product_id").alias("known_product_id"),
            F.concat(F.lit("supplied by "), F.col("supplier")).alias("name"),
            cents(price).alias("price"),
            dbl(F.col("discount_c")).alias("discount_pct"),
            F.when(F.col("return_flag") == "R", "delete").otherwise("upsert").alias("op"),
            F.col("ship_date").cast("timestamp").alias("changed_at"),
            F.col("id").alias("seq"),
            "line_number",
        )

    def _faulty(self, feed: DataFrame, blanks: dict[int, dict]) -> DataFrame:
        """The feed, and later upserts that leave out what a write asks for, by line number."""
        late = {"changed_at": F.date_add("changed_at", 9000).cast("timestamp"), "seq": F.concat(F.lit("bad-"), F.col("seq"))}
        wrong = [((F.col("line_number") == n) & (F.col("op") == "upsert"), {**late, **blank}) for n, blank in blanks.items()]
        return self._several(feed, feed.columns, (F.lit(True), {}), *wrong)

    def product_changes(self) -> DataFrame:
        feed = self._faulty(self._feed(), {3: {"name": F.lit("")}, 4: {"name": F.lit(None).cast("string"), "price": F.lit(None).cast("decimal(18,2)")}})
        return feed.select(
            F.col("product_id").alias("id"), "name", F.col("price").alias("cost_per_unit"), "op", "changed_at", "seq"
        )

    def client_changes(self) -> DataFrame:
        """Clients renamed, or removed, by what their orders say; some are left without a name."""
        nameless = (F.col("priority") == "4-NOT SPECIFIED") & (F.col("order_status") == "O")
        heads = self._headers()
        changes = self._client_changes(heads)
        late = F.date_add("changed_at", 9000).cast("timestamp")
        wrong = self._client_changes(heads.filter(nameless)).withColumns({"name": F.lit(""), "changed_at": late, "seq": F.concat(F.lit("bad-"), F.col("seq"))})
        return changes.unionByName(wrong)

    @staticmethod
    def _client_changes(heads: DataFrame) -> DataFrame:
        return heads.select(
            F.when(F.col("priority") == "3-MEDIUM", F.concat(F.lit("new-"), F.col("client_id")))
            .otherwise(F.col("client_id"))
            .alias("id"),
            F.concat(F.lit("renamed by "), F.col("id")).alias("name"),
            F.when(F.col("priority") == "1-URGENT", 60).alias("credit_days"),
            F.when(F.col("order_status") == "P", "delete").otherwise("upsert").alias("op"),
            F.col("created_at").alias("changed_at"),
            F.col("id").alias("seq"),
        )

    def price_changes(self) -> DataFrame:
        # Lines meet their order as numbers, before ids and texts are made of them.
        lines = with_parent(self._facts(), self._headers(), "order_key", {"client_id": "client_id"}, parent_key="order_key")
        feed = self._feed_of_lines(self._derived(lines), "client_id")
        feed = self._faulty(feed, {3: {"client_id": F.lit("")}, 4: {"product_id": F.lit("")}, 5: {"price": F.lit(None).cast("decimal(18,2)")}})
        return feed.select("client_id", "product_id", F.col("price").alias("selling_price"), "op", "changed_at", "seq")

    def margin_changes(self) -> DataFrame:
        return self._feed().select(
            F.col("known_product_id").alias("product_id"),
            F.col("discount_pct").alias("profit_margin_pct"),
            F.lit("upsert").alias("op"),
            "changed_at",
            "seq",
        )

    def variant_changes(self) -> DataFrame:
        """Each change replaces a product's whole list of pack sizes."""
        sizes = [
            F.struct(F.lit(w).alias("weight"), rules.default_price(F.col("price"), F.lit(w)).alias("price")) for w in (0.5, 1.0)
        ]
        return self._feed().select(
            F.col("known_product_id").alias("product_id"),
            F.array(*sizes).alias("variants"),
            F.lit("upsert").alias("op"),
            "changed_at",
            "seq",
        )

    def deleted_orders(self) -> DataFrame:
        return self._headers().filter(F.col("order_status") == "P").select("id")

    def price_offers(self) -> DataFrame:
        """One price per product, to be set for the clients picked for it."""
        margins = self.margins()
        offers = with_parent(
            self.products("id", "cost_per_unit"), margins, "id", {"margin": "profit_margin_pct"}, parent_key="product_id"
        )
        price = rules.suggested_price(F.col("cost_per_unit"), F.col("margin"), self.settings())
        return offers.select(
            F.col("id").alias("request_id"), F.col("id").alias("product_id"), cents(price).alias("selling_price")
        )

    def offer_picks(self) -> DataFrame:
        """Which clients each offer goes to: those whose orders drew on the supplier of that number."""
        lines = with_parent(self.lines().select("order_id", "supplier"), self._headers(), "order_id", {"client_id": "client_id"})
        return lines.select(F.col("supplier").alias("request_id"), "client_id").distinct()

    def _faulty_forms(self, heads: DataFrame, prefix: str) -> tuple[DataFrame, DataFrame]:
        """Forms for these orders that break a rule each, or two, by the order's priority."""
        kind = F.col("priority")
        zero = F.lit(0).cast("decimal(18,2)")
        headers = heads.select(
            F.concat(F.lit(prefix), F.col("id")).alias("id"),
            F.when(kind == "1-URGENT", "").otherwise(F.col("client_id")).alias("client_id"),
            "order_date",
            F.when(kind == "2-HIGH", F.date_sub("order_date", 1)).otherwise(F.col("delivery_date")).alias("delivery_date"),
            F.when(kind == "3-MEDIUM", F.lit(-1).cast("decimal(18,2)")).otherwise(zero).alias("transport_cost"),
            zero.alias("packaging_cost"),
        )
        lines = heads.filter(kind != "1-URGENT").select(
            F.concat(F.lit(f"{prefix}bad-"), F.col("id")).alias("id"),
            F.concat(F.lit(prefix), F.col("id")).alias("order_id"),
            F.lit("1").alias("product_id"),
            F.when(kind == "5-LOW", zero).otherwise(F.lit(2).cast("decimal(18,2)")).alias("quantity"),
            F.when(kind == "4-NOT SPECIFIED", F.lit(0.0)).otherwise(F.lit(5.0)).alias("selling_price_used"),
            F.lit(1).cast("decimal(18,2)").alias("cost_used"),
            F.lit(None).cast("double").alias("num_packages"),
        )
        return headers, lines

    def order_forms(self) -> tuple[DataFrame, DataFrame]:
        """Forms for new orders, none of which can be accepted."""
        return self._faulty_forms(self._headers().filter(F.col("order_status") == "P"), "form-")

    def order_updates(self) -> tuple[DataFrame, DataFrame]:
        """New header and new lines for orders in progress: later delivery, returned lines dropped, prices up 10%.

        Those for open orders can't be accepted.
        """
        good, bad = self._order_updates(), self._faulty_forms(self._headers().filter(F.col("order_status") == "O"), "")
        return good[0].unionByName(bad[0]), good[1].unionByName(bad[1])

    def _order_updates(self) -> tuple[DataFrame, DataFrame]:
        headers = self.orders("id", "client_id", "order_date", "delivery_date", "transport_cost", "packaging_cost", "order_status")
        headers = headers.filter(F.col("order_status") == "P").drop("order_status")
        headers = headers.withColumn("delivery_date", F.date_add("delivery_date", 1))
        # Lines meet their order as numbers, as they do for their price: one shuffle serves both.
        open_ = self._headers().filter(F.col("order_status") == "P").select("order_key")
        lines = self._priced(self._facts().filter(F.col("return_flag") != "R").join(open_, "order_key", "left_semi"))
        lines = with_parent(lines, self.products("id", "cost_per_unit"), "product_id", {"cost_used": "cost_per_unit"})
        packs = rules.recovered_packs(F.col("unit") == rules.KG, F.col("selling_price_used"), F.col("total_revenue"))
        lines = lines.select(
            F.concat(F.lit("u-"), F.col("id")).alias("id"),
            "order_id",
            "product_id",
            "quantity",
            (F.col("selling_price_used") * 1.1).alias("selling_price_used"),
            "cost_used",
            packs.alias("num_packages"),
        )
        return headers, lines

    def order_log(self) -> DataFrame:
        """Updates, waste deductions, payment actions and deletes of orders as one log; some can't be accepted."""
        from packhouse.plans.order_log import ACTION

        columns = [f.name for f in T.StructType.fromDDL(ACTION)]
        heads = self._headers().select(F.col("id").alias("order_id"), "client_id", "delivery_date", "priority", "order_status", "quoted_price", F.col("created_at").cast("date").alias("came"))
        heads = with_parent(heads, self.clients("id", "credit_days"), "client_id", {"credit_days": "credit_days"})

        def act(rows, kind, at, **values):
            made = rows.select(
                F.concat(F.lit(f"{kind}-"), values.pop("ref", F.col("order_id"))).alias("action_id"), "order_id", F.lit(kind).alias("kind"),
                at.cast("timestamp").alias("changed_at"), *[c.alias(n) for n, c in values.items()],
            )
            types = {f.name: f.dataType for f in T.StructType.fromDDL(ACTION)}
            return made.select(*[(F.col(c) if c in made.columns else F.lit(None)).cast(types[c]).alias(c) for c in columns])

        priority, quoted = F.col("priority"), F.col("quoted_price")
        later = F.date_add("delivery_date", 3)
        now = money(quoted - 3)
        cost = money(quoted - 103)
        # The order that a batch's link names: links are keyed by batch, so each batch has its own.
        linked = self._batch_rollup().filter(F.col("linked_order").isNotNull()).withColumn("order_id", text(F.col("linked_order")))
        linked = with_parent(linked, self.products("id", "cost_per_unit"), "product_id", {"cost": "cost_per_unit"})
        waste = ((F.col("damaged_qty") + F.col("expired_qty")) * F.col("cost")).cast("decimal(18,4)")
        return reduce(
            DataFrame.unionByName,
            [
                act(
                    heads.filter(F.col("order_status") == "P"), "update", F.date_add("came", 20), client_id=F.col("client_id"), delivery_date=later,
                    total_revenue=now, total_cost=cost, net_profit=now - cost, margin_percentage=F.lit(25.0), margin_zone=F.lit("red"),
                    due_date=rules.due_date(later, F.col("credit_days"), 30),
                ),
                act(linked, "deduct", F.date_add("harvest_date", (F.col("product_id").cast("long") % 60).cast("int")), ref=F.col("id"), waste_value=waste),
                act(heads.filter(priority.isin("2-HIGH", "1-URGENT")), "set_amount", F.date_add("came", 30), amount=quoted - 2),
                # Asked for without an amount: not accepted.
                act(heads.filter(priority == "3-MEDIUM"), "set_amount", F.date_add("came", 40), amount=F.lit(0)),
                act(heads.filter(priority == "1-URGENT"), "mark_paid", F.date_add("came", 35)),
                act(heads.filter(priority == "5-LOW"), "delete_payment", F.date_add("came", 5)),
                act(heads.filter(F.col("order_id").cast("long") % 11 == 0), "delete_order", F.date_add("came", 50)),
            ],
        )

    def batch_forms(self) -> DataFrame:
        """Intake forms: waste counted in quarter-kilo packs, packaging cost per unit, and the order the waste is taken off.

        Those of some products come again with something wrong, by product.
        """
        forms = self._batch_forms()
        kind = F.col("product_id").cast("long") % 40
        none = F.lit(None)
        wrong = {
            "id": F.concat(F.lit("bad-"), F.col("id")),
            "harvested_qty": F.when(kind == 1, none).when(kind == 2, F.lit(-1)).otherwise(F.col("harvested_qty")),
            "damaged_count": F.when(kind == 3, F.lit(-4)).otherwise(F.col("damaged_count")),
            "expired_count": F.when(kind == 4, F.lit(-4)).otherwise(F.col("expired_count")),
            "product_id": F.when(kind == 0, F.lit("")).otherwise(F.col("product_id")),
        }
        return self._several(forms, forms.columns, (F.lit(True), {}), (kind < 5, wrong))

    def _batch_forms(self) -> DataFrame:
        return self._batch_rollup().select(
            F.concat(F.lit("in-"), F.col("id")).alias("id"),
            "product_id",
            "harvest_date",
            "harvested_qty",
            "sold_qty",
            F.lit(0.25).alias("damaged_pkg_size"),
            F.col("returned_lines").alias("damaged_count"),
            F.lit(0.25).alias("expired_pkg_size"),
            F.col("accepted_lines").alias("expired_count"),
            F.col("tax_sum").alias("packaging_cost"),
            text(F.col("linked_order")).alias("order_id"),
        )

    def deleted_batches(self) -> DataFrame:
        gone = (F.col("product_id").cast("long") % 9 < 2) & (F.month("harvest_date") % 2 == 1)
        return self._batch_rollup().filter(gone).select("id")

    def batch_edits(self) -> DataFrame:
        """Edits of batches with damage: one unit more harvested, nothing expired."""
        return (
            self.batches("id", "harvested_qty", "damaged_qty")
            .filter(F.col("damaged_qty") > 0)
            .select(
                "id",
                money(F.col("harvested_qty") + 1).alias("harvested_qty"),
                "damaged_qty",
                money(F.lit(0)).alias("expired_qty"),
            )
        )

    def payment_actions(self) -> DataFrame:
        """Mark paid, set an amount (twice for some), delete: by the order's priority."""
        actions = self._headers().select(
            F.concat(F.lit("pay-"), F.col("id")).alias("id"), "priority", "quoted_price", "created_at"
        )

        def act(priorities, action, amount, days, seq):
            return actions.filter(F.col("priority").isin(*priorities)).select(
                "id",
                F.lit(action).alias("action"),
                amount.cast("decimal(18,2)").alias("amount"),
                F.date_add(F.col("created_at").cast("date"), days).cast("timestamp").alias("changed_at"),
                F.lit(seq).cast("long").alias("seq"),
            )

        none = F.lit(None)
        quoted = F.col("quoted_price")
        return reduce(
            DataFrame.unionByName,
            [
                act(["1-URGENT"], "mark_paid", none, 10, 1),
                act(["1-URGENT", "2-HIGH"], "set_amount", quoted - 1, 10, 2),
                act(["2-HIGH"], "set_amount", quoted - 2, 20, 3),
                act(["5-LOW"], "delete", none, 5, 4),
                # An amount of nothing, and one below: not accepted.
                act(["3-MEDIUM"], "set_amount", F.lit(0), 50, 5),
                act(["4-NOT SPECIFIED"], "set_amount", F.lit(-5), 50, 6),
            ],
        )

    def ledger_additions(self) -> DataFrame:
        """A deposit for each paid invoice; unpaid ones come without a description, some with an amount below zero."""
        payments = self.payments("id", "paid_date", "amount", "status")
        paid = F.col("status") == rules.PAID
        odd = F.substring("id", 5, 20).cast("long") % 2 == 1
        return payments.select(
            "id",
            F.col("paid_date").alias("date"),
            F.lit("deposit").alias("type"),
            F.when(paid | ~odd, F.col("amount")).otherwise(-F.col("amount")).cast("decimal(18,2)").alias("amount"),
            F.when(paid, " invoice paid ").otherwise("  ").alias("description"),
        )

    def ledger_deletes(self) -> DataFrame:
        return self._read("events").filter(F.col("event_type") == "click").select(text(F.col("event_id")).alias("id"))

    def draft_lines(self) -> DataFrame:
        """Order-form lines as typed: text fields, some blank or with a unit after the number."""
        flag = F.col("return_flag")
        count = text(F.col("quantity_d").cast("int"))
        return self._named(self.lines()).select(
            "id",
            "order_id",
            "product_id",
            F.when(flag == "R", "0.25kg").when(flag == "A", ".5").otherwise("").alias("package_size"),
            F.when(F.col("line_status") == "F", F.concat(count, F.lit(".9"))).otherwise(count).alias("num_packages"),
            F.when(flag == "N", F.concat(count, F.lit(" pieces"))).otherwise(count).alias("qty"),
        )

    def reassigned_lines(self) -> DataFrame:
        """Draft lines moved to another client."""
        return self._priced(self._facts()).select("id", "product_id", F.col("supplier").alias("new_client_id"), "selling_price_used")

    def pricing_entries(self) -> DataFrame:
        """What a user typed into the price calculator for each product."""
        size = F.col("p_size")
        typed = text((size / 10).cast("decimal(18,1)"))
        return self._read("part").select(
            text(F.col("p_partkey")).alias("product_id"),
            F.when(size < 5, "").otherwise(typed).alias("new_size"),
            text(cents(F.col("p_retailprice") * size / 10)).alias("new_price"),
            text(size).alias("new_margin"),
        )
