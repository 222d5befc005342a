"""Lists of the stored tables with their parents' fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from packhouse.config import Params
from packhouse.functions import rules
from packhouse.functions.numbers import pct
from packhouse.functions.text import DASH, UNKNOWN
from packhouse.operators.lookups import in_two, with_parent
from packhouse.operators.slices import crowded, numbered, numbered_whole


def products_by_name(t, p: Params) -> DataFrame:
    columns = ["id", "name", "name_ar", "unit", "cost_per_unit", "profit_margin_pct", "shelf_life_days", "created_at"]
    return t.products(*columns).orderBy(F.collate("name", "UNICODE"), "id")


def clients_by_name(t, p: Params) -> DataFrame:
    return t.clients("id", "name", "name_ar", "type", "phone", "credit_days").orderBy(F.collate("name", "UNICODE"), "id")


def client_price_list(t, p: Params, client_id: str | None = None) -> DataFrame:
    prices = t.client_pricing("id", "client_id", "product_id", "selling_price", "last_updated")
    prices = prices.withColumn("last_updated", F.date_format("last_updated", "yyyy-MM-dd"))
    if client_id:
        prices = prices.filter(F.col("client_id") == client_id)
    prices = with_parent(prices, t.products("id", "name", "unit"), "product_id", {"product_name": "name", "unit": "unit"})
    return with_parent(prices, t.clients("id", "name"), "client_id", {"client_name": "name"})


def price_history_of(t, p: Params, client_id: str | None, product_id: str | None) -> DataFrame:
    """Prices of one client and product, newest first; nothing unless both are given."""
    history = t.price_history("id", "client_id", "product_id", "selling_price", "changed_at")
    if not client_id or not product_id:
        return history.limit(0)
    one = (F.col("client_id") == client_id) & (F.col("product_id") == product_id)
    return history.filter(one).orderBy(F.col("changed_at").desc(), F.col("id").desc())


def price_history(t, p: Params) -> DataFrame:
    """Every price with its version number, 1 for the newest of its client and product."""
    history = t.price_history("id", "client_id", "product_id", "selling_price", "changed_at")
    by = ["client_id", "product_id"], [F.col("changed_at").desc(), F.col("id").desc()], "version"
    # A client's prices of a product are no more than all of that product.
    large = crowded(t.price_history("product_id"))
    if large is None:
        versions = numbered_whole(history, *by)
    else:
        # Months, newest first; prices without a time come last.
        months = F.coalesce(-(F.year("changed_at") * 12 + F.month("changed_at")), F.lit(1))
        versions = numbered_whole(history.filter(~large), *by).unionByName(numbered(history.filter(large), *by, slice_=months))
    return versions.select(
        "id", "client_id", "product_id", "selling_price", F.date_format("changed_at", "yyyy-MM-dd").alias("changed_on"), "version"
    )


def orders_with_client(t, p: Params) -> DataFrame:
    orders = t.orders(
        "id", "client_id", "order_date", "delivery_date", "transport_cost", "packaging_cost", "total_revenue", "total_cost",
        "net_profit", "margin_percentage", "margin_zone",
    )
    fields = {"client_name": "name", "client_name_ar": "name_ar", "client_type": "type"}
    listed = with_parent(orders, t.clients("id", *fields.values()), "client_id", fields)
    return listed.orderBy(F.col("delivery_date").desc(), F.col("order_date").desc(), "id")


def _order_heads(t, columns: list[str], fields: dict[str, str]) -> DataFrame:
    heads, complete = in_two(t, "orders", "id", "client_id", *columns)
    return complete(with_parent(heads, t.clients("id", *fields.values()), "client_id", fields)).withColumnRenamed("id", "order_id")


def _items_with_product(t, keep: Column | None = None, **more: Column) -> DataFrame:
    """Items, of those asked for, with ``more`` columns and their product; they meet it by their keys and facts alone."""
    items, complete = in_two(t, "order_items", "id", "order_id", "product_id", "quantity", "selling_price_used", "cost_used", "total_revenue", "total_cost")
    items = (items if keep is None else items.filter(keep)).withColumns(more)
    items = complete(with_parent(items, t.products("id", "name", "unit"), "product_id", {"product_name": "name", "unit": "unit"}))
    return items.withColumnsRenamed({"id": "item_id", "total_revenue": "line_revenue", "total_cost": "line_cost"})


def order_documents(t, p: Params) -> DataFrame:
    """The order document as rows: each item with its position in the order (by id) and all fields of the order's head.

    Orders without items keep one row, at position 0.  Items meet their product first; one shuffle by order then serves both
    the numbering and the heads.  Only the items of very large orders are numbered in slices, and split over the join.
    """
    cols = ["transport_cost", "packaging_cost", "total_cost", "net_profit", "margin_percentage", "margin_zone"]
    fields = {"client_name": "name", "client_name_ar": "name_ar", "client_type": "type", "client_phone": "phone", "credit_days": "credit_days"}
    heads = _order_heads(t, ["order_date", "delivery_date", "total_revenue", *cols], fields)
    ids = t.order_items("order_id", "id").withColumnRenamed("id", "item_id").filter(F.col("order_id").isNotNull())
    none = F.lit(0).cast("long")

    def whole(keep, heads):
        # Rows of one item count once, as a parent that repeats gives an item several.  An id that comes more than once in an
        # order takes all of its positions, each time.
        items = _items_with_product(t, keep, _row=F.monotonically_increasing_id())
        same = Window.partitionBy("order_id", "item_id")
        items = items.withColumn("counts", F.when(F.lag("_row").over(same.orderBy("_row")) == F.col("_row"), 0).otherwise(1))
        last = F.sum("counts").over(Window.partitionBy("order_id").orderBy("item_id"))
        items = items.withColumns({"last": last, "twins": F.sum("counts").over(same)})
        placed = items.withColumn("position", F.explode(F.sequence(F.expr("last - twins + 1"), "last"))).drop("_row", "counts", "last", "twins")
        return placed.join(heads, "order_id", "right").withColumn("position", F.coalesce("position", none))

    known = F.col("order_id").isNotNull()
    large = crowded(ids.select("order_id"))
    if large is None:
        return whole(known, heads)
    few, rest = whole(known & ~large, heads.filter(~large)), heads.filter(large)
    empty = rest.join(ids.select("order_id").filter(large).distinct(), "order_id", "left_anti").withColumn("position", none)
    numbers = numbered(ids.filter(large), ["order_id"], [F.col("item_id").asc()], "position")
    placed = _items_with_product(t, known & large).join(numbers, ["order_id", "item_id"])
    return few.unionByName(placed.join(rest, "order_id", "inner")).unionByName(empty, allowMissingColumns=True)


def order_documents_flat(t, p: Params) -> DataFrame:
    """One row per order and item; orders without items keep one row.

    The items lead the join, so that the lines of one very large order can be split
    over many tasks; orders without items are added by an anti join on distinct keys.
    """
    fields = {"client_name": "name", "client_type": "type", "client_phone": "phone", "credit_days": "credit_days"}
    heads = _order_heads(t, ["order_date", "delivery_date", "total_revenue"], fields)
    # Orders without id stand apart, so that both joins ask for the same heads, which are then shuffled once.
    known, unknown = heads.filter(F.col("order_id").isNotNull()), heads.filter(F.col("order_id").isNull())
    empty = known.join(t.order_items("order_id").distinct(), "order_id", "left_anti").unionByName(unknown)
    return _items_with_product(t).join(known, "order_id", "inner").unionByName(empty, allowMissingColumns=True)


def batches_with_product(t, p: Params) -> DataFrame:
    batches = t.batches(
        "id", "product_id", "harvest_date", "harvested_qty", "sold_qty", "damaged_qty", "expired_qty", "waste_percentage", "waste_value"
    )
    fields = {"product_name": "name", "unit": "unit", "cost_per_unit": "cost_per_unit"}
    listed = with_parent(batches, t.products("id", *fields.values()), "product_id", fields)
    return listed.orderBy(F.col("harvest_date").desc(), "id")


def _payments_with_client(t) -> DataFrame:
    payments = t.payments("id", "order_id", "amount", "invoice_date", "due_date", "paid_date", "status")
    orders = t.orders("id", "client_id", "delivery_date", "total_revenue")
    fields = {"client_id": "client_id", "delivery_date": "delivery_date", "order_revenue": "total_revenue"}
    payments = with_parent(payments, orders, "order_id", fields)
    return with_parent(payments, t.clients("id", "name"), "client_id", {"client_name": "name"})


def payments_with_client(t, p: Params) -> DataFrame:
    return _payments_with_client(t).orderBy("due_date", "id")


def receivables_aging(t, p: Params) -> DataFrame:
    rows = _payments_with_client(t)
    days = rules.days_past_due(p.as_of, F.col("due_date"))
    open_ = F.coalesce(F.col("status") != rules.PAID, F.lit(True))
    overdue = open_ & (F.col("days") > 0)
    left = F.concat(F.abs("days").cast("string"), F.lit("d left"))
    return (
        rows.withColumn("days", days)
        .select(
            "id",
            F.coalesce("client_name", F.lit(DASH)).alias("client_name"),
            "invoice_date",
            "due_date",
            "amount",
            F.col("days").alias("days_past_due"),
            F.coalesce(overdue, F.lit(False)).alias("is_overdue"),
            F.when(overdue, "overdue").otherwise(F.col("status")).alias("badge"),
            F.when(~open_, DASH)
            .when(F.col("days") > 0, F.concat(F.col("days").cast("string"), F.lit("d overdue")))
            .otherwise(left)
            .alias("days_text"),
        )
    )


def sales_fact(t, p: Params) -> DataFrame:
    """Order lines with product, order and client fields."""
    items = t.order_items("id", "order_id", "product_id", "quantity", "selling_price_used", "total_revenue", "total_cost")
    product = {"product_name": "name", "unit": "unit", "cost_per_unit": "cost_per_unit"}
    items = with_parent(items, t.products("id", *product.values()), "product_id", product)
    heads = with_parent(t.orders("id", "order_date", "client_id"), t.clients("id", "name"), "client_id", {"client_name": "name"})
    return with_parent(items, heads, "order_id", {"order_date": "order_date", "client_id": "client_id", "client_name": "client_name"})


def client_order_count(t, p: Params) -> DataFrame:
    counts = t.orders("client_id").groupBy("client_id").agg(F.count(F.lit(1)).alias("n"))
    clients = t.clients("id").select(F.col("id").alias("client_id"))
    return clients.join(counts, "client_id", "left").select("client_id", F.coalesce("n", F.lit(0)).alias("order_count"))


def client_orders(t, p: Params, client_id: str | None = None) -> DataFrame:
    """The orders to choose from once a client is chosen (all clients when none is), with the text of each choice."""
    orders = t.orders("id", "client_id", "order_date", "delivery_date", "total_revenue")
    if client_id:
        orders = orders.filter(F.col("client_id") == client_id)
    orders = with_parent(orders, t.clients("id", "name"), "client_id", {"client_name": "name"})
    amount = F.coalesce("total_revenue", F.lit(0)).cast("decimal(18,2)").cast("string")
    parts = [F.coalesce("client_name", F.lit(DASH)), F.col("delivery_date").cast("string"), F.concat(amount, F.lit(" EGP"))]
    return orders.withColumn("option_text", F.concat_ws(f" {DASH} ", *parts)).drop("client_name")


def client_price_map(t, p: Params) -> DataFrame:
    """Each client's agreed price of each product, one row each."""
    return t.client_pricing("client_id", "product_id", "selling_price")


def pricing_items_by_client(t, p: Params) -> DataFrame:
    """The items of each client's price list."""
    prices = t.client_pricing("id", "client_id", "product_id", "selling_price", "last_updated")
    prices = with_parent(prices, t.products("id", "name", "unit"), "product_id", {"product_name": "name", "unit": "unit"})
    prices = with_parent(prices, t.clients("id", "name", "type"), "client_id", {"client_name": "name", "client_type": "type"})
    return prices.withColumns(
        {"client_name": F.coalesce("client_name", F.lit(UNKNOWN)), "last_updated": F.date_format("last_updated", "yyyy-MM-dd")}
    )


def pricing_by_client(t, p: Params) -> DataFrame:
    """Clients with a price list: type and number of priced products, by name."""
    counts = t.client_pricing("client_id").groupBy("client_id").agg(F.count(F.lit(1)).alias("product_count"))
    named = with_parent(counts, t.clients("id", "name", "type"), "client_id", {"client_name": "name", "client_type": "type"})
    named = named.withColumn("client_name", F.coalesce("client_name", F.lit(UNKNOWN)))
    badge = F.when(rules.is_supermarket(F.col("client_type")), "Supermarket").otherwise("Restaurant")
    return named.select("client_id", "client_name", badge.alias("badge"), "product_count").orderBy(
        F.collate("client_name", "UNICODE"), "client_id"
    )


def client_price_margin(t, p: Params) -> DataFrame:
    """Margin on revenue of each agreed price over the product's cost."""
    prices = t.client_pricing("id", "client_id", "product_id", "selling_price")
    product = {"product_name": "name", "unit": "unit", "cost": "cost_per_unit"}
    prices = with_parent(prices, t.products("id", *product.values()), "product_id", product)
    prices = with_parent(prices, t.clients("id", "name"), "client_id", {"client_name": "name"})
    cost = F.coalesce(F.col("cost"), F.lit(0).cast("decimal(18,2)"))
    margin = pct(F.col("selling_price") - cost, F.col("selling_price"))
    th = p.thresholds
    return prices.select(
        "id",
        "client_name",
        F.concat(F.col("product_name"), F.lit(" ("), F.col("unit"), F.lit(")")).alias("product_label"),
        "selling_price",
        cost.alias("base_cost"),
        margin.alias("margin"),
        rules.three_tiers(margin, th.margin_high, th.margin_mid).alias("margin_tier"),
    )
