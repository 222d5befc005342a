"""Order economics, line rules, documents for the client."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packhouse.config import Params
from packhouse.functions import rules, text
from packhouse.functions.numbers import MONEY, cents, dbl, money, parse_float, parse_int, pct, round_half_up, zero_if_null
from packhouse.operators import quality
from packhouse.operators.lookups import fold_children, with_parent
from packhouse.operators.slices import numbered


def _item_units(t, *cols: str) -> DataFrame:
    return with_parent(t.order_items(*cols), t.products("id", "unit"), "product_id", {"unit": "unit"})


def _order_client_types(t, *cols: str) -> DataFrame:
    orders = t.orders("id", "client_id", *cols)
    return with_parent(orders, t.clients("id", "type"), "client_id", {"client_type": "type"})


def _packs_of_kg_goods():
    """Packs of a kg line, as recovered when an order is loaded back into the form."""
    applies = (F.col("unit") == rules.KG) & (F.col("total_revenue") > 0)
    return rules.recovered_packs(applies, F.col("selling_price_used"), F.col("total_revenue"))


def order_margin_zone(t, p: Params) -> DataFrame:
    return t.orders("id", "margin_percentage").select(
        F.col("id").alias("order_id"), "margin_percentage", rules.margin_zone(F.col("margin_percentage"), p.thresholds).alias("zone")
    )


def line_revenue(t, p: Params) -> DataFrame:
    items = _item_units(t, "id", "order_id", "product_id", "quantity", "selling_price_used", "total_revenue")
    items = with_parent(items, _order_client_types(t), "order_id", {"client_type": "client_type"})
    packs = _packs_of_kg_goods()
    revenue = rules.line_revenue(
        rules.is_supermarket(F.col("client_type")), F.col("selling_price_used"), F.col("quantity"), packs
    )
    return items.select(F.col("id").alias("item_id"), packs.alias("packs"), cents(revenue).alias("revenue"))


def pack_recovery_kg(t, p: Params) -> DataFrame:
    items = _item_units(t, "id", "product_id", "quantity", "selling_price_used", "total_revenue")
    items = items.withColumn("packs", _packs_of_kg_goods())
    return items.select(
        F.col("id").alias("item_id"), "packs", rules.recovered_size(F.col("quantity"), F.col("packs")).alias("pack_size")
    )


def _packs_of_supermarket(items: DataFrame) -> DataFrame:
    """Packs as the printed documents show them: any unit, supermarkets only."""
    applies = rules.is_supermarket(F.col("client_type"))
    items = items.withColumn("packs", rules.recovered_packs(applies, F.col("selling_price_used"), F.col("total_revenue")))
    return items.withColumn("pack_size", rules.recovered_size(F.col("quantity"), F.col("packs")))


def pack_recovery_client(t, p: Params) -> DataFrame:
    items = t.order_items("id", "order_id", "quantity", "selling_price_used", "total_revenue")
    items = with_parent(items, _order_client_types(t), "order_id", {"client_type": "client_type"})
    return _packs_of_supermarket(items).select(F.col("id").alias("item_id"), "packs", "pack_size")


def parsed_lines(t) -> DataFrame:
    """Typed order lines with their quantity: pack size x packs for kg goods, pieces for the rest."""
    drafts = with_parent(
        t.draft_lines(), t.products("id", "name", "unit", "cost_per_unit"), "product_id",
        {"product_name": "name", "unit": "unit", "cost": "cost_per_unit"},
    )
    is_kg = F.col("unit") == rules.KG
    size = F.when(is_kg, zero_if_null(parse_float(F.col("package_size"))))
    packs = F.when(is_kg, dbl(zero_if_null(parse_int(F.col("num_packages")))))
    pieces = zero_if_null(parse_float(F.col("qty")))
    return drafts.withColumns({"size": size, "packs": packs}).withColumn(
        "line_qty", F.when(is_kg, F.col("size") * F.col("packs")).otherwise(pieces)
    )


def line_quantity(t, p: Params) -> DataFrame:
    lines = parsed_lines(t)
    return lines.select(
        F.col("id").alias("item_id"), "size", "packs", F.col("line_qty").alias("quantity"), (F.col("line_qty") > 0).alias("accepted")
    )


def order_economics(t, p: Params) -> DataFrame:
    """Revenue, cost, profit, margin and zone of each order, from its lines.

    Both readings of a line's revenue are summed per order before the order meets
    its client, who decides which one holds.
    """
    items = _item_units(
        t, "order_id", "product_id", "quantity", "selling_price_used", "cost_used", "total_revenue"
    ).withColumn("packs", _packs_of_kg_goods())
    price, quantity = F.col("selling_price_used"), F.col("quantity")
    folded = fold_children(
        items,
        "order_id",
        by_pack=F.sum(cents(rules.line_revenue(F.lit(True), price, quantity, F.col("packs")))),
        by_unit=F.sum(cents(dbl(price) * dbl(quantity))),
        farmer=F.sum(F.col("cost_used") * quantity),
    )
    orders = _order_client_types(t, "transport_cost", "packaging_cost")
    joined = with_parent(
        orders, folded, "id", {"by_pack": "by_pack", "by_unit": "by_unit", "farmer": "farmer"}, parent_key="order_id"
    )
    revenue = F.when(rules.is_supermarket(F.col("client_type")), F.col("by_pack")).otherwise(F.col("by_unit"))
    return economics(joined.withColumn("line_revenue", revenue).withColumn("line_cost", F.col("farmer")), p).select(
        F.col("id").alias("order_id"), "revenue", "farmer_cost", "logistics", "cost", "profit", "margin", "zone"
    )


def economics(orders: DataFrame, p: Params) -> DataFrame:
    """Header figures from ``line_revenue``, ``line_cost``, ``transport_cost`` and ``packaging_cost``."""
    margin = pct(F.col("profit"), F.col("revenue"))
    return (
        orders.withColumn("revenue", money(zero_if_null(F.col("line_revenue"))))
        .withColumn("farmer_cost", money(zero_if_null(F.col("line_cost"))))
        .withColumn("logistics", money(zero_if_null(F.col("transport_cost")) + zero_if_null(F.col("packaging_cost"))))
        .withColumn("cost", money(F.col("farmer_cost") + F.col("logistics")))
        .withColumn("profit", money(F.col("revenue") - F.col("cost")))
        .withColumn("margin", round_half_up(margin, 2))
        .withColumn("zone", rules.margin_zone(margin, p.thresholds))
    )


def order_cost_breakdown(t, p: Params) -> DataFrame:
    """Costs of each order from its stored lines, beside its stored revenue and profit."""
    base = fold_children(t.order_items("order_id", "total_cost"), "order_id", base=F.sum("total_cost"))
    orders = t.orders("id", "transport_cost", "packaging_cost", "total_revenue", "net_profit")
    rows = with_parent(orders, base, "id", {"base": "base"}, parent_key="order_id")
    rows = rows.withColumns(
        {
            "base_cost": zero_if_null(F.col("base")),
            "transport_cost": zero_if_null(F.col("transport_cost")),
            "packaging_cost": zero_if_null(F.col("packaging_cost")),
        }
    )
    return rows.select(
        F.col("id").alias("order_id"),
        "base_cost",
        "transport_cost",
        "packaging_cost",
        (F.col("base_cost") + F.col("transport_cost") + F.col("packaging_cost")).alias("total_cost"),
        "total_revenue",
        "net_profit",
    )


def orders_by_delivery_date(t, p: Params) -> DataFrame:
    orders = t.orders("delivery_date", "total_revenue", "net_profit", "transport_cost", "packaging_cost")
    day = F.coalesce(F.col("delivery_date").cast("string"), F.lit(text.UNKNOWN))
    sums = {n: zero_if_null(F.sum(n)) for n in ["total_revenue", "net_profit", "transport_cost", "packaging_cost"]}
    return (
        orders.groupBy(day.alias("delivery_day"))
        .agg(F.count(F.lit(1)).alias("order_count"), *[c.alias(n) for n, c in sums.items()])
        .orderBy(F.col("delivery_day").desc())
    )


def client_order_number(t, p: Params) -> DataFrame:
    """Running number of each order of a client, oldest first."""
    orders = t.orders("id", "client_id", "order_date").withColumn("client_id", F.coalesce("client_id", F.lit("")))
    return numbered(
        orders,
        keys=["client_id"],
        order=[F.col("order_date").asc_nulls_first(), F.col("id").asc()],
        name="order_number",
        slice_=F.year("order_date") * 12 + F.month("order_date"),
    ).select(F.col("id").alias("order_id"), "client_id", "order_number")


def invoice_due_dates(t, p: Params) -> DataFrame:
    orders = with_parent(t.orders("id", "client_id", "delivery_date"), t.clients("id", "credit_days"), "client_id", {"credit": "credit_days"})
    due = rules.due_date(F.col("delivery_date"), F.col("credit"), p.default_credit_days)
    return orders.select(F.col("id").alias("order_id"), "delivery_date", due.alias("due_date"))


# ---------------------------------------------------------------- documents


def _document_lines(t) -> DataFrame:
    items = t.order_items("id", "order_id", "product_id", "quantity", "selling_price_used", "cost_used", "total_revenue", "total_cost")
    items = with_parent(items, t.products("id", "name", "unit"), "product_id", {"product_name": "name", "unit": "unit"})
    orders = t.orders("id", "client_id", "order_date", "delivery_date", "total_revenue")
    heads = with_parent(orders, t.clients("id", "name", "type"), "client_id", {"client_name": "name", "client_type": "type"})
    head = {
        "client_name": "client_name",
        "client_type": "client_type",
        "order_date": "order_date",
        "delivery_date": "delivery_date",
        "order_total": "total_revenue",
    }
    return _packs_of_supermarket(with_parent(items, heads, "order_id", head))


def _packs_or_quantity():
    packs = F.nullif(F.col("packs"), F.lit(0.0))
    return F.coalesce(packs, dbl(F.col("quantity"))).alias("shown_quantity")


def invoice_lines(t, p: Params) -> DataFrame:
    """Invoice table: packs and pack price for a supermarket, quantity and unit for the rest."""
    lines = _document_lines(t)
    is_super = rules.is_supermarket(F.col("client_type"))
    return lines.select(
        "order_id",
        F.col("id").alias("item_id"),
        F.coalesce("client_name", F.lit("")).alias("client_name"),
        "order_date",
        "delivery_date",
        F.when(is_super, "packs").otherwise("quantity").alias("layout"),
        F.coalesce("product_name", F.lit("")).alias("product"),
        _packs_or_quantity(),
        F.when(~is_super, F.coalesce(F.col("unit"), F.lit(""))).alias("shown_unit"),
        round_half_up(F.col("selling_price_used"), 2).alias("price"),
        F.col("total_revenue").alias("total"),
        zero_if_null(F.col("order_total")).alias("order_total"),
    )


def delivery_note_lines(t, p: Params) -> DataFrame:
    """Delivery note table: pack size and packs, farmer cost per unit and in total, total of the note."""
    totals = fold_children(t.order_items("order_id", "total_cost"), "order_id", note=F.sum("total_cost"))
    lines = with_parent(_document_lines(t), totals, "order_id", {"note": "note"}, parent_key="order_id")
    is_super = rules.is_supermarket(F.col("client_type"))
    sized = F.when(rules.truthy(F.col("pack_size")), F.concat(text.plain_number(F.col("pack_size")), F.lit("kg")))
    unit = F.coalesce(F.col("unit"), F.lit(""))
    return lines.select(
        "order_id",
        F.col("id").alias("item_id"),
        F.coalesce("client_name", F.lit("")).alias("client_name"),
        "delivery_date",
        F.coalesce("product_name", F.lit("")).alias("product"),
        F.when(is_super, F.coalesce(sized, unit)).otherwise(unit).alias("size_or_unit"),
        _packs_or_quantity(),
        zero_if_null(F.col("cost_used")).alias("base_cost"),
        zero_if_null(F.col("total_cost")).alias("total_base_cost"),
        zero_if_null(F.col("note")).alias("note_total"),
    )


def contact_links(t, p: Params) -> DataFrame:
    orders = with_parent(
        t.orders("id", "client_id", "delivery_date"), t.clients("id", "name", "phone"), "client_id", {"name": "name", "phone": "phone"}
    )
    message = F.concat(
        F.lit("Dear "),
        F.coalesce(F.nullif(F.col("name"), F.lit("")), F.lit("Client")),
        F.lit(", please find attached your invoice for "),
        F.col("delivery_date").cast("string"),
        F.lit("."),
    )
    return orders.select(F.col("id").alias("order_id"), text.contact_link(F.col("phone"), message).alias("link"))


def order_labels(t, p: Params) -> DataFrame:
    """Labels of every line: its order, its product with the packs, its client."""
    items = t.order_items("id", "order_id", "product_id", "quantity", "selling_price_used", "total_revenue")
    items = with_parent(items, t.products("id", "name", "unit"), "product_id", {"product_name": "name", "unit": "unit"})
    heads = with_parent(
        t.orders("id", "client_id", "delivery_date", "total_revenue"), t.clients("id", "name"), "client_id", {"client_name": "name"}
    )
    items = with_parent(
        items, heads, "order_id", {"client_name": "client_name", "delivery_date": "delivery_date", "order_revenue": "total_revenue"}
    )
    packs = _packs_of_kg_goods()
    name = F.coalesce(F.nullif(F.col("product_name"), F.lit("")), F.lit(text.UNKNOWN))
    client = F.nullif(F.col("client_name"), F.lit(""))
    return items.select(
        F.col("id").alias("item_id"),
        text.order_label(F.col("client_name"), F.col("delivery_date"), F.col("order_id")).alias("order_label"),
        text.pack_label(name, rules.recovered_size(F.col("quantity"), packs), packs).alias("line_label"),
        F.coalesce(client, F.lit(text.UNKNOWN)).alias("client_or_unknown"),
        F.coalesce(client, F.lit(text.DASH)).alias("client_or_dash"),
    )


# -------------------------------------------------------------------- drafts


def lines_as_drafts(t, order_ids: DataFrame | None = None, typed_only: bool = False) -> DataFrame:
    """Lines of earlier orders as form lines; of the orders asked for, or of all.

    ``typed_only`` gives what the form's fields hold, without what is looked up of the product.
    """
    columns = ["id", "order_id", "product_id", "quantity", "selling_price_used"]
    items = t.order_items(*columns, *([] if typed_only else ["cost_used", "total_revenue"]))
    if order_ids is not None:
        items = items.join(order_ids.select(F.col("id").alias("order_id")), "order_id", "left_semi")
    if typed_only:
        return items.withColumnsRenamed({"id": "item_id", "selling_price_used": "selling_price"})
    product = {"product_name": "name", "unit": "unit", "product_cost": "cost_per_unit"}
    items = with_parent(items, t.products("id", *product.values()), "product_id", product)
    items = items.withColumn("packs", _packs_of_kg_goods())
    size = rules.recovered_size(F.col("quantity"), F.col("packs"))
    name = F.coalesce(F.nullif(F.col("product_name"), F.lit("")), F.lit(text.UNKNOWN))
    return items.select(
        F.col("id").alias("item_id"),
        "order_id",
        "product_id",
        text.pack_label(name, size, F.col("packs")).alias("product_label"),
        F.coalesce(F.nullif(F.col("unit"), F.lit("")), F.lit("pc")).alias("unit"),
        "quantity",
        F.col("selling_price_used").alias("selling_price"),
        F.coalesce(F.col("cost_used"), F.col("product_cost"), F.lit(0).cast(MONEY)).alias("cost"),
        size.alias("package_size"),
        F.col("packs").alias("num_packages"),
    )


def order_drafts(t, p: Params, order_ids: DataFrame | None = None) -> DataFrame:
    """Earlier orders as drafts of new ones: form lines with their header."""
    heads = t.orders("id", "client_id", "order_date", "delivery_date", "transport_cost", "packaging_cost")
    head = {c: c for c in ["client_id", "order_date", "delivery_date", "transport_cost", "packaging_cost"]}
    drafts = with_parent(lines_as_drafts(t, order_ids), heads, "order_id", head)
    today = F.lit(p.as_of)
    return drafts.withColumns(
        {
            "order_date": F.coalesce("order_date", today),
            "delivery_date": F.coalesce("delivery_date", today),
            "transport_cost": zero_if_null(F.col("transport_cost")),
            "packaging_cost": zero_if_null(F.col("packaging_cost")),
        }
    )


def reprice_lines_for_client(t, p: Params) -> DataFrame:
    """Draft lines at the prices of the client they moved to; a line keeps its price where there is none."""
    lines = t.reassigned_lines()
    prices = t.client_pricing("client_id", "product_id", "selling_price").withColumnRenamed("client_id", "new_client_id")
    priced = lines.join(prices, ["new_client_id", "product_id"], "left")
    return priced.select(
        F.col("id").alias("item_id"),
        "new_client_id",
        "product_id",
        F.coalesce(dbl(F.col("selling_price")), F.col("selling_price_used")).alias("price"),
        F.col("selling_price").isNotNull().alias("repriced"),
    )


# ------------------------------------------------------------------- quality


def checked_orders(t) -> DataFrame:
    lines = quality.with_failures(t.order_items("order_id", "quantity", "selling_price_used"), quality.line_rules())
    folded = fold_children(
        lines, "order_id", line_count=F.count(F.lit(1)), bad_lines=F.count_if(F.size("failures") > 0)
    )
    orders = t.orders("id", "client_id", "order_date", "delivery_date", "transport_cost")
    counted = {"line_count": "line_count", "bad_lines": "bad_lines"}
    return quality.with_failures(with_parent(orders, folded, "id", counted, parent_key="order_id"), quality.order_rules())


def dq_orders(t, p: Params) -> DataFrame:
    return checked_orders(t).select(
        F.col("id").alias("order_id"), (F.size("failures") == 0).alias("is_valid"), F.concat_ws(",", "failures").alias("failures")
    )
