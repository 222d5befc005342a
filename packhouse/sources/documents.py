"""JSON documents as tables: settings, margins, pack variants, ledger, waste links.

Each takes a frame with one document per row in ``doc`` (and passes other named
columns through).  A document that cannot be read counts as absent, and is
reported by ``unreadable``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packhouse.config import Settings

# Shapes of the stored documents.
SETTINGS = "overhead_pct double, labor_pct double, _bad string"
MARGINS = "map<string,double>"
VARIANTS = "map<string,array<struct<weight:double,price:double>>>"
LEDGER_ENTRY = "id string, date string, type string, amount double, description string"
LEDGER = "array<struct<id:string,date:string,type:string,amount:double,description:string>>"
WASTE_LINKS = "map<string,struct<clientId:string,clientName:string,orderId:string,orderLabel:string>>"


def _settings(doc: Column) -> Column:
    return F.from_json(doc, SETTINGS, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})


def resolved_settings(docs: DataFrame, default: Settings = Settings()) -> DataFrame:
    """Overhead and labor of each document.

    An absent or unreadable document gives the defaults; a missing field of a
    readable one gives 0.
    """
    parsed = docs.withColumn("_s", _settings(F.col("doc")))
    usable = F.col("doc").isNotNull() & (F.col("doc") != "") & F.col("_s").isNotNull() & F.col("_s._bad").isNull()

    def pick(field: str, fallback: float) -> Column:
        return F.when(usable, F.coalesce(F.col(f"_s.{field}"), F.lit(0.0))).otherwise(F.lit(fallback)).alias(field)

    rest = [c for c in docs.columns if c != "doc"]
    return parsed.select(*rest, pick("overhead_pct", default.overhead_pct), pick("labor_pct", default.labor_pct))


def saved_settings(docs: DataFrame, changes: DataFrame, key: str = "owner") -> DataFrame:
    """(key, doc): the settings documents after changes (key, doc, changed_at, seq).

    A document is saved whole: of several changes of one key the last stays as it is, and fields that it leaves out are gone.
    A change without a document removes none.
    """
    given = changes.filter(F.col("doc").isNotNull())
    last = given.groupBy(key).agg(F.max_by("doc", F.struct("changed_at", "seq")).alias("_doc"))
    return docs.select(key, "doc").join(last, key, "full_outer").select(key, F.coalesce("_doc", "doc").alias("doc"))


# Tables written back as documents, one entry each: reading them gives the table again, and no document grows with it.


def settings_documents(settings: DataFrame) -> DataFrame:
    rest = [c for c in settings.columns if c not in ("overhead_pct", "labor_pct")]
    return settings.select(*rest, F.to_json(F.struct("overhead_pct", "labor_pct")).alias("doc"))


def margin_documents(table: DataFrame) -> DataFrame:
    return table.select(F.to_json(F.create_map("product_id", "profit_margin_pct"), {"ignoreNullFields": "false"}).alias("doc"))


def variant_documents(table: DataFrame) -> DataFrame:
    """A product's pack sizes are one list, in the order of their positions."""
    sizes = F.transform(F.array_sort(F.collect_list(F.struct("position", "weight", "price"))), lambda v: F.struct(v["weight"].alias("weight"), v["price"].alias("price")))
    lists = table.groupBy("product_id").agg(sizes.alias("sizes"))
    return lists.select(F.to_json(F.create_map("product_id", "sizes")).alias("doc"))


def ledger_documents(table: DataFrame) -> DataFrame:
    amount = F.col("amount").cast("double").alias("amount")
    return table.select(F.to_json(F.array(F.struct("id", F.col("date").cast("string").alias("date"), "type", amount, "description"))).alias("doc"))


def waste_link_documents(table: DataFrame) -> DataFrame:
    names = {"client_id": "clientId", "client_name": "clientName", "order_id": "orderId", "order_label": "orderLabel"}
    return table.select(F.to_json(F.create_map("link_key", F.struct(*[F.col(c).alias(n) for c, n in names.items()]))).alias("doc"))


def margins(docs: DataFrame) -> DataFrame:
    entries = docs.select(F.explode(F.from_json("doc", MARGINS)).alias("product_id", "profit_margin_pct"))
    return entries


def variants(docs: DataFrame) -> DataFrame:
    lists = docs.select(F.explode(F.from_json("doc", VARIANTS)).alias("product_id", "_variants"))
    return lists.select("product_id", F.posexplode("_variants").alias("position", "_v")).select(
        "product_id", "position", F.col("_v.weight").alias("weight"), F.col("_v.price").alias("price")
    )


def ledger(docs: DataFrame) -> DataFrame:
    return ledger_rows(docs.select(F.explode(F.from_json("doc", LEDGER)).alias("_e")))


def ledger_rows(entries: DataFrame) -> DataFrame:
    """Entries, as structs ``_e``, as the ledger's columns."""
    return entries.select(
        F.col("_e.id").alias("id"),
        F.col("_e.date").try_cast("date").alias("date"),
        F.col("_e.type").alias("type"),
        F.col("_e.amount").cast("decimal(18,2)").alias("amount"),
        F.col("_e.description").alias("description"),
    )


def ledger_counts(docs: DataFrame) -> DataFrame:
    """How many ledger documents there are, and how many cannot be read."""
    bad = unreadable(docs, LEDGER).agg(F.count(F.lit(1)))
    return docs.agg(F.count(F.lit(1)).alias("documents")).withColumn("unreadable", bad.scalar())


def unreadable(docs: DataFrame, shape: str) -> DataFrame:
    """Documents that are present but do not parse."""
    return docs.filter(F.col("doc").isNotNull() & F.from_json("doc", shape).isNull())


def waste_links(docs: DataFrame) -> DataFrame:
    entries = docs.select(F.explode(F.from_json("doc", WASTE_LINKS)).alias("link_key", "_l"))
    return entries.select(
        "link_key",
        F.col("_l.clientId").alias("client_id"),
        F.col("_l.clientName").alias("client_name"),
        F.col("_l.orderId").alias("order_id"),
        F.col("_l.orderLabel").alias("order_label"),
    )
