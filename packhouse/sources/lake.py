"""Business tables stored as Parquet folders with the declared schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packhouse.config import Settings
from packhouse.sinks.snapshots import Snapshots
from packhouse.sources import documents, records
from packhouse.sources.schemas import read_table

# Folders of JSON documents, and of change requests.
DOCUMENTS = ("pricing_settings_doc", "product_margins", "weight_variants", "capital_ledger", "waste_links")
REQUESTS = (
    "product_changes",
    "client_changes",
    "price_changes",
    "margin_changes",
    "variant_changes",
    "deleted_orders",
    "price_offers",
    "offer_picks",
    "batch_forms",
    "batch_edits",
    "deleted_batches",
    "settings_changes",
    "order_log",
    "order_feed",
    "payment_feed",
    "batch_feed",
    "payment_actions",
    "ledger_additions",
    "ledger_deletes",
    "draft_lines",
    "reassigned_lines",
    "pricing_entries",
    "change_events",
)


class Lake:
    """The table interface the plans are written against.

    Every reader takes the columns wanted, so that a scan never reads more.  All readers of one instance see one
    published version (see ``sinks.snapshots``): the newest when it was made, or the one asked for; a version without a
    manifest is refused.
    """

    def __init__(self, spark: SparkSession, root: str, version: int | None = None):
        self.spark = spark
        self.root = root
        self.manifest = Snapshots(spark, root).read(version)

    def _table(self, name: str, cols: tuple[str, ...]) -> DataFrame:
        table = read_table(self.spark, self.root, name, self.manifest.tables.get(name))
        return table.select(*cols) if cols else table

    def clients(self, *cols: str) -> DataFrame:
        return self._table("clients", cols)

    def products(self, *cols: str) -> DataFrame:
        return self._table("products", cols)

    def orders(self, *cols: str) -> DataFrame:
        return self._table("orders", cols)

    def order_items(self, *cols: str) -> DataFrame:
        return self._table("order_items", cols)

    def payments(self, *cols: str) -> DataFrame:
        return self._table("payments", cols)

    def batches(self, *cols: str) -> DataFrame:
        return self._table("inventory_batches", cols)

    def price_history(self, *cols: str) -> DataFrame:
        return self._table("client_pricing_history", cols)

    def client_pricing(self, *cols: str) -> DataFrame:
        return self._table("client_pricing", cols)

    # ---------------------------------------------------------- documents

    def _documents(self, name: str) -> DataFrame:
        """One row per document: a file holds one, over any number of lines, or several, each starting on a line.

        Documents that a job has published are a table with one in each row.
        """
        if name in self.manifest.tables:
            return self.spark.read.schema("doc string").parquet(f"{self.root.rstrip('/')}/{self.manifest.tables[name]}")
        files = self.spark.read.text(f"{self.root}/{name}", wholetext=True)
        between = r"(?<=[}\]])\s*\n\s*(?=[{\[])"
        return files.select(F.explode(F.split("value", between)).alias("doc")).filter(F.trim("doc") != "")

    def settings_documents(self) -> DataFrame:
        return self._documents("pricing_settings_doc")

    def margin_documents(self) -> DataFrame:
        return self._documents("product_margins")

    def variant_documents(self) -> DataFrame:
        return self._documents("weight_variants")

    def ledger_documents(self) -> DataFrame:
        return self._documents("capital_ledger")

    def margins(self) -> DataFrame:
        return documents.margins(self.margin_documents())

    def variants(self) -> DataFrame:
        return documents.variants(self.variant_documents())

    def ledger(self) -> DataFrame:
        return self.ledger_entries()

    def _ledger_records(self) -> DataFrame:
        return records.records(self.spark, f"{self.root.rstrip('/')}/capital_ledger", documents.LEDGER_ENTRY)

    def ledger_entries(self) -> DataFrame:
        """Entries of all ledger documents, however large; a document is split over tasks by its records."""
        if "capital_ledger" in self.manifest.tables:
            return documents.ledger(self.ledger_documents())
        return documents.ledger_rows(records.readable(self._ledger_records()).select(F.col("value").alias("_e")))

    def ledger_document_counts(self) -> DataFrame:
        if "capital_ledger" in self.manifest.tables:
            return documents.ledger_counts(self.ledger_documents())
        found = records.documents(self._ledger_records())
        return found.agg(F.count(F.lit(1)).alias("documents"), F.count_if(~F.col("readable")).alias("unreadable"))

    def waste_links(self) -> DataFrame:
        return documents.waste_links(self._documents("waste_links"))

    def settings(self) -> Settings:
        """The saved settings, as one-value subqueries; without a document the defaults, with several the query fails."""
        saved = documents.resolved_settings(self.settings_documents())
        return Settings(*[F.coalesce(saved.select(c).scalar(), F.lit(d)) for c, d in (("overhead_pct", 15.0), ("labor_pct", 0.0))])

    # ----------------------------------------------------- change requests

    def __getattr__(self, name: str):
        """A change request of that name: a Parquet folder under ``changes``."""
        if name in REQUESTS:
            return lambda: self.spark.read.parquet(f"{self.root}/changes/{name}")
        raise AttributeError(name)

    def order_forms(self) -> tuple[DataFrame, DataFrame]:
        base = f"{self.root}/changes"
        return self.spark.read.parquet(f"{base}/order_form_headers"), self.spark.read.parquet(f"{base}/order_form_lines")

    def order_updates(self) -> tuple[DataFrame, DataFrame]:
        base = f"{self.root}/changes"
        return self.spark.read.parquet(f"{base}/order_update_headers"), self.spark.read.parquet(f"{base}/order_update_lines")
