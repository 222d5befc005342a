"""Stored JSON documents, read as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packhouse.config import Params
from packhouse.sources import documents


def settings_resolved(t, p: Params) -> DataFrame:
    return documents.resolved_settings(t.settings_documents())


def product_margins_table(t, p: Params) -> DataFrame:
    return documents.margins(t.margin_documents())


def weight_variants_table(t, p: Params) -> DataFrame:
    return documents.variants(t.variant_documents())


def ledger_entries(t, p: Params) -> DataFrame:
    return t.ledger_entries()


def ledger_bad_documents(t, p: Params) -> DataFrame:
    """How many ledger documents there are, and how many cannot be read."""
    return t.ledger_document_counts()
