"""Data-quality rules: each rule names what is wrong with a row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from packhouse.functions.numbers import dbl
from packhouse.functions.rules import truthy
from packhouse.operators.changes import UPSERT


def blank(text: Column) -> Column:
    return F.coalesce(text, F.lit("")) == ""


def below_zero(c: Column) -> Column:
    return F.coalesce(dbl(c) < 0, F.lit(False))


def with_failures(rows: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Add ``failures``, the names of the rules a row breaks, in rule order."""
    broken = F.array(*[F.when(bad, F.lit(name)) for name, bad in rules.items()])
    return rows.withColumn("failures", F.array_compact(broken))


def valid(checked: DataFrame) -> DataFrame:
    return checked.filter(F.size("failures") == 0).drop("failures")


def rejected(checked: DataFrame) -> DataFrame:
    return checked.filter(F.size("failures") > 0)


def split(rows: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Accepted rows, and rejected ones with the names of all rules that they break."""
    checked = with_failures(rows, rules)
    return valid(checked), rejected(checked)


def split_changes(changes: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Like ``split`` for a change table: what a row has to show is asked of upserts, not of deletes."""
    asked = {name: (F.col("op") == UPSERT) & bad for name, bad in rules.items()}
    accepted, refused = split(changes, asked)
    # Said once more on its own, so that deletes needn't be read for their rejects.
    return accepted, refused.filter(F.col("op") == UPSERT)


def watched(checked: DataFrame, counts: Observation) -> DataFrame:
    """Counts rows, and rejects by rule, while the rows are written; read ``counts.get`` after that."""
    every = F.count(F.lit(1)).alias("rows")
    refused = F.count_if(F.size("failures") > 0).alias("rejected")
    return checked.observe(counts, every, refused)


def as_rejects(refused: DataFrame, write: str, row_id: Column) -> DataFrame:
    """(write, row_id, failures): rejects of any write in one form."""
    return refused.select(F.lit(write).alias("write"), row_id.alias("row_id"), F.concat_ws(",", "failures").alias("failures"))


def order_rules(lines: bool = True) -> dict[str, Column]:
    """For order headers with ``line_count`` and, where lines count, ``bad_lines``."""
    return {
        "client_missing": blank(F.col("client_id")),
        "no_items": F.coalesce(F.col("line_count"), F.lit(0)) == 0,
        "delivery_before_order": F.coalesce(F.col("delivery_date") < F.col("order_date"), F.lit(False)),
        "transport_negative": below_zero(F.col("transport_cost")),
    } | ({"bad_line": F.coalesce(F.col("bad_lines"), F.lit(0)) > 0} if lines else {})


def order_form_rules() -> dict[str, Column]:
    """For forms whose header carries ``line_count`` and the number of lines that break each line rule."""
    return order_rules(lines=False) | {n: F.coalesce(F.col(n), F.lit(0)) > 0 for n in line_rules()}


def line_rules() -> dict[str, Column]:
    return {
        "price_missing": ~truthy(F.col("selling_price_used")),
        "quantity_not_positive": F.coalesce(dbl(F.col("quantity")), F.lit(0.0)) <= 0,
    }


def batch_rules() -> dict[str, Column]:
    return {
        "product_missing": blank(F.col("product_id")),
        "harvested_missing": F.col("harvested_qty").isNull(),
        "harvested_negative": below_zero(F.col("harvested_qty")),
        "damaged_negative": below_zero(F.col("damaged_qty")),
        "expired_negative": below_zero(F.col("expired_qty")),
    }


def ledger_rules() -> dict[str, Column]:
    return {
        "amount_not_positive": F.coalesce(dbl(F.col("amount")), F.lit(0.0)) <= 0,
        "description_blank": blank(F.trim(F.col("description"))),
    }


def product_rules() -> dict[str, Column]:
    return {"name_missing": blank(F.col("name")), "cost_missing": F.col("cost_per_unit").isNull()}


def client_rules() -> dict[str, Column]:
    return {"name_missing": blank(F.col("name"))}


def price_rules() -> dict[str, Column]:
    return {
        "client_missing": blank(F.col("client_id")),
        "product_missing": blank(F.col("product_id")),
        "price_missing": F.col("selling_price").isNull(),
    }


def payment_rules() -> dict[str, Column]:
    """An amount must be present, not zero and not negative."""
    return {"amount_invalid": F.coalesce(dbl(F.col("amount")), F.lit(0.0)) <= 0}


def action_rules() -> dict[str, Column]:
    """For the actions of an order log."""
    set_amount, deduct = F.col("kind") == "set_amount", F.col("kind") == "deduct"
    return {
        "order_missing": blank(F.col("order_id")),
        "amount_invalid": set_amount & (F.coalesce(dbl(F.col("amount")), F.lit(0.0)) <= 0),
        "waste_not_positive": deduct & (F.coalesce(dbl(F.col("waste_value")), F.lit(0.0)) <= 0),
    }
