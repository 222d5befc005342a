"""Lookups to a parent row, and children folded before they meet their parent.

A lookup is always a left join on a key that is unique in the parent, so it
neither drops nor repeats rows.  No broadcast is forced: Catalyst broadcasts a
parent it measures below ``spark.sql.autoBroadcastJoinThreshold``, and otherwise
shuffles, where adaptive execution splits a hot key over many tasks.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_parent(rows: DataFrame, parent: DataFrame, key: str, fields: dict[str, str], parent_key: str = "id") -> DataFrame:
    """Add ``fields`` (new name -> parent column) by ``rows.key = parent.parent_key``."""
    side = parent.select(F.col(parent_key).alias("_parent"), *[F.col(src).alias(name) for name, src in fields.items()])
    return rows.join(side, F.col(key) == F.col("_parent"), "left").drop("_parent")


def in_two(t, table: str, *cols: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """Rows of a table with the keys of their parents, and what gives them the other ``cols``, after lookups.

    A source that itself looks up some of the columns may leave them to the second step, which keeps what was added in between:
    rows then go to their parents narrow, and each key is shuffled by once.  Other sources give all columns at once.
    """
    split = getattr(type(t), f"{table}_in_two", None)
    return split(t, *cols) if split else (getattr(t, table)(*cols), lambda rows: rows)


def fold_children(children: DataFrame, key: str, **sums: Column) -> DataFrame:
    """One row per parent key, combined before the shuffle."""
    return children.groupBy(key).agg(*[expr.alias(name) for name, expr in sums.items()])
