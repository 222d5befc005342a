"""Change tables applied to snapshots.

A change table holds the key, some columns of the snapshot, ``op`` (``upsert`` or
``delete``), ``changed_at`` and ``seq``; (``changed_at``, ``seq``) is a total order.
Every function is pure: snapshot and changes in, new snapshot out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UPSERT, DELETE = "upsert", "delete"


def latest_per_key(changes: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """The last change of each key; ``_gone`` tells that the key was deleted on the way.

    An aggregate, not a window: a key with very many changes is reduced map-side.
    """
    order = F.struct("changed_at", "seq")
    return changes.groupBy(*keys).agg(
        F.max_by(F.struct("op", *values), order).alias("_new"),
        F.max(F.col("op") == DELETE).alias("_gone"),
    )


def apply_changes(snapshot: DataFrame, changes: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Upsert and delete by key.

    A changed column takes the change's value, null included.  Columns the change
    table lacks stay as they were, unless the row was deleted in between.
    """
    latest = latest_per_key(changes, keys, values)
    merged = snapshot.join(latest, keys, "full_outer")
    changed = F.col("_new").isNotNull()
    columns = []
    for name in snapshot.columns:
        if name in keys:
            columns.append(F.col(name))
        elif name in values:
            columns.append(F.when(changed, F.col(f"_new.{name}")).otherwise(F.col(name)).alias(name))
        else:
            columns.append(F.when(changed & F.col("_gone"), F.lit(None)).otherwise(F.col(name)).alias(name))
    return merged.filter(~changed | (F.col("_new.op") == UPSERT)).select(*columns)


def without(rows: DataFrame, ids: DataFrame, key: str, id_column: str = "id") -> DataFrame:
    """Rows whose ``key`` is not among ``ids``."""
    gone = ids.select(F.col(id_column).alias("_gone")).distinct()
    return rows.join(gone, F.col(key) == F.col("_gone"), "left_anti")
