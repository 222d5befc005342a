"""Key figures kept up to date under a change feed.

A feed row is a whole row of its table with ``op`` (``upsert`` or ``delete``), ``changed_at`` and ``seq``.  Of each batch only
the last change of a row counts, and one that is older than what is known of the row is ignored, so batches may come in
any order.  A change takes what the row added before out of the sums and puts in what it adds now: an edit that moves a row to
another group (another day, another client, from open to paid) changes both groups.  Sums are exact, so what is kept equals what a
report over the whole table finds.

Rows and sums are keyed state in written tables (``state``), touched where the batch touches them.  A batch that is
run again gives the same.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from packhouse.operators.changes import DELETE, UPSERT
from packhouse.operators.slices import ranges_for
from packhouse.session import remove, work_dir
from packhouse.streaming.state import KeyedState

SUM = "decimal(38,4)"


@dataclass(frozen=True)
class Figure:
    """What is kept of a table: ``sums`` of its rows by ``groups``, each an SQL expression over ``columns``.

    ``columns``: the row's columns but its id, as a schema; ``groups``: name -> (expression, type).
    Every group also counts its rows, as ``row_count``, and is dropped when none is left.
    """

    name: str
    columns: str
    groups: dict[str, tuple[str, str]]
    sums: dict[str, str]

    def contributions(self, rows: DataFrame, sign: int) -> DataFrame:
        groups = [F.expr(e).cast(t).alias(n) for n, (e, t) in self.groups.items()]
        sums = [(F.expr(f"coalesce({e}, 0)").cast(SUM) * sign).cast(SUM).alias(n) for n, e in self.sums.items()]
        return rows.select(*groups, *sums, F.lit(sign).cast("long").alias("row_count"))

    def folded(self, parts: DataFrame) -> DataFrame:
        sums = [F.sum(n).cast(SUM).alias(n) for n in self.sums]
        return parts.groupBy(*self.groups).agg(*sums, F.sum("row_count").alias("row_count"))

    def of(self, rows: DataFrame) -> DataFrame:
        """The sums over a whole table: the batch form."""
        return self.folded(self.contributions(rows, 1))


class KeptFigure:
    """Sink of the stream: applies each batch of the feed to the kept rows and sums under ``folder``."""

    ALL = "_all"  # the key of a figure without groups

    def __init__(self, folder: str, figure: Figure, rows_of: KeptFigure | None = None):
        """``rows_of``: a figure over the same columns, called before this one, whose known rows this one shares."""
        self.figure, self.folder, self.rows_of = figure, folder, rows_of
        self.order = "changed_at timestamp, seq string"
        self.rows = KeyedState(f"{folder}/rows", ["id"], f"id string, op string, {self.order}, {figure.columns}")
        groups = ", ".join(f"{n} {t}" for n, (_, t) in figure.groups.items())
        sums = ", ".join(f"{n} {SUM}" for n in figure.sums)
        self.keys = [self.ALL, *figure.groups]
        self.sums = KeyedState(f"{folder}/sums", self.keys, ", ".join(x for x in (f"{self.ALL} int", groups, sums, "row_count long") if x))
        self.done = -1

    def _touched(self, batch: DataFrame, batch_id: int) -> DataFrame:
        """(id, new, old) of the rows that the batch changes, written; the known rows follow."""
        spark = batch.sparkSession
        self.rows.forget(spark, batch_id)
        if batch_id > 1:
            remove(spark, f"{self.folder}/touched/{batch_id - 2:09d}")
        shape = spark.createDataFrame([], self.rows.ddl)
        values = [c for c in shape.columns if c != "id"]
        typed = batch.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in shape.schema])
        newest = typed.groupBy("id").agg(F.max_by(F.struct(*values), F.struct("changed_at", "seq")).alias("new"))
        known = self.rows.before(spark, batch_id).select("id", F.struct(*values).alias("old"))
        both = newest.join(known, "id", "left")
        later = F.col("old").isNull() | (F.struct("new.changed_at", "new.seq") > F.struct("old.changed_at", "old.seq"))
        path = f"{self.folder}/touched/{batch_id:09d}"
        both.filter(later).write.mode("overwrite").parquet(path)
        self.touched = spark.read.schema(both.schema).parquet(path)
        self.rows.write(self.touched.select("id", "new.*"), batch_id)
        return self.touched

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark, figure = batch.sparkSession, self.figure
        self.sums.forget(spark, batch_id)
        touched = self.rows_of.touched if self.rows_of else self._touched(batch, batch_id)
        now, was = (touched.filter(F.col(f"{side}.op") == UPSERT).select(f"{side}.*") for side in ("new", "old"))
        delta = figure.folded(figure.contributions(now, 1).unionByName(figure.contributions(was, -1))).withColumn(self.ALL, F.lit(0))
        before = self.sums.before(spark, batch_id)
        # Groups may be null, so they are matched by union and fold, not by a join.
        groups = delta.select(*self.keys).distinct()
        match = [F.col(f"b.{k}").eqNullSafe(F.col(f"g.{k}")) for k in self.keys]
        old = before.alias("b").join(groups.alias("g"), match, "left_semi")
        total = old.unionByName(delta.select(*before.columns)).groupBy(*self.keys)
        total = total.agg(*[F.sum(n).cast(SUM).alias(n) for n in figure.sums], F.sum("row_count").alias("row_count"))
        self.sums.write(total.select(*before.columns), batch_id)
        self.done = max(self.done, batch_id)

    def current(self, spark: SparkSession) -> DataFrame:
        """Groups and sums after the last batch, without groups that have no row left."""
        return self.sums.after(spark, self.done).filter("row_count > 0").drop(self.ALL)


def feed_files(feed: DataFrame, folder: str, files: int) -> None:
    """A change feed as files, by ranges of time."""
    feed.repartitionByRange(files, "changed_at").write.parquet(folder)


def run_kept(feed: DataFrame, figures: list[Figure], files: int | None = None, files_a_batch: int | None = None, after: Callable | None = None) -> list[DataFrame]:
    """Runs a feed through a stream until it is used up; each figure's groups and sums then.

    The feed is written once, under the shared folder, and read in batches; ``after(batch_id, kept)`` is called after
    each.  It has as many files as its bytes ask for, so that no task writes or reads more of a larger feed, and two
    batches, as each batch reads what is known of all rows.
    """
    spark = feed.sparkSession
    folder = work_dir(spark, "kept")
    feed_files(feed, f"{folder}/feed", files or ranges_for(feed, least=4))
    written = len(spark.read.schema(feed.schema).parquet(f"{folder}/feed").inputFiles())
    files_a_batch = files_a_batch or max(1, -(-written // 2))
    kept: list[KeptFigure] = []
    for f in figures:
        same = [k for k in kept if k.figure.columns == f.columns and not k.rows_of]
        kept.append(KeptFigure(f"{folder}/{f.name}", f, same[0] if same else None))

    def sink(batch: DataFrame, batch_id: int) -> None:
        for k in kept:
            k(batch, batch_id)
        if after:
            after(batch_id, kept)

    query = (
        spark.readStream.schema(feed.schema)
        .option("maxFilesPerTrigger", files_a_batch)
        .parquet(f"{folder}/feed")
        .writeStream.foreachBatch(sink)
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    remove(spark, f"{folder}/feed")
    return [k.current(spark) for k in kept]


# ------------------------------------------------------------ the figures

_MONEY = "decimal(18,2)"
ORDER_COLUMNS = (
    f"client_id string, order_date date, total_revenue {_MONEY}, net_profit {_MONEY}, transport_cost {_MONEY}, packaging_cost {_MONEY}, "
    "margin_percentage double, base_cost decimal(18,4)"
)
PAYMENT_COLUMNS = f"amount {_MONEY}, status string"
BATCH_COLUMNS = f"harvested_qty {_MONEY}, damaged_qty {_MONEY}, expired_qty {_MONEY}, waste_value {_MONEY}"

# By day, so that the week of any date is a sum over a few rows.
DAYS = Figure(
    "days",
    ORDER_COLUMNS,
    {"order_date": ("order_date", "date")},
    {
        "revenue": "total_revenue",
        "profit": "net_profit",
        "transport_cost": "transport_cost",
        "packaging_cost": "packaging_cost",
        "margin_sum": "CAST(margin_percentage AS DECIMAL(18,2))",
        "base_cost": "base_cost",
    },
)
CLIENT_REVENUE = Figure("client-revenue", ORDER_COLUMNS, {"client_id": ("client_id", "string")}, {"revenue": "total_revenue"})
RECEIVABLES = Figure("receivables", PAYMENT_COLUMNS, {"paid": ("coalesce(status = 'paid', false)", "boolean")}, {"amount": "amount"})
WASTE = Figure(
    "waste",
    BATCH_COLUMNS,
    {},
    {"harvested": "harvested_qty", "waste": "coalesce(damaged_qty, 0) + coalesce(expired_qty, 0)", "waste_value": "waste_value"},
)
