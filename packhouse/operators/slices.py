"""Order-dependent work on groups of any size.

A plain window sends a whole group to one task.  Here each group is cut into
slices that follow the group's own order; rows only meet inside their slice, and
one small row per slice carries the rest (counts, first and last values) from
slice to slice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from packhouse.session import work_dir


# What one range is to hold, in bytes of the files that its rows come from.
RANGE_BYTES = 128 * 1024 * 1024
_MOST_RANGES = 50_000


def ranges_for(rows: DataFrame, least: int | None = None) -> int:
    """How many ranges rows ask for: by the size of the files they come from, and at least the session's shuffle partitions
    (or ``least``)."""
    leaves = rows._jdf.queryExecution().optimizedPlan().collectLeaves()
    size = sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    return max(least or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(_MOST_RANGES, -(-size // RANGE_BYTES)))


def dealt(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Rows dealt out by ranges of key and order, with the number of their range, ``_part``.

    A group of any size spreads over as many tasks as its rows ask for, whatever its values look like, and ``_part`` rises
    with the order.  The ranges are drawn from a sample, so the dealt rows are written once: all that reads them sees the
    same ranges.
    """
    spark = rows.sparkSession
    folder = work_dir(spark, "dealt")
    parts = rows.repartitionByRange(ranges_for(rows), *[F.col(k) for k in keys], *order).withColumn("_part", F.spark_partition_id())
    parts.write.parquet(folder)
    return spark.read.schema(parts.schema).parquet(folder)


# How many rows the groups of one bucket may have together before they are cut into slices, and how many buckets there are.
CROWDED = 1 << 20
_BUCKETS = 1 << 16
# More crowded buckets than this aren't named one by one.
_MOST_NAMED = 1000


def crowded(bound: DataFrame) -> Column | None:
    """Whether a row may be of a large group: one that shares its bucket, by the hash of the columns of ``bound``, with many rows;
    None where no group is.

    ``bound`` holds the keys of all rows, or some of the keys only, which are cheaper to come by: no group has more rows than its
    bucket.  Counts are folded in the scan, a row per bucket.
    """
    bucket = F.pmod(F.xxhash64(*bound.columns), F.lit(_BUCKETS))
    counts = bound.groupBy(bucket.alias("bucket")).count().filter(F.col("count") > CROWDED).select("bucket")
    named = [r["bucket"] for r in counts.limit(_MOST_NAMED + 1).collect()]
    if len(named) > _MOST_NAMED:
        return F.lit(True)
    return bucket.isin(named) if named else None


def numbered(rows: DataFrame, keys: list[str], order: list[Column], name: str, slice_: Column | None = None) -> DataFrame:
    """Add the 1-based position of each row in its group, by ``order``.

    Rows are numbered inside slices of their group, and one row per group and slice carries the counts before it.
    ``slice_`` is a value that rises with the order; without one, the rows are dealt out by ranges, and written for that.
    """
    rows = dealt(rows, keys, order) if slice_ is None else rows.withColumn("_part", slice_)
    inside = Window.partitionBy(*keys, "_part").orderBy(*order)
    # One row per group and slice: its size, then the sizes of the slices before it.
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy(*keys, "_part").agg(F.count(F.lit(1)).alias("_size"))
    by = [*keys, "_part"]
    before = sizes.select(*[F.col(k).alias(f"_of{i}") for i, k in enumerate(by)], F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_before"))
    # Null keys are a group as well.
    match = [F.col(k).eqNullSafe(F.col(f"_of{i}")) for i, k in enumerate(by)]
    placed = rows.withColumn("_place", F.row_number().over(inside)).join(before, match, "left")
    return placed.select(*[c for c in rows.columns if c != "_part"], (F.col("_before") + F.col("_place")).alias(name))


def numbered_whole(rows: DataFrame, keys: list[str], order: list[Column], name: str) -> DataFrame:
    """``numbered`` for groups that aren't large, in one shuffle."""
    return rows.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("long"))


def running_before(rows: DataFrame, keys: list[str], slice_: str, order: list[str], sums: dict[str, Column]) -> DataFrame:
    """Add, per name, the sum of a value over the rows of the group before this one, by ``slice_`` and ``order``.

    ``slice_`` rises with the order; rows are summed inside their slice, and one row per group and slice carries the sums of
    the slices before it.
    """
    valued = rows.withColumns({f"_v_{n}": v for n, v in sums.items()})
    inside = Window.partitionBy(*keys, slice_).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy(*keys).orderBy(slice_).rowsBetween(Window.unboundedPreceding, -1)
    slices = rows.groupBy(*keys, slice_).agg(*[F.sum(v).alias(n) for n, v in sums.items()])
    by = [*keys, slice_]
    before = slices.select(*[F.col(k).alias(f"_of{i}") for i, k in enumerate(by)], *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(f"_b_{n}") for n in sums])
    match = [F.col(k).eqNullSafe(F.col(f"_of{i}")) for i, k in enumerate(by)]
    here = {f"_i_{n}": F.coalesce(F.sum(f"_v_{n}").over(inside), F.lit(0)) for n in sums}
    joined = valued.withColumns(here).join(before, match, "left")
    return joined.select(*rows.columns, *[(F.col(f"_i_{n}") + F.col(f"_b_{n}")).alias(n) for n in sums])


def since_last(parts: DataFrame, key: str, order: list[str], marks: dict[str, Column], value: Column) -> DataFrame:
    """Per key and mark, the sum of ``value`` over the rows after the key's last marked one (all rows, where none is).

    A list of settings and additions is what its last setting and the sum after it are; two lists that follow one another are
    what the later has, if it sets, and else the sum of both.  That is associative, so each slice (``_part``, see ``dealt``)
    is folded for itself and then the slices of a key, one row each.
    """
    down = Window.partitionBy(key, "_part").orderBy(*[F.col(c).desc() for c in order]).rowsBetween(Window.unboundedPreceding, -1)
    names = list(marks)
    set_ = {f"_set_{n}": F.coalesce(m, F.lit(False)) for n, m in marks.items()}
    rows = parts.select(key, "_part", *order, value.alias("_value"), *[c.alias(n) for n, c in set_.items()])
    rows = rows.withColumns({f"_later_{n}": F.coalesce(F.max(f"_set_{n}").over(down), F.lit(False)) for n in names})
    slices = rows.groupBy(key, "_part").agg(
        *[F.max(f"_set_{n}").alias(f"_set_{n}") for n in names],
        # A marked row isn't after itself.
        *[F.sum(F.when(~F.col(f"_later_{n}") & ~F.col(f"_set_{n}"), F.col("_value"))).alias(f"_sum_{n}") for n in names],
    )
    after = Window.partitionBy(key).orderBy(F.col("_part").desc()).rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.withColumns({f"_later_{n}": F.coalesce(F.max(f"_set_{n}").over(after), F.lit(False)) for n in names})
    return slices.groupBy(key).agg(*[F.sum(F.when(~F.col(f"_later_{n}"), F.col(f"_sum_{n}"))).alias(n) for n in names])


def with_neighbour(
    rows: DataFrame, key: str, slice_: str, order: list[str], value: str, name: str, following: bool = False
) -> DataFrame:
    """Add the value of the row before (or after), within ``key``, by ``order``.

    ``slice_`` is a column that rises with ``order``.  The outermost row of a slice
    takes its value from the nearest slice that has any rows.
    """
    inside = Window.partitionBy(key, slice_).orderBy(*order)
    across = Window.partitionBy(key).orderBy(slice_)
    edge, step = (F.min_by, F.lead) if following else (F.max_by, F.lag)
    # A struct, so that a null value still counts as a row.
    edges = rows.groupBy(key, slice_).agg(edge(F.struct(F.col(value).alias("v")), F.struct(*order)).alias("_edge"))
    carried = edges.select(key, slice_, step("_edge").over(across).alias("_carried"))
    return (
        rows.withColumn("_near", step(F.struct(F.col(value).alias("v"))).over(inside))
        .join(carried, [key, slice_], "left")
        .withColumn(name, F.coalesce("_near", "_carried").getField("v"))
        .drop("_near", "_carried")
    )
