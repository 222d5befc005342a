"""Connected components of a table of links, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packhouse.llm.work import Work


def components(links: DataFrame, work: Work) -> DataFrame:
    """(id, root): for each id in a link (a, b), the smallest id it reaches.

    Each round sends every id to the first of itself and its neighbours and merges what meets.  First is the
    smallest at first, so that stars around their smallest id are done in one round; then the order is random, which
    about halves the ids a round, on paths too.  Sums by id are reduced before they are shuffled; the links of
    a hot id meet a table that is written, so that adaptive execution may split them.
    """
    edges = work.cut(links.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a <> b").distinct(), "links", few=True)
    steps: list[DataFrame] = []
    while not edges.isEmpty():
        # Comparing (rank, id) settles ties of ranks.
        rank = F.struct((F.xxhash64("b", F.lit(len(steps))) if steps else F.col("b")).alias("rank"), F.col("b").alias("id"))
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        own = F.struct((F.xxhash64("a", F.lit(len(steps))) if steps else F.col("a")).alias("rank"), F.col("a").alias("id"))
        first = both.groupBy("a").agg(F.min(rank).alias("first"))
        to = work.cut(first.select(F.col("a").alias("id"), F.least("first", own)["id"].alias("to")), "to", few=True)
        steps.append(to)
        half = edges.join(to.withColumnRenamed("id", "a"), "a").select(F.col("to").alias("x"), "b")
        moved = half.join(to.withColumnRenamed("id", "b"), "b").select(F.least("x", "to").alias("a"), F.greatest("x", "to").alias("b"))
        edges = work.cut(moved.where("a <> b").distinct(), "links", few=True)
    if not steps:
        return edges.select(F.col("a").alias("id"), F.col("b").alias("root"))
    found = steps[-1]
    for to in reversed(steps[:-1]):
        later = found.select(F.col("id").alias("to"), F.col("to").alias("root"))
        found = work.cut(to.join(later, "to", "left").select("id", F.coalesce("root", "to").alias("to")), "roots", few=True)
    least = work.cut(found.groupBy("to").agg(F.min("id").alias("root")), "least", few=True)
    return found.join(least, "to").select("id", "root")
