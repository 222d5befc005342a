"""Each row with the text of the row that follows it in descending order of id, the first following the last."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_LOWEST = -(1 << 63)


def in_order(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(bucket, head, key, text) dealt out by ranges of the key and sorted within, highest first.

    A null key comes last, rows of one key are in the order of a hash of their text, and a null text is empty.  At the end of a
    bucket stands the first row of the next one (``head``), so that each row finds its follower in its own task.
    Cut points are quantiles of the keys alone; of the texts, only one a bucket is sent twice.
    """
    spark = docs.sparkSession
    buckets = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(
        F.coalesce(F.col(key).cast("long"), F.lit(_LOWEST)).alias("place"),
        F.col(key).alias("key"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    ids = rows.select("place")
    cuts = ids.agg(F.percentile_approx("place", [(i + 1) / buckets for i in range(buckets - 1)], 20 * buckets)).first()[0]
    edges = np.unique(np.array(cuts or [], np.int64))

    @F.pandas_udf("int")
    def bucket(place: pd.Series) -> pd.Series:
        return pd.Series(len(edges) - np.searchsorted(edges, place.to_numpy(), side="left"), dtype="int32")

    placed = rows.withColumn("bucket", bucket("place"))
    # One row a bucket: at most as many as there are cut points.
    firsts = sorted(ids.withColumn("bucket", bucket("place")).groupBy("bucket").agg(F.max("place")).collect())
    follow = [(firsts[i][0], firsts[(i + 1) % len(firsts)][1]) for i in range(len(firsts))]
    heads = spark.createDataFrame(follow or [(0, 0)], "bucket int, place long")
    head_rows = rows.where(F.col("place").isin([p for _, p in follow] or [0])).join(F.broadcast(heads), "place")
    columns = ["bucket", "head", "place", "key", "text"]
    both = placed.withColumn("head", F.lit(False)).select(*columns).unionByName(head_rows.withColumn("head", F.lit(True)).select(*columns))
    return (
        both.withColumn("tie", F.xxhash64("text"))
        .repartition(buckets // 2, "bucket")
        .sortWithinPartitions("bucket", "head", F.desc("place"), "tie")
        .select("bucket", "head", "key", "text")
    )


def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str], list[str]]]:
    """Of sorted rows, for each batch: keys, their texts, and the texts that follow."""
    last = None
    for b in batches:
        keys, texts, nexts = [], [], []
        for at, head, key, text in zip(*(b.column(i).to_pylist() for i in range(4))):
            if last is not None and last[0] == at:
                keys.append(last[1])
                texts.append(last[2])
                nexts.append(text)
            last = None if head else (at, key, text)
        yield keys, texts, nexts
