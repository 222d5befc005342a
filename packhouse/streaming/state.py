"""Keyed state of a stream's batches, as written tables under the shared folder.

Each batch adds a version with the keys it touched; every ``FULL``-th version holds all keys, so that a batch reads a
bounded number of them.  A batch that is run again starts from the same versions and writes the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packhouse.session import remove


class KeyedState:
    """``ddl``: the columns, keys included."""

    FULL = 20

    def __init__(self, folder: str, keys: list[str], ddl: str):
        self.folder, self.keys, self.ddl = folder, keys, ddl

    def _version(self, n: int) -> str:
        return f"{self.folder}/{n:09d}"

    def _base(self, batch_id: int) -> int:
        return batch_id // self.FULL * self.FULL

    def _latest(self, rows: DataFrame) -> DataFrame:
        values = [c for c in rows.columns if c not in [*self.keys, "version"]]
        newest = rows.groupBy(*self.keys).agg(F.max_by(F.struct(*values), "version").alias("_row"))
        return newest.select(*self.keys, *[F.col(f"_row.{c}").alias(c) for c in values])

    def after(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """All keys once that batch was done; none before the first."""
        if batch_id < 0:
            return spark.createDataFrame([], self.ddl)
        versions = [self._version(n) for n in range(self._base(batch_id), batch_id + 1)]
        return self._latest(spark.read.schema(f"{self.ddl}, version long").parquet(*versions)).select(*spark.createDataFrame([], self.ddl).columns)

    def before(self, spark: SparkSession, batch_id: int) -> DataFrame:
        return self.after(spark, batch_id - 1)

    def write(self, touched: DataFrame, batch_id: int) -> None:
        """Adds the rows of the keys that a batch touched, one each."""
        rows = touched.withColumn("version", F.lit(batch_id).cast("long"))
        if batch_id % self.FULL == 0 and batch_id:
            old = self.before(touched.sparkSession, batch_id).withColumn("version", F.lit(batch_id - 1).cast("long"))
            rows = self._latest(old.unionByName(rows)).withColumn("version", F.lit(batch_id).cast("long"))
        rows.write.mode("overwrite").parquet(self._version(batch_id))

    def forget(self, spark: SparkSession, batch_id: int) -> None:
        """Removes versions that neither this batch nor the one before reads any more."""
        base = self._base(batch_id - 1)
        if batch_id - 1 == base:
            for n in range(max(0, base - self.FULL - 1), base - 1):
                remove(spark, self._version(n))
