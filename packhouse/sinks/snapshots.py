"""Versions of the stored tables, published together.

A job that changes several tables writes each to a folder of its own and then, last, one manifest that names the folder of every
table of the new version.  Readers go by manifests, so a version counts once its manifest is there: a job that stops
between tables leaves folders that nobody reads, and the version before stays the newest.  Tables that a job doesn't change
keep their folders.  Two jobs that publish at the same time can't both take a number: the second fails.

Layout under the root: ``_versions/000000007/`` (the manifest, one line of JSON), ``_tables/orders/000000007-…``.  Tables from
before the first version lie under the root itself, by name.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from packhouse.sources.schemas import TABLES, checked


class IncompleteVersion(Exception):
    """A version that was asked for has no manifest."""


class PublishedMeanwhile(Exception):
    """Another job has published since this one read its tables."""


@dataclass(frozen=True)
class Manifest:
    version: int
    tables: dict[str, str]  # name -> folder, below the root


def _fs(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


class Snapshots:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _manifest(self, version: int) -> str:
        return f"{self.root}/_versions/{version:09d}"

    def versions(self) -> list[int]:
        """Published versions, oldest first."""
        path, fs = _fs(self.spark, f"{self.root}/_versions")
        if not fs.exists(path):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(path)]
        return sorted(int(n) for n in names if n.isdigit())

    def read(self, version: int | None = None) -> Manifest:
        """The manifest of a version, or of the newest; version 0 is what lies there before the first."""
        if version is None:
            version = max(self.versions(), default=0)
        if version == 0:
            return Manifest(0, {})
        path, fs = _fs(self.spark, self._manifest(version))
        if not fs.exists(path):
            raise IncompleteVersion(f"{self.root} has no version {version}")
        (row,) = self.spark.read.text(self._manifest(version)).collect()
        return Manifest(version, json.loads(row["value"])["tables"])

    def publish(self, tables: dict[str, DataFrame], base: Manifest) -> Manifest:
        """Writes the tables that changed, then the manifest of the version after ``base``.

        Declared tables have to have the declared columns.  Fails where ``base`` isn't the newest version any more.
        """
        version = base.version + 1
        found = dict(base.tables)
        for name, table in tables.items():
            found[name] = f"_tables/{name}/{version:09d}-{uuid.uuid4().hex}"
            (checked(table, name) if name in TABLES else table).write.parquet(f"{self.root}/{found[name]}")
        line = json.dumps({"version": version, "tables": found}, sort_keys=True)
        # Written aside and renamed, so that it is there whole or not at all.
        aside = f"{self.root}/_versions/.{uuid.uuid4().hex}"
        self.spark.createDataFrame([(line,)], "value string").coalesce(1).write.text(aside)
        target, fs = _fs(self.spark, self._manifest(version))
        if fs.exists(target) or not fs.rename(_fs(self.spark, aside)[0], target):
            fs.delete(_fs(self.spark, aside)[0], True)
            raise PublishedMeanwhile(f"{self.root}: version {version} was published by another job")
        return Manifest(version, found)
