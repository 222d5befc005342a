"""Tables written between steps, in the folder that the cluster shares."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


# Folders of local sessions that name none: the setting can't be changed once a session runs.
_local: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; a local session without one gets a temporary folder, the same throughout."""
    app = spark.sparkContext.applicationId
    folder = spark.conf.get("spark.checkpoint.dir", None) or _local.get(app)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that every executor can reach")
        folder = _local[app] = f"file://{tempfile.mkdtemp(prefix='packhouse-')}"
    return folder.rstrip("/")


class Work:
    """A fresh folder for the tables of one run: ``cut`` writes a frame and reads it back, which ends its lineage."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.folder = f"{shared_folder(spark)}/packhouse/{name}-{uuid.uuid4().hex}"
        self.n = 0
        self.written: list[tuple[str, str]] = []

    def cut(self, df: DataFrame, name: str, few: bool = False) -> DataFrame:
        """``few``: for tables of ids and links, whose many shuffle partitions are merged to two tasks a core, without a shuffle."""
        self.n += 1
        if few:
            df = df.coalesce(2 * self.spark.sparkContext.defaultParallelism)
        path = f"{self.folder}/{self.n:03d}-{name}"
        df.write.option("compression", "zstd").parquet(path)
        self.written.append((name, path))
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, keep: tuple[str, ...]) -> None:
        """Deletes the tables written so far but those of the names ``keep``: for tables that nothing reads any more."""
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for name, path in self.written:
            if name not in keep:
                place = jvm.org.apache.hadoop.fs.Path(path)
                place.getFileSystem(conf).delete(place, True)
        self.written = [x for x in self.written if x[0] in keep]


_shipped: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Sends this package to the executors' Python, once a session, as --py-files would."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        package = Path(__file__).resolve().parents[1]
        to = Path(tempfile.mkdtemp(prefix="packhouse-code-")) / "packhouse_code.zip"
        with zipfile.ZipFile(to, "w") as z:
            for p in sorted(package.rglob("*.py")):
                z.write(p, p.relative_to(package.parent))
        spark.sparkContext.addPyFile(str(to))
        _shipped.add(app)
    return spark
