"""Session set-up and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime settings the jobs are written for.  A setting the session already
# carries is left alone, so a cluster's own choice wins.
RUNTIME_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even where that costs one more exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Join by hash, without sorting, where the partitions turn out small enough to be held.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    # Keep the state of streams on disk, not on the heap.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Merge the sessions of a busy key before they are shuffled.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


_TUNED = "packhouse.tuned"
# Folders of local sessions that name none.
_local: dict[str, str] = {}


def tune(spark: SparkSession) -> SparkSession:
    """Once a session: what is set later, by anyone, stays."""
    if spark.conf.get(_TUNED, None):
        return spark
    spark.conf.set(_TUNED, "true")
    explicit = {k for k, _ in spark.sparkContext.getConf().getAll()}
    for key, value in RUNTIME_DEFAULTS.items():
        if key not in explicit and spark.conf.isModifiable(key):
            spark.conf.set(key, value)
    # Dates and times are UTC throughout.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def size_shuffles(spark: SparkSession, shuffled_bytes: int, partition_bytes: int = 128 * 1024 * 1024) -> SparkSession:
    """Start shuffles with enough partitions for the data; adaptive execution merges the small ones."""
    wanted = max(200, -(-shuffled_bytes // partition_bytes))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(wanted))
    spark.conf.set("spark.sql.shuffle.partitions", str(wanted))
    return spark


def local_session(app: str = "packhouse", cpus: str = "*", partitions: int = 8) -> SparkSession:
    """A session for tests and the bench on one machine."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        # Otherwise the call site of each column expression is looked up, at half the cost of building a plan.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder under the cluster's shared checkpoint folder.

    The folder named by ``spark.checkpoint.dir`` is used where it is set.  Only
    a local session may fall back on this machine's temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder every executor can reach")
        app = spark.sparkContext.applicationId
        shared = _local.setdefault(app, "") or tempfile.mkdtemp(prefix="packhouse-")
        _local[app] = shared
    return f"{shared.rstrip('/')}/packhouse/{purpose}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, folder: str) -> None:
    """Removes a folder that ``work_dir`` made, or one in it; other folders are refused."""
    if "/packhouse/" not in folder:
        raise ValueError(f"not a working folder: {folder}")
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
