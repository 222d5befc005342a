"""Debounced change feed: of a burst of changes to one key, only the last is saved.

A change restarts the key's timer; the last value is saved once the timer runs out.  A value equal to the one before it,
of the same key, is no change: it neither restarts the timer nor is saved.  So the value that a key had last has to
be known before gaps are measured, also where the event that brought it came in an earlier batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packhouse.operators.slices import with_neighbour
from packhouse.session import remove, work_dir
from packhouse.streaming.state import KeyedState

HOUR, DAY = 3600 * 1_000_000, 86_400 * 1_000_000  # microseconds
# Files of the feed that one batch takes.
FILES_PER_BATCH = 1000
EVENT_SCHEMA = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
CHANGE = "key string, ts timestamp, seq long, value double"


def _slice(of: str, width: int):
    return F.expr(f"(unix_micros({of}) - pmod(unix_micros({of}), {width})) div {width}")


def changes_only(events: DataFrame) -> DataFrame:
    """Drop events that repeat the value of the key's event before; the first of a key is a change.

    Events meet inside hours; one row per key and hour carries the last value on.
    """
    # A struct, so that a null value is told from no event.
    said = events.withColumn("_said", F.struct("value")).withColumn("_hour", _slice("ts", HOUR))
    named = with_neighbour(said, "key", "_hour", ["ts", "seq"], "_said", "_before")
    return named.filter(~F.col("_before").eqNullSafe(F.col("_said"))).drop("_said", "_hour", "_before")


def burst_ends(changes: DataFrame, gap_seconds: float) -> DataFrame:
    """Changes that no other of their key follows within the gap, with the time of the next one, ``next_ts``.

    Time is cut into steps as long as the gap: within a step only the last change can be an end, so
    each key and step is first reduced to that change and the time of its first, map-side.  What is left of a
    key is compared day by day.
    """
    gap = int(gap_seconds * 1_000_000)
    rest = [c for c in changes.columns if c not in ("key", "ts", "seq")]
    steps = (
        changes.groupBy("key", _slice("ts", gap).alias("_step"))
        .agg(F.min("ts").alias("_first"), F.max_by(F.struct("ts", "seq", *rest), F.struct("ts", "seq")).alias("_last"))
        .select("key", "_step", "_first", "_last.*")
        .withColumn("_day", _slice("ts", DAY))
    )
    ahead = with_neighbour(steps, "key", "_day", ["_step"], "_first", "next_ts", following=True)
    ends = F.col("next_ts").isNull() | (F.unix_micros("next_ts") - F.unix_micros("ts") > gap)
    return ahead.filter(ends).select(*changes.columns, "next_ts")


def debounced(events: DataFrame, gap_seconds: float) -> DataFrame:
    """The saves of a finished feed of (key, ts, seq, value): changes followed by none of their key within the gap."""
    return burst_ends(changes_only(events.select("key", "ts", "seq", "value")), gap_seconds).drop("next_ts")


class Debouncer:
    """Sink of the stream: the saves of what has come so far.

    The watermark is the latest time seen less ``lateness``.  Events behind it are settled: they are compared with the last
    change of their key, and a change is saved once no event that may still come can follow it within the gap.
    Later events wait in a table of their own, as others may yet come between them; events that come behind the
    watermark of the batch before are dropped.  Of settled events only the last change of each key is kept.

    All of it is written under ``folder``, a version each batch, so a batch that is run again gives the same.
    """

    STATE = CHANGE + ", saved boolean"

    def __init__(self, folder: str, gap_seconds: float, lateness_seconds: float):
        self.folder = folder
        self.gap, self.lateness = int(gap_seconds * 1_000_000), int(lateness_seconds * 1_000_000)
        self.gap_seconds = gap_seconds
        self.saves = f"{folder}/saves"
        self.last = KeyedState(f"{folder}/last", ["key"], self.STATE)

    def _path(self, name: str, batch_id: int) -> str:
        return f"{self.folder}/{name}/{batch_id:09d}"

    def _cut(self, rows: DataFrame, name: str, batch_id: int) -> DataFrame:
        path = self._path(name, batch_id)
        rows.write.mode("overwrite").parquet(path)
        return rows.sparkSession.read.schema(rows.schema).parquet(path)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        self._forget(spark, batch_id)
        fresh = self._cut(batch.select("key", "ts", "seq", "value"), "fresh", batch_id)
        passed = None
        micros = F.unix_micros("ts")
        if batch_id:
            passed = spark.read.parquet(self._path("watermark", batch_id - 1)).first()["passed"]
            fresh = fresh.filter(F.lit(passed).isNull() | (micros >= passed))
        newest = fresh.agg(F.max(micros)).first()[0]
        known = [x for x in (passed, None if newest is None else newest - self.lateness) if x is not None]
        passed = max(known) if known else None
        self._cut(spark.createDataFrame([(passed,)], "passed long"), "watermark", batch_id)
        none = spark.createDataFrame([], CHANGE)
        waited = spark.read.schema(CHANGE).parquet(self._path("waiting", batch_id - 1)) if batch_id else none
        events = waited.unionByName(fresh)
        if passed is None:
            self._cut(events, "waiting", batch_id)
            settled = none
        else:
            self._cut(events.filter(micros >= passed), "waiting", batch_id)
            settled = events.filter(micros < passed)
        touched = settled.select("key").distinct()
        before = self.last.before(spark, batch_id)
        open_ = spark.read.schema(self.STATE).parquet(self._path("open", batch_id - 1)) if batch_id else before
        known = before.join(touched, "key", "left_semi").unionByName(open_.join(touched, "key", "left_anti"))
        rows = changes_only(settled.withColumn("saved", F.lit(False)).unionByName(known))
        ends = self._cut(burst_ends(rows, self.gap_seconds), "ends", batch_id)
        closed = F.col("next_ts").isNotNull() | (F.lit(passed) - F.unix_micros("ts") > self.gap)
        due = ends.filter(F.coalesce(closed, F.lit(False)) & ~F.col("saved"))
        due.select("key", "ts", "seq", "value").write.mode("overwrite").parquet(f"{self.saves}/run={batch_id}")
        last = ends.filter("next_ts is null").withColumn("saved", F.col("saved") | F.coalesce(closed, F.lit(False))).drop("next_ts")
        self.last.write(last, batch_id)
        self._cut(last.filter(~F.col("saved")), "open", batch_id)

    def _forget(self, spark: SparkSession, batch_id: int) -> None:
        """Removes what neither this batch, nor the one before if it is run again, reads."""
        if batch_id > 1:
            for name in ("fresh", "watermark", "waiting", "ends", "open"):
                remove(spark, self._path(name, batch_id - 2))
            self.last.forget(spark, batch_id)


def feed(spark: SparkSession, source_dir: str, pattern: str, closing: str) -> DataFrame:
    """The events under ``source_dir`` as a stream, and after them what is put under ``closing``.

    A batch takes a bounded number of files.
    """
    events = spark.readStream.schema(EVENT_SCHEMA).option("pathGlobFilter", pattern).option("maxFilesPerTrigger", FILES_PER_BATCH)
    return events.parquet(source_dir).unionByName(spark.readStream.schema(EVENT_SCHEMA).parquet(closing))


def run_to_end(spark: SparkSession, closing: str, start) -> None:
    """Runs a query over a finished feed, then once more with an event far ahead, which closes what was still open.

    ``start`` starts the query, with the same checkpoint both times.  The event's own window stays open.
    """
    spark.createDataFrame([], EVENT_SCHEMA).write.mode("overwrite").parquet(closing)
    start().awaitTermination()
    spark.sql("SELECT -1L event_id, timestamp_ntz'9000-01-01' ts, -1L user_id, 'end' event_type, 0D value, '' props").write.mode("append").parquet(closing)
    start().awaitTermination()


def run_debounce(spark: SparkSession, source_dir: str, gap_seconds: float, lateness_seconds: float = 3600, pattern: str = "events.parquet") -> DataFrame:
    """Run the feed under ``source_dir`` through the stream until it is used up; the saves."""
    folder = work_dir(spark, "debounce")
    sink = Debouncer(folder, gap_seconds, lateness_seconds)
    closing = f"{folder}/closing"

    def start():
        events = feed(spark, source_dir, pattern, closing)
        keyed = events.select(
            F.col("user_id").cast("string").alias("key"), F.col("ts").cast("timestamp").alias("ts"), F.col("event_id").alias("seq"), "value"
        )
        return (
            keyed.writeStream.outputMode("append")
            .foreachBatch(sink)
            .option("checkpointLocation", f"{folder}/checkpoint")
            .trigger(availableNow=True)
            .start()
        )

    run_to_end(spark, closing, start)
    return spark.read.parquet(sink.saves).select("key", "ts", "seq", "value")
