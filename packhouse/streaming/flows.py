"""Daily cash flows, as a batch and kept up to date by a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packhouse.functions.numbers import cents
from packhouse.session import work_dir
from packhouse.streaming.debounce import EVENT_SCHEMA, FILES_PER_BATCH, feed, run_to_end

# Which events count as which ledger entry.
ENTRY_TYPES = {"signup": "initial", "purchase": "deposit", "error": "withdrawal"}


def entries(events: DataFrame) -> DataFrame:
    kind = F.col("event_type")
    mapped = F.coalesce(*[F.when(kind == k, F.lit(v)) for k, v in ENTRY_TYPES.items()], kind)
    return events.select(F.col("ts").cast("timestamp").alias("ts"), mapped.alias("type"), cents(F.col("value")).alias("amount"))


def daily_flow(rows: DataFrame) -> DataFrame:
    """Entries and amount per day and type."""
    day = F.window("ts", "1 day")
    return (
        rows.groupBy(day.alias("day"), "type")
        .agg(F.count(F.lit(1)).alias("entries"), F.sum("amount").alias("amount"))
        .select(F.col("day.start").cast("date").alias("day"), "type", "entries", "amount")
    )


def running_totals(rows: DataFrame) -> DataFrame:
    """Totals per type over everything seen so far (update mode)."""
    return rows.groupBy("type").agg(F.count(F.lit(1)).alias("entries"), F.sum("amount").alias("amount"))


def _events(spark: SparkSession, source_dir: str, pattern: str) -> DataFrame:
    return (
        spark.readStream.schema(EVENT_SCHEMA)
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", FILES_PER_BATCH)
        .parquet(source_dir)
    )


def run_daily_flow(spark: SparkSession, source_dir: str, lateness: str = "1 hour", pattern: str = "events.parquet") -> DataFrame:
    """Run the feed through the stream until it is used up; all its days."""
    folder = work_dir(spark, "daily-flow")
    closing = f"{folder}/closing"

    def start():
        rows = entries(feed(spark, source_dir, pattern, closing)).withWatermark("ts", lateness)
        return (
            daily_flow(rows)
            .writeStream.outputMode("append")
            .format("parquet")
            .option("path", f"{folder}/days")
            .option("checkpointLocation", f"{folder}/checkpoint")
            .trigger(availableNow=True)
            .start()
        )

    run_to_end(spark, closing, start)
    return spark.read.parquet(f"{folder}/days")


def run_running_totals(spark: SparkSession, source_dir: str, pattern: str = "events.parquet") -> DataFrame:
    """Keep the totals per type as a written table, one version per batch; the newest version."""
    folder = work_dir(spark, "running-totals")

    def save(batch: DataFrame, batch_id: int) -> None:
        version = batch.withColumn("batch", F.lit(batch_id).cast("long"))
        version.write.mode("overwrite").parquet(f"{folder}/totals/run={batch_id}")

    query = (
        running_totals(entries(_events(spark, source_dir, pattern)))
        .writeStream.outputMode("update")
        .foreachBatch(save)
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    written = spark.read.parquet(f"{folder}/totals")
    newest = F.max_by(F.struct("entries", "amount"), "batch").alias("t")
    return written.groupBy("type").agg(newest).select("type", "t.entries", "t.amount")
