"""Streams run to the end of their input, against the batch form."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from packhouse.plans.registry import queries
from packhouse.streaming import debounce, flows

SF = "/root/testdata/sf0.001"
T0 = dt.datetime(2024, 1, 1, 23, 50)


def feed(spark, rows):
    data = [(k, T0 + dt.timedelta(seconds=s), n, float(v)) for n, (k, s, v) in enumerate(rows)]
    return spark.createDataFrame(data, "key string, ts timestamp, seq long, value double")


def saves(spark, rows, gap):
    return sorted((r.key, r.seq) for r in debounce.debounced(feed(spark, rows), gap).collect())


def test_debounce(spark):
    rows = [
        ("a", 0, 1), ("a", 60, 2),  # exactly one gap apart: one burst
        ("a", 121, 3),  # one second more: a burst of its own
        ("a", 500, 3),  # no change
        ("a", 900, 4), ("a", 900, 5),  # same instant: the later one by number
        ("b", 700, 3),
    ]
    assert saves(spark, rows, 60) == [("a", 1), ("a", 2), ("a", 5), ("b", 6)]


# A repeated value doesn't restart the timer; a burst that ends where it began is saved again; null is a value.
REPEATS = [("a", 0, 1), ("a", 50, 1), ("a", 100, 2), ("b", 0, 1), ("b", 500, 2), ("b", 520, 1), ("c", 0, 7), ("c", 59, 7), ("c", 118, 7), ("c", 177, 8)]
SAVED = [("a", 0), ("a", 2), ("b", 3), ("b", 5), ("c", 6), ("c", 9)]


def test_equal_neighbours_go_before_gaps_are_measured(spark):
    assert saves(spark, REPEATS, 60) == SAVED


def test_null_is_a_value(spark):
    rows = feed(spark, [("a", 0, 1), ("a", 500, 1), ("a", 900, 1), ("b", 0, 1)]).withColumn("value", F.when(F.col("seq").isin(1, 3), F.lit(None)).otherwise(F.col("value")))
    assert sorted((r.key, r.seq) for r in debounce.debounced(rows, 60).collect()) == [("a", 0), ("a", 1), ("a", 2), ("b", 3)]


def brute_saves(rows, gap):
    """(key, ts, seq, value) one by one, as a timer would see them."""
    out, last = [], {}
    for key, ts, seq, value in sorted(rows):
        before = last.get(key)
        if before is None or before[2] != value:
            if before is not None and (ts - before[0]).total_seconds() > gap:
                out.append((key, before[1]))
            last[key] = (ts, seq, value)
    return sorted(out + [(k, s) for k, (_, s, _) in last.items()])


def test_debounce_against_brute_force(spark):
    events = spark.read.parquet(f"{SF}/events.parquet")
    # Coarse values, so that many neighbours are equal.
    coarse = F.floor(F.col("value") / 100).cast("double")
    keyed = events.select(F.col("user_id").cast("string").alias("key"), F.col("ts").cast("timestamp").alias("ts"), F.col("event_id").alias("seq"), coarse.alias("value"))
    want = brute_saves([tuple(r) for r in keyed.collect()], 6 * 3600)
    assert len(want) < 0.9 * events.count()
    assert sorted((r.key, r.seq) for r in debounce.debounced(keyed, 6 * 3600).collect()) == want


def sunk(spark, folder, batches, gap=60, lateness=0):
    sink = debounce.Debouncer(folder, gap, lateness)
    for n, rows in enumerate([*batches, [("", dt.datetime(2900, 1, 1), -1, 0.0)]]):
        frame = spark.createDataFrame(rows, debounce.CHANGE)
        for _ in range(2 if n == 1 else 1):  # a batch run again
            sink(frame, n)
    return sorted((r.key, r.seq) for r in spark.read.parquet(sink.saves).collect())


@pytest.mark.parametrize("sizes", [[10], [1, 3, 2, 4]])
def test_saves_span_batches(spark, tmp_path, sizes):
    rows = sorted(((k, T0 + dt.timedelta(seconds=s), n, float(v)) for n, (k, s, v) in enumerate(REPEATS)), key=lambda r: r[1])
    batches = [rows[sum(sizes[:i]) : sum(sizes[: i + 1])] for i in range(len(sizes))]
    assert sunk(spark, str(tmp_path / "packhouse" / "d"), batches) == SAVED


def test_events_out_of_order_within_the_lateness(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(debounce.KeyedState, "FULL", 3)
    pick = random.Random(5)
    rows = [(pick.choice("ab"), T0 + dt.timedelta(seconds=37 * i), i, float(pick.randrange(3))) for i in range(60)]
    came = sorted(rows, key=lambda r: r[1] + dt.timedelta(seconds=pick.randrange(200)))
    batches = [came[i : i + 15] for i in range(0, 60, 15)]
    assert sunk(spark, str(tmp_path / "packhouse" / "d"), batches, 60, 400) == brute_saves(rows, 60)
    left = {p.name: len(list(p.iterdir())) for p in (tmp_path / "packhouse" / "d").iterdir()}
    assert left["fresh"] <= 2 and left["waiting"] <= 2 and left["last"] <= 7


def test_events_behind_the_watermark_are_dropped(spark, tmp_path):
    late = ("a", T0 + dt.timedelta(seconds=100), 9, 5.0)
    batches = [[("a", T0, 0, 1.0), ("b", T0 + dt.timedelta(seconds=1000), 1, 1.0)], [late]]
    assert sunk(spark, str(tmp_path / "packhouse" / "d"), batches, 60, 10) == [("a", 0), ("b", 1)]


def test_hot_key_spreads_over_slices(spark):
    """One key has all events: none of the windows is partitioned by the key alone, but for one row an hour or day."""
    rows = spark.range(20_000).select(F.lit("a").alias("key"), F.timestamp_micros(F.col("id") * 7_000_000).alias("ts"), "id", F.col("id").alias("seq"), F.floor(F.col("id") / 3).cast("double").alias("value"))
    assert debounce.debounced(rows, 15).count() == 20_000 // 3 + 1
    inside = debounce.changes_only(rows.withColumn("key", F.concat("key", F.col("id") % 1)))._jdf.queryExecution().optimizedPlan().toString()
    assert [w for w in inside.splitlines() if "Window " in w and "value" in w and "_hour" not in w] == []


@pytest.mark.parametrize("name", ["debounced_changes", "daily_ledger_flow", "ledger_totals"])
def test_stream_equals_batch(spark, name):
    streamed = sorted(tuple(r) for r in queries()[f"{name}_stream"](spark, SF).collect())
    assert streamed == sorted(tuple(r) for r in queries()[name](spark, SF).collect())


def test_many_batches_equal_one(spark, tmp_path, monkeypatch):
    """Files taken one by one, in the order of their events."""
    monkeypatch.setattr(debounce, "FILES_PER_BATCH", 1)
    monkeypatch.setattr(debounce.KeyedState, "FULL", 3)
    rows = [(i, T0 + dt.timedelta(minutes=17 * i), i % 3, "signup", float(i // 5), "{}") for i in range(60)]
    for n in range(4):
        part = spark.createDataFrame(rows[15 * n : 15 * n + 15], debounce.EVENT_SCHEMA).coalesce(1)
        part.write.mode("append").parquet(str(tmp_path / "in"))
    got = debounce.run_debounce(spark, str(tmp_path / "in"), 1800, pattern="*.parquet")
    events = spark.createDataFrame(rows, debounce.EVENT_SCHEMA)
    keyed = events.select(F.col("user_id").cast("string").alias("key"), F.col("ts").cast("timestamp").alias("ts"), F.col("event_id").alias("seq"), "value")
    assert sorted(tuple(r) for r in got.collect()) == sorted((r.key, r.ts, r.seq, r.value) for r in debounce.debounced(keyed, 1800).collect())


def test_debounce_around_1970(spark):
    epoch = dt.datetime(1970, 1, 1)
    for gap in (60, 90):
        rows = [("a", epoch + dt.timedelta(seconds=s), n, float(n)) for n, s in enumerate(range(-400, 400, 50))] + [("b", epoch + dt.timedelta(seconds=s), n, float(n)) for n, s in enumerate((-50, 50, 150))]
        events = spark.createDataFrame(rows, "key string, ts timestamp, seq long, value double")
        want = sorted((k, n) for k, ts, n, _ in rows if not any(k2 == k and 0 < (t2 - ts).total_seconds() <= gap for k2, t2, _, _ in rows))
        assert sorted((r.key, r.seq) for r in debounce.debounced(events, gap).collect()) == want


def test_late_rows_are_dropped(spark, tmp_path):
    """A row behind the watermark does not reopen a closed day."""
    def write(n, rows):
        data = [(i, ts, 1, "signup", 1.0, "{}") for i, ts in enumerate(rows)]
        ntz = spark.createDataFrame(data, debounce.EVENT_SCHEMA)
        ntz.coalesce(1).write.parquet(str(tmp_path / f"in/f{n}"))

    day = dt.datetime(2024, 1, 1)
    write(0, [day, day + dt.timedelta(days=3)])
    # A batch drops what the watermark of the batch before has passed: this late row still counts, the next doesn't.
    write(1, [day + dt.timedelta(hours=5), day + dt.timedelta(days=6)])
    write(2, [day + dt.timedelta(hours=6), day + dt.timedelta(days=9)])
    rows = spark.readStream.schema(debounce.EVENT_SCHEMA).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(str(tmp_path / "in"))
    flow = flows.daily_flow(flows.entries(rows).withWatermark("ts", "1 hour"))
    query = (
        flow.writeStream.outputMode("append").format("parquet").option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    out = {str(r.day): r.entries for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert out == {"2024-01-01": 2, "2024-01-04": 1, "2024-01-07": 1}
