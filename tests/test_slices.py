"""Sliced windows against plain ones, with one key holding a third of all rows."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from packhouse.operators.slices import numbered, with_neighbour


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(7)
    data = []
    for i in range(3000):
        key = "hot" if i % 3 == 0 else f"k{rng.randrange(40)}"
        data.append((key, rng.randrange(20), f"{rng.randrange(10**6):06d}-{i}", rng.choice([None, 1.0, 2.0])))
    return spark.createDataFrame(data, "key string, day int, id string, value double").repartition(5).cache()


def test_numbered_equals_row_number(rows):
    up = numbered(rows, ["key"], [F.col("day").asc(), F.col("id").asc()], "n")
    plain = F.row_number().over(Window.partitionBy("key").orderBy("day", "id"))
    expected = rows.withColumn("n", plain)
    assert sorted(map(tuple, up.select("id", "n").collect())) == sorted(map(tuple, expected.select("id", "n").collect()))


def test_numbered_descending(rows):
    order = [F.col("day").desc(), F.col("id").desc()]
    down = numbered(rows, ["key"], order, "n")
    expected = rows.withColumn("n", F.row_number().over(Window.partitionBy("key").orderBy(*order)))
    assert sorted(map(tuple, down.select("id", "n").collect())) == sorted(map(tuple, expected.select("id", "n").collect()))


@pytest.mark.parametrize("following", [False, True])
def test_neighbour_equals_lag_and_lead(rows, following):
    step = F.lead if following else F.lag
    got = with_neighbour(rows, "key", "day", ["id"], "value", "near", following)
    expected = rows.withColumn("near", step("value").over(Window.partitionBy("key").orderBy("day", "id")))
    pick = lambda df: sorted(map(tuple, df.select("id", F.col("near").cast("string")).na.fill("none").collect()))
    assert pick(got) == pick(expected)


def test_one_day_of_consecutive_ids_is_split(spark):
    """200,000 rows of one group that agree in all but the end of the id."""
    rows = spark.range(200_000, numPartitions=8).select(
        F.lit("c").alias("key"), F.lit(1).alias("day"), F.format_string("order-%012d", "id").alias("id"), F.col("id").alias("place")
    )
    got = numbered(rows, ["key"], [F.col("day").asc(), F.col("id").asc()], "n")
    assert got.filter("n <> place + 1").count() == 0 and got.count() == 200_000
    parts = rows.repartitionByRange(8, "key", "day", "id").groupBy(F.spark_partition_id()).count()
    assert parts.agg(F.max("count")).first()[0] < 40_000
