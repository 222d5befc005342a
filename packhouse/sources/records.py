"""JSON arrays of flat records, of any size, read as records by many tasks.

A document is an array; a file holds one or several, each starting on a line, and a document may be one line of any length. Spark's
text source cuts files at closing braces, whatever byte range a task was given, and tells the range, so that pieces have an
order. A brace inside a string doesn't end a record: quotes are counted, range by range, and pieces that belong to one record
are put together again. A document counts as a whole: with one record that can't be read, or without its closing
bracket, it is unreadable and none of its records count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packhouse.operators.slices import running_before

_PLACE = ["piece", "part"]


def pieces(spark: SparkSession, path: str) -> DataFrame:
    """(file, range_start, piece, part, text, braced): texts up to a closing brace, or up to where a document starts.

    ``braced``: a brace follows, so that a record may end here.
    """
    lines = spark.read.option("lineSep", "}").text(path)
    rows = lines.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("range_start"),
        F.col("_metadata.file_size").alias("size"),
        F.monotonically_increasing_id().alias("piece"),
        "value",
    )
    # What follows a file's last brace is a piece too, but for nothing.
    sizes = rows.groupBy(F.col("file").alias("_file")).agg(
        F.max(F.struct("range_start", "piece")).alias("_last"), (F.sum(F.octet_length("value") + 1) > F.max("size")).alias("_open")
    )
    rows = rows.join(sizes, F.col("file") == F.col("_file"))
    ends_file = F.col("_open") & (F.struct("range_start", "piece") == F.col("_last"))
    parts = F.split("value", r"(?<=\n)(?=[ \t\r]*\[)")
    split = rows.select("file", "range_start", "piece", ends_file.alias("ends_file"), F.size(parts).alias("n"), F.posexplode(parts).alias("part", "text"))
    return split.select("file", "range_start", "piece", "part", "text", ((F.col("part") == F.col("n") - 1) & ~F.col("ends_file")).alias("braced"))


def records(spark: SparkSession, path: str, shape: str) -> DataFrame:
    """(file, document, record, value, fine): each record, and what is left behind the last one of a document.

    ``value`` is null for what isn't a record of that shape, and ``fine`` tells whether it may stand where it stands.
    """
    rows = pieces(spark, path).withColumn("starts", F.col("text").rlike(r"^[ \t\r\n]*\["))
    starts = {"document": F.col("starts").cast("int")}
    rows = running_before(rows, ["file"], "range_start", _PLACE, starts).withColumn("document", F.col("document") + F.col("starts").cast("int"))
    quotes = F.length(F.regexp_replace(F.regexp_replace("text", r"\\.", ""), r'[^"]', ""))
    rows = running_before(rows.withColumn("quotes", quotes), ["file", "document"], "range_start", _PLACE, {"quoted": F.col("quotes")})
    rows = rows.withColumn("ends", (F.col("braced") & ((F.col("quoted") + F.col("quotes")) % 2 == 0)).cast("int"))
    rows = running_before(rows, ["file", "document"], "range_start", _PLACE, {"record": F.col("ends")})
    piece = F.concat("text", F.when(F.col("braced"), "}").otherwise(""))
    parts = F.array_sort(F.collect_list(F.struct("range_start", *_PLACE, piece.alias("text"))))
    whole = rows.groupBy("file", "document", "record").agg(F.array_join(F.transform(parts, lambda x: x["text"]), "").alias("text"), F.max("ends").alias("ends"))
    head = r"^\s*[\[,]\s*"
    value = F.from_json(F.regexp_replace("text", head, ""), f"{shape}, _bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    parsed = whole.withColumn("value", F.when((F.col("ends") == 1) & F.col("text").rlike(head + r"\{"), value))
    first = F.col("record") == 0
    opened = F.when(first, F.col("text").rlike(r"^\s*\[")).otherwise(F.col("text").rlike(r"^\s*,"))
    closed = F.when(first, F.col("text").rlike(r"^\s*\[\s*\]\s*$")).otherwise(F.col("text").rlike(r"^\s*\]\s*$"))
    fine = F.when(F.col("ends") == 1, opened & F.col("value").isNotNull() & F.col("value._bad").isNull()).otherwise(closed)
    # White space in front of a file's first document is none.
    blank = (F.col("document") == 0) & F.col("text").rlike(r"^\s*$")
    return parsed.filter(~blank).select("file", "document", "record", "value", "ends", fine.alias("fine"))


def documents(found: DataFrame) -> DataFrame:
    """(file, document, readable): all records in their places, and the closing bracket behind them."""
    closed = F.count_if(F.col("ends") == 0) == 1
    return found.groupBy("file", "document").agg((F.bool_and(F.coalesce("fine", F.lit(False))) & closed).alias("readable"))


def readable(found: DataFrame) -> DataFrame:
    """(value): records of documents that can be read."""
    good = documents(found).filter("readable").select(F.col("file").alias("_file"), F.col("document").alias("_document"))
    kept = found.filter("ends = 1").join(good, (F.col("file") == F.col("_file")) & (F.col("document") == F.col("_document")), "left_semi")
    return kept.select("value")
