"""Source divergence audit: how far each source's words are from its language's, and from its other sources'.

A term is a run of letters: A-Z and a-z, only these lower-cased, and all code points beyond ASCII.  Each language keeps
the terms that at least ``least_docs`` of its rows have.  A group (lang, source), and a language, gives a kept term of
count c the share p = 1 + floor(10^9 (c + 2) / (N + 2 V)), with N its occurrences of kept terms and V the number of
terms the language keeps.  Two shares differ by f = floor((p - q)^2 / (p + q)).  All arithmetic is on whole numbers.

Terms enter only by their counts, so terms of equal counts are one cell with a multiplicity, and f is worked out once a
cell.

- ``term_ranks``: cells are (count in the group, count in the language).  Cells of equal value are merged, the largest
  values of a group are ranked by the multiplicity before them, and only the cells that reach the report are expanded
  to terms, in UTF-8 order.  As a value holds one term at least, the ``top`` largest values hold all terms of the report.
- ``pair_values``: cells are (count in one source, count in the other).  Terms that one of two sources lacks come
  from each source's own histogram of counts, so only terms that both have are joined, and each unordered pair once.

Odd input: a null text, lang or source is ''.  A repeated row, or id, counts as a row of its own; doc_id isn't read.  A
text without terms still gives its group, with no ranks of terms and the value of its pairs; a language that keeps no
term has pairs of value 0.  Ties are ordered by item.  Extra columns are not read.  An empty table gives no rows.  A
very long text is read term by term, so a task holds its distinct terms, not its occurrences.

Hot groups: texts become counts inside the scan's tasks, and a term's rows are at most one a source.  Nothing is
collected to the driver.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from packhouse.llm.work import Work

_TERM = re.compile(rb"[a-z\x80-\xff]+")
_LONG = 1 << 20
# A term's rows are counted above this bit of the number that counts its occurrences, in one object.
_ROW = 1 << 36
_FLUSH = 900_000


def terms(text: bytes) -> Counter:
    """Occurrences of each term of a text in UTF-8; ``lower`` of bytes touches A-Z alone."""
    text = text.lower()
    return Counter(_TERM.findall(text) if len(text) < _LONG else (m.group() for m in _TERM.finditer(text)))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of a task's rows by (lang, source, term); handed on whenever there are many."""
    found: dict[tuple, dict[bytes, int]] = {}
    size = 0

    def out() -> Iterator[pa.RecordBatch]:
        for (lang, source), sums in found.items():
            both = np.fromiter(sums.values(), np.int64, len(sums))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * len(sums), pa.string()),
                    pa.array([source] * len(sums), pa.string()),
                    pa.array(list(sums), pa.binary()).view(pa.string()),
                    pa.array(both % _ROW),
                    pa.array(both // _ROW),
                ],
                ["lang", "source", "term", "n", "n_docs"],
            )

    for b in batches:
        for lang, source, text in zip(*(b.column(i).to_pylist() for i in range(3))):
            sums = found.setdefault((lang, source), {})
            before = len(sums)
            look = sums.get
            for term, n in terms(text).items():
                sums[term] = look(term, 0) + n + _ROW
            size += len(sums) - before
            if size >= _FLUSH:
                yield from out()
                found, size = {}, 0
    yield from out()


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, n_docs): occurrences, and rows that have the term."""
    rows = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source")], F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    partial = rows.mapInArrow(_count, "lang string, source string, term string, n long, n_docs long")
    return partial.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("n_docs").alias("n_docs"))


def share(count: Column, total: Column, kept: Column) -> Column:
    """p of a count.  Decimals, as 10^9 times a count can pass 64 bits."""
    wide = "decimal(19,0)"
    above = F.lit(10**9).cast("decimal(10,0)") * (count + F.lit(2)).cast(wide)
    return F.lit(1) + F.call_function("div", above, (total + F.lit(2) * kept).cast(wide))


def difference(p: Column, q: Column) -> Column:
    """f of two shares, each at most 10^9 + 1, so that the square fits 64 bits."""
    return F.call_function("div", (p - q) * (p - q), p + q)


class Audit:
    """The tables that both reports read: kept counts, cells and one row a group."""

    def __init__(self, docs: DataFrame, least_docs: int = 10):
        spark = docs.sparkSession
        self.work = Work(spark, "divergence")
        counts = self.work.cut(term_counts(docs), "counts")
        whole = counts.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("n_docs").alias("n_docs"))
        whole = whole.where(F.col("n_docs") >= least_docs).drop("n_docs")
        self.kept = self.work.cut(counts.drop("n_docs").join(whole, ["lang", "term"]), "kept")
        self.cells = self.work.cut(self.kept.groupBy("lang", "source", "n", "lang_n").agg(F.count(F.lit(1)).alias("terms")), "cells")
        langs = whole.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("lang_n").alias("lang_total"))
        sums = self.cells.groupBy("lang", "source").agg(F.sum(F.col("n") * F.col("terms")).alias("total"), F.sum("terms").alias("present"))
        seen = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
        groups = seen.join(sums, ["lang", "source"], "left").join(langs, "lang", "left")
        self.groups = self.work.cut(groups.na.fill(0, ["total", "present", "v", "lang_total"]), "groups", few=True)

    def term_ranks(self, top: int = 10) -> DataFrame:
        """(lang, source, item, value, rank): a group's terms above the language's share, by value."""
        n, lang_n, total, lang_total, v = (F.col(c) for c in ("n", "lang_n", "total", "lang_total", "v"))
        cells = (
            self.cells.join(self.groups, ["lang", "source"])
            .select("lang", "source", "n", "lang_n", "terms", share(n, total, v).alias("p"), share(lang_n, lang_total, v).alias("q"))
            .where("p > q")
            .select("lang", "source", "n", "lang_n", "terms", difference(F.col("p"), F.col("q")).alias("value"))
        )
        values = cells.groupBy("lang", "source", "value").agg(F.sum("terms").alias("terms"))
        down = Window.partitionBy("lang", "source").orderBy(F.col("value").desc())
        largest = values.withColumn("place", F.row_number().over(down)).where(F.col("place") <= top)
        above = F.sum("terms").over(down.rowsBetween(Window.unboundedPreceding, -1))
        reached = largest.withColumn("above", F.coalesce(above, F.lit(0))).where(F.col("above") < top).drop("terms", "place")
        chosen = self.work.cut(cells.join(reached, ["lang", "source", "value"]).drop("terms"), "chosen", few=True)
        named = self.kept.join(chosen, ["lang", "source", "n", "lang_n"])
        up = Window.partitionBy("lang", "source", "value").orderBy("term")
        return (
            named.withColumn("place", F.row_number().over(up))
            .where(F.col("place") <= top)
            .withColumn("rank", (F.col("above") + F.col("place")).cast("int"))
            .where(F.col("rank") <= top)
            .select("lang", "source", F.col("term").alias("item"), "value", "rank")
        )

    def _side(self, name: str, source: str) -> DataFrame:
        """Groups as one side of a pair: its source, total, number of terms and the share of count 0."""
        zero = F.when(F.col("v") > 0, share(F.lit(0), F.col("total"), F.col("v")))
        return self.groups.select(
            "lang", F.col("source").alias(source), *[F.col(c).alias(f"{name}_{c}") for c in ("total", "present")], zero.alias(f"{name}_zero"), "v"
        )

    def pair_values(self) -> DataFrame:
        """(lang, source, item, value, rank): each other source of the language, by its difference over all kept terms."""
        a, b = self._side("a", "source"), self._side("b", "other")
        pairs = a.join(b.drop("v"), "lang").where("source < other")

        # Terms that both have: what they add to the sums over each side's own terms.
        left = self.kept.select("lang", "term", "source", F.col("n").alias("a_n"))
        right = self.kept.select("lang", "term", F.col("source").alias("other"), F.col("n").alias("b_n"))
        joint = left.join(right, ["lang", "term"]).where("source < other").groupBy("lang", "source", "other", "a_n", "b_n").agg(F.count(F.lit(1)).alias("terms"))
        p, q = share(F.col("a_n"), F.col("a_total"), F.col("v")), share(F.col("b_n"), F.col("b_total"), F.col("v"))
        joint = joint.join(a, ["lang", "source"]).join(b.drop("v"), ["lang", "other"]).select("*", p.alias("p"), q.alias("q"))
        extra = difference(F.col("p"), F.col("q")) - difference(F.col("p"), F.col("b_zero")) - difference(F.col("a_zero"), F.col("q"))
        joint = joint.groupBy("lang", "source", "other").agg(F.sum(F.col("terms") * extra).alias("extra"), F.sum("terms").alias("both"))

        # A source's terms against the other's share of count 0.
        bars = self.cells.groupBy("lang", "source", "n").agg(F.sum("terms").alias("terms"))
        own = bars.join(a, ["lang", "source"]).select("lang", "source", "terms", share(F.col("n"), F.col("a_total"), F.col("v")).alias("p"))
        zeros = b.select("lang", "other", "b_zero")
        alone = (
            own.groupBy("lang", "source", "p").agg(F.sum("terms").alias("terms")).join(zeros, "lang").where("source <> other")
            .groupBy("lang", "source", "other").agg(F.sum(F.col("terms") * difference(F.col("p"), F.col("b_zero"))).alias("alone"))
        )
        back = alone.select("lang", F.col("other").alias("source"), F.col("source").alias("other"), F.col("alone").alias("back"))

        keys = ["lang", "source", "other"]
        found = pairs.join(joint, keys, "left").join(alone, keys, "left").join(back, keys, "left").na.fill(0, ["extra", "both", "alone", "back"])
        neither = F.when(
            F.col("v") > 0,
            (F.col("v") - F.col("a_present") - F.col("b_present") + F.col("both")) * difference(F.col("a_zero"), F.col("b_zero")),
        ).otherwise(F.lit(0))
        found = self.work.cut(found.select(*keys, (F.col("extra") + F.col("alone") + F.col("back") + neither).alias("value")), "pairs", few=True)
        both = found.unionByName(found.select("lang", F.col("other").alias("source"), F.col("source").alias("other"), "value"))
        down = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("other"))
        return both.select("lang", "source", F.col("other").alias("item"), "value", F.row_number().over(down).alias("rank"))


def audit(docs: DataFrame, least_docs: int = 10, top: int = 10) -> DataFrame:
    """(lang, source, part, item, value, rank): part ``pair`` of all ranks, part ``term`` of the ``top`` ranks."""
    tables = Audit(docs, least_docs)
    cols = ["lang", "source", "part", "item", "value", "rank"]
    parts = {"pair": tables.pair_values(), "term": tables.term_ranks(top)}
    pair, term = (df.withColumn("part", F.lit(k)).select(*cols) for k, df in parts.items())
    return pair.unionByName(term)
