"""The corpus pipeline: stages over documents, each written as Parquet and read by the next.

1. quality classifier: documents that it rejects go
2. quality rules: documents that they reject go
3. near duplicates: one document of each group stays, the one of the smallest id
4. substring dedup: words of passages that an earlier document has go; a document keeps its row
5. packing: pieces of the documents left, in sequences of at most 4096 tokens

Stages take all columns of the documents along, extra ones too.  A null text is empty; documents without id stay in
their place and are compared with none.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packhouse.llm import embedding, minmax, packing, quality_rules, recompress, toxicity, work


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a quality score of at least 0.5, by a model of labelled rows outside fold 1 of 3."""
    work.ship(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    s = embedding.Settings()
    model = embedding.fit(embedding.sample(docs, labels.where(toxicity.crc_fold("doc_id", 3) != 1), "quality", s), s)
    plain = _numbered(docs)
    return _named(embedding.score(plain, model, s, keep=tuple(plain.columns), text=_place(docs, "text")).where("score >= 0.5"), docs)


def quality_rule_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that all quality rules keep."""
    work.ship(spark)
    plain = _numbered(docs)
    return _named(quality_rules.measure(plain, keep=tuple(plain.columns), text=_place(docs, "text")).where("kept"), docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents but those linked, over any number of links, to one of a smaller id."""
    work.ship(spark)
    gone = minmax.near_duplicates(docs, minmax.Settings()).where("not kept").select("doc_id")
    return docs.join(work.Work(spark, "gone").cut(gone, "ids"), "doc_id", "left_anti").select(*docs.columns)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words of passages that an earlier one has."""
    work.ship(spark)
    plain = _numbered(docs)
    key, text, chars = (_place(docs, c) for c in ("doc_id", "text", "n_chars"))
    keep = tuple(c for c in plain.columns if c not in (key, text, chars))
    out = recompress.deduplicate(plain, key=key, text=text, keep=keep, kept_text=True)
    shown = {key: F.col("doc_id"), text: F.col("kept_text"), chars: F.length("kept_text").cast("long")}
    return _named(out.select(*[shown.get(c, F.col(c)).alias(c) for c in plain.columns]), docs)


def retrieval_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents."""
    work.ship(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


def _numbered(docs: DataFrame) -> DataFrame:
    """Columns under names of their own, so that none clashes with an operator's."""
    return docs.toDF(*[f"column_{i}" for i in range(len(docs.columns))])


def _place(docs: DataFrame, name: str) -> str:
    return f"column_{docs.columns.index(name)}"


def _named(df: DataFrame, docs: DataFrame) -> DataFrame:
    return df.select(*[F.col(f"column_{i}").alias(c) for i, c in enumerate(docs.columns)])


STAGES = [
    ("quality classifier", quality_classifier),
    ("quality rules", quality_rule_filter),
    ("near duplicates", near_duplicates),
    ("substring dedup", substring_dedup),
    ("packing", retrieval_packing),
]

# The classifier's training can't be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    between = work.Work(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = between.cut(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
