"""Corpus pipeline: each stage takes all documents its predecessor kept, and the last packs them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, jaccard, packing, quality, substrings
from tidemark.llm.common import free_name, stored, table
from tidemark.llm.queries import vocabulary


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and the learned decision list."""
    name = free_name(docs, "measured")
    # measuring costs more than writing: each text is measured once, for fitting and for judging
    measured = stored(docs.withColumn(name, quality.measures(F.col("text"))), "measured")
    m = F.col(name)
    rules = quality.fit_list(stored(quality.labelled(measured.select("doc_id", m.alias("m")), table(spark, sf_dir, "labels")), "labelled"))
    return measured.where(~quality.base_failed(m) & rules.keeps(m)).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that the n-gram Jaccard join links."""
    return jaccard.one_of_each(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without byte strings that occur elsewhere."""
    return substrings.strip(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without words of benchmark items; documents that are little else go."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all remaining documents with their places in training sequences."""
    return packing.pack(docs, vocabulary("byte_bpe_50k.json"))


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("suffix-array dedup", repeated_passages),
    ("benchmark decontamination", benchmark_passages),
    ("packing", packed),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stored(docs, name.replace(" ", "-"))
    return docs
