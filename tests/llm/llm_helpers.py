"""Fixtures and word rules that the tests of this folder import."""

import re

import pytest
from pyspark.sql import functions as F

LOWER = {i: i + 32 for i in range(65, 91)}


def words(text):
    """Words of letters, digits and anything outside ASCII."""
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def tokens(text):
    """Words between white space."""
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


@pytest.fixture(scope="session")
def make(spark):
    """Documents (doc_id, text) with columns whose names operators use inside."""
    def build(pairs):
        return spark.createDataFrame(pairs, "doc_id long, text string").select(
            "doc_id", "text", *[F.lit(i).alias(c) for i, c in enumerate(
                ("key", "n", "token", "h", "spans", "cleaned", "m", "length", "bucket", "text_key", "cut"))])

    return build


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}


@pytest.fixture(scope="session")
def run(spark, sf_dir):
    from tidemark.llm import queries

    def go(name):
        return queries.queries()[name](spark, sf_dir)

    return go
