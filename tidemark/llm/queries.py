"""Registered queries of the training-data operators; oracles.py holds their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    codes,
    decontaminate,
    html_text,
    jaccard,
    langid,
    licenses,
    negatives,
    packing,
    quality,
    simhash,
    substrings,
    tokens,
    warc,
)
from tidemark.llm.common import stored, table
from tidemark.session import shared_dir


def vocabulary(name: str) -> str:
    """Place of a public vocabulary file, which every executor has installed."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    hit = decontaminate.hit_words(F.col("spans"))
    return found.select("doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        (hit > 0).alias("contaminated"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.pmod(F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")), F.lit(4)) == 2
    model = langid.fit(docs.where(F.coalesce(~held_out, F.lit(False))).select("text", "lang"))
    return langid.predict(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op4_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_licenses(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word",
                        F.array_join("base_labels", ",").alias("base_labels"),
                        F.array_join("labels", ",").alias("labels"), "score", "tags")


def op5_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.removals(table(spark, sf_dir, "documents"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(spark, table(spark, sf_dir, "pages"), shared_dir(spark, "warc"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    measured = stored(docs.select("doc_id", quality.measures(F.col("text")).alias("m")), "measures")
    rules = quality.fit_list(stored(quality.labelled(measured, table(spark, sf_dir, "labels")), "labelled"))
    m = F.col("m")
    failed = quality.base_failed(m)
    return measured.select(
        "doc_id", *(m[c].alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")),
        failed.alias("base_failed"), (~failed & rules.keeps(m)).alias("kept"), rules.rejected_by(m).alias("rule"))


def op9_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"))


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(table(spark, sf_dir, "pages"))


def op11_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = negatives.prepared(table(spark, sf_dir, "embeddings"), label=label)
    return negatives.mine(rows, rows.where(F.col("vec_id") % 50 == 0))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, codebooks = codes.compress(table(spark, sf_dir, "embeddings"))
    rows = stored(rows, "vector-codes")
    by_label = rows.groupBy(F.col("label").alias("of_label")).agg(F.sum("error").alias("label_error"))
    return rows.join(by_label, F.col("label").eqNullSafe(F.col("of_label"))).select(
        "vec_id", "code", "error", "label_error", F.lit(codes.digest(codebooks)).alias("codebooks_sha256"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_benchmark_decontamination, op2_language_id, op3_token_counts, op4_license_scans, op5_suffix_array_dedup, op6_packing,
        op7_warc, op8_quality_rules, op9_ngram_jaccard_join, op10_html_extraction, op11_simhash_near_dedup,
        op12_hard_negatives, op13_vector_codes)}
