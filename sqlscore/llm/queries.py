"""Registered queries of the training-data operators (thin: tables in, contract columns out)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (decontamination, fingerprints, hard_negatives, html_extract, jaccard_join, line_dedup, lm_scoring, mixing,
               packing, pii, resampling, substring_dedup, toxicity)

#: Key of the surrogates of the registered query (a deployment brings its own secret).
PII_KEY = "surrogate-key-1"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that remain when runs held by earlier documents are removed."""
    kept = substring_dedup.dedup_substrings(_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language-model and unigram scores of every document."""
    return lm_scoring.score_documents(_table(spark, sf_dir, "documents"))


def op3_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its personal data replaced by surrogates."""
    return pii.replace_entities(_table(spark, sf_dir, "documents"), PII_KEY)


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that remain when repeated lines are kept in one document only."""
    kept = line_dedup.dedup_lines(_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calibrated toxicity of every document."""
    docs = _table(spark, sf_dir, "documents")
    return toxicity.score_documents(docs, toxicity.train(docs, _table(spark, sf_dir, "labels")))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items that leak into documents."""
    return decontamination.find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and their likeness."""
    return fingerprints.edited_pairs(_table(spark, sf_dir, "documents"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of all documents by source weights."""
    mix = mixing.mix_sources(_table(spark, sf_dir, "documents"))
    return mix.select("doc_id", "size", "source_size", "target", "taken")


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = _table(spark, sf_dir, "pages")
    text = html_extract.extract_pages(pages, html_extract.train(pages))
    return text.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of the documents under the n-gram Jaccard join."""
    return jaccard_join.link_components(_table(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of the anchors; rows divisible by seven carry the next label."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding", label.alias("label"))
    mined = hard_negatives.mine(rows, F.col("vec_id") % 100 == 0)
    return mined.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of all packed sequences."""
    packed = packing.pack_documents(_table(spark, sf_dir, "documents"))
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents drawn by their likeness to the benchmark texts."""
    drawn = resampling.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


QUERIES = {f.__name__: f for f in (op1_substring_dedup, op2_lm_scoring, op3_pii_surrogates, op4_line_dedup, op5_toxicity,
                                   op6_decontamination, op7_fingerprints, op8_mixing, op9_html_extraction, op10_jaccard_join, op11_hard_negatives,
                                   op12_packing, op13_resampling)}
