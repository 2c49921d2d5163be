"""The numbered operators' queries over the driver's tables, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm import chaining, decontaminate, exact_dedup, hard_negatives, kneser_ney, license_scan, lm_score, ngram_join, piece_codec, quality_rules, suffix_dedup, warc, whitening
from corpusmill.llm.tables import new_path, stored, table


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = piece_codec.round_trip(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("doc_id", "n_tokens", F.xxhash64("token_ids").alias("ids_hash"), F.col("decoded").eqNullSafe(F.col("text")).alias("round_trip"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text")
    counted = stored(quality_rules.with_counts(docs).drop("text"), "op8-counts")
    return quality_rules.judged(counted, quality_rules.thresholds(counted)).select(
        "doc_id", *quality_rules.COUNTS, "base_failed", "kept"
    )


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = suffix_dedup.removed_spans(table(spark, sf_dir, "documents"))
    return spans.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256")


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = kneser_ney.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return rows.select("doc_id", "lang", "n_bytes", "perplexity", "kept")


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.hits(docs, table(spark, sf_dir, "benchmark")).drop("text_hash")


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.components(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    return warc.read_archives(spark, path).drop("payload", "url")


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chaining.repeated(table(spark, sf_dir, "documents"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.families(table(spark, sf_dir, "documents"))


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.scores(table(spark, sf_dir, "documents"))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(whitening.steps(table(spark, sf_dir, "embeddings")))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = hard_negatives.whole_steps(table(spark, sf_dir, "embeddings"), 256)
    rows = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives.mined(rows, "vec_id % 50 = 0")


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.classes(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_suffix_dedup, op2_quality_classifier, op3_decontaminate, op4_ngram_join, op5_warc, op6_substring_dedup, op7_sentencepiece, op8_quality_rules, op9_license_scan, op10_lm_scoring, op11_embedding_whitening, op12_hard_negatives, op13_exact_dedup)}


def oracle_sql() -> dict[str, str]:
    from corpusmill.llm.oracle import ORACLES

    return {k: v for k, v in ORACLES.items() if k in queries()}
