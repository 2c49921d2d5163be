"""A corpus pipeline over ``documents``: each stage works on all that its predecessor kept, written as Parquet between stages."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from corpusmill.llm import decontaminate, ngram_join, piece_codec, quality_rules, suffix_dedup
from corpusmill.llm.tables import stored, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: documents that the quality rules reject go.

    Null, empty and blank texts have no words and go; a null lang or source is a group of its own; repeated rows are judged alike and
    all stay or go; texts of any length are counted whole; an empty table stays empty; other columns, whatever their names, are kept.
    """
    return quality_rules.passing(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: one document of each group of near copies stays.

    It is the one with the least doc_id (one without an id only if none has one), and one of repeated rows; null and blank texts have no
    shingles, link with nothing and stay; texts of any length count whole; an empty table stays empty; other columns are kept.
    """
    return ngram_join.survivors(docs)


def repeated_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: bytes covered by repeated 200-byte strings are cut out.

    A character cut in two goes, and so does a document of which nothing is left; null texts and those below 200 bytes stay as they
    are; repeated rows are copies of each other, so their texts of 200 bytes or more go; ``n_chars``, where there is one, is counted anew in
    changed rows; texts of any length are cut whole; an empty table stays empty; other columns are kept.
    """
    return suffix_dedup.cleaned(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: documents that hold benchmark items go.

    Null and empty texts, and items without tokens, match nothing; a row without a doc_id goes by its text; repeated rows go or stay
    together; texts of any length are searched whole; without documents or items nothing goes; other columns are kept.
    """
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: token ids of every text, kept where they decode to it.

    A null text has null ids and 0 tokens, an empty one no ids; both stay.  Repeated rows are encoded one by one, texts of any length
    whole; an empty table stays empty; other columns are kept, but ``token_ids`` and ``n_tokens`` replace columns of those names.
    """
    rows = piece_codec.round_trip(docs)
    return rows.filter(rows["decoded"].eqNullSafe(rows["text"])).drop("decoded")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality),
    ("ngram_join", near_duplicates),
    ("suffix_dedup", repeated_text),
    ("decontaminate", benchmark_leaks),
    ("sentencepiece", tokens),
]

#: Suffix sorting, components and tokenisation are not SQL; tests/llm compares run() with a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
