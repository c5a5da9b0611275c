"""The corpus pipeline: from raw documents to token ids.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written as Parquet and reread as the next stage's ``docs``.  All stages but
the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bibliospark.llm import bpe, decontaminate, langid, line_dedup, ngram_join
from bibliospark.llm.common import saved, table
from bibliospark.llm.queries import TOKENIZER_DIR


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or whose language can't be told, go."""
    return langid.reject_unidentified(docs)


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines stay only in the smallest document that holds them, documents left without any go; n_chars follows the text."""
    return line_dedup.dedup_lines(docs, drop_emptied=True).withColumn("n_chars", F.char_length("text").cast("long"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays (five words, similarity 0.8)."""
    return ngram_join.keep_one(docs, n=5, percent=80)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with passages of the benchmark go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of each document, with their number and the digests of a round trip."""
    return bpe.encode_digest(docs, f"{TOKENIZER_DIR}/byte_bpe_50k.json", with_ids=True)


STAGES = [
    ("language_id", language_id),
    ("repeated_lines", repeated_lines),
    ("near_duplicates", near_duplicates),
    ("benchmark_passages", benchmark_passages),
    ("token_ids", token_ids),
]

# The first stage is a trained classifier, which SQL can't express.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, each to all that the one before it kept."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), name)
    return docs
