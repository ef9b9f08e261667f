"""Corpus pipeline: documents through quality rules, near-dedup, decontamination, secret
scans and SentencePiece coding, each stage written as Parquet and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast.llm import decontaminate, near_dedup, piece_codec, quality_rules, secret_scan
from tillcast.llm.common import read_table, stored


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops what the rules or the verdict of its host reject."""
    return quality_rules.keep_good(docs)


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near-duplicates stays."""
    return near_dedup.keep_first(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents contaminated by benchmark items."""
    return decontaminate.keep_clean(docs, read_table(spark, sf_dir, "benchmark"))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; secrets are masked and n_chars follows the text."""
    return secret_scan.redact(docs).withColumn("n_chars", F.length("text").cast("long"))


def piece_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of every document, and the text that they decode to."""
    return piece_codec.encode_texts(docs)


STAGES = [("quality rules", quality_stage), ("minhash near-dedup", dedup_stage), ("benchmark decontamination", benchmark_stage),
          ("secret scans", secret_stage), ("sentencepiece", piece_stage)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stored(docs, "stage")
    return docs
