"""Registered queries of the operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast.llm import decontaminate, near_dedup, negatives, packing, piece_codec, quality_classifier, quality_rules, secret_scan, sharding, training_order, url_filter, warc, whitening
from tillcast.llm.common import read_table, scratch_path
from tillcast.llm.oracle import ORACLES


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_codec.code_digests(read_table(spark, sf_dir, "documents"))


def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(read_table(spark, sf_dir, "documents"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return quality_classifier.score(docs, quality_classifier.train(docs, read_table(spark, sf_dir, "labels")))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write_warc(warc.archive_records(read_table(spark, sf_dir, "pages")), path)
    read = warc.read_warc(spark, path)
    response = F.col("warc_type") == "response"
    digest = F.when(response & ~F.coalesce("digest_ok", F.lit(False)), F.raise_error(F.lit("payload differs from its digest"))).otherwise(F.col("payload_digest"))
    return read.select(warc.page_of(F.col("record_id")).alias("page_id"), F.when(response, F.octet_length("payload")).otherwise(F.col("payload_length")).cast("long").alias("payload_bytes"),
                       digest.alias("payload_digest"), F.col("warc_type").alias("record_type"), warc.page_of(F.col("refers_to")).alias("refers_to"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages")
    return url_filter.judge_urls(pages, url_filter.page_edges(pages))


def op7_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "order")
    training_order.materialise_tokens(read_table(spark, sf_dir, "documents"), path)
    read = training_order.read_order(spark, path)
    return read.select("doc_id", "sequence", "slot", "shard", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
                        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated")


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.interleave(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2("base_spans", 256).alias("base_sha256"), "spans", "n_crf")


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read_table(spark, sf_dir, "embeddings"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.mine(read_table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_sentencepiece, op2_minhash_near_dedup, op3_quality_rules, op4_quality_classifier, op5_warc, op6_url_filter, op7_training_order,
                                   op8_decontamination, op9_sharding, op10_secret_scan, op11_packing, op12_whitening, op13_hard_negatives)}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
