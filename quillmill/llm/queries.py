"""Queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quillmill.llm import bpe, html_diff, licenses, packing, quality, shards, simhash, topk, toxicity, warc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(spark, table(spark, sf_dir, "documents"))


def op2_page_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_diff.page_differences(spark, table(spark, sf_dir, "pages"))


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicate_groups(spark, table(spark, sf_dir, "documents"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.captures(spark, table(spark, sf_dir, "pages"))


def warc_capture_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.capture_fields(spark, table(spark, sf_dir, "pages"))


def op5_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.training_order(spark, table(spark, sf_dir, "documents"))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(table(spark, sf_dir, "documents"))


def op7_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(spark, table(spark, sf_dir, "embeddings"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(table(spark, sf_dir, "documents"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(table(spark, sf_dir, "documents"))


QUERIES = {name: f for name, f in sorted(globals().items()) if name.startswith(("op", "warc_"))}
ORACLES = {"op7_exact_top_k": topk.top_k_sql(), "warc_capture_fields": warc.CAPTURE_FIELDS_SQL}
