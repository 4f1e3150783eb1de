"""Thin contract queries of the numbered operators, with their DuckDB SQL where
SQL can express the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codefacts.llm import (op01_html, op02_sharding, op03_packing, op05_line_dedup, op06_quality, op07_pii,
                           op08_decontamination, op09_order_minhash, op10_secrets, op11_hard_negatives, op12_topk,
                           op13_spelling)
from codefacts.llm.op04_simhash import simhash_components
from codefacts.sources.tables import table


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op01_html.extract(table(spark, sf_dir, "pages"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op03_packing.pack(table(spark, sf_dir, "documents"), capacity=2048)


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op06_quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op02_sharding.shard_documents(table(spark, sf_dir, "documents"), n_shards=40)


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(table(spark, sf_dir, "documents"), shingle=4, max_bits=4)


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return op05_line_dedup.drop_recurring_lines(docs)


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op08_decontamination.contaminated(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("k")


def op9_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op09_order_minhash.edited_likeness(table(spark, sf_dir, "documents"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op07_pii.scan(table(spark, sf_dir, "documents"))


def op10_secrets_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op10_secrets.scan(table(spark, sf_dir, "documents"))


def op11_hard_negatives_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return op11_hard_negatives.mine(rows.withColumn("label", shifted), F.col("vec_id") % 100 == 0).drop("anchor_row")


def op12_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op12_topk.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0).drop("query_row")


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op13_spelling.variants(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_html_extraction": op1_html_extraction,
    "op2_sharding": op2_sharding,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_simhash_near_dedup": op4_simhash_near_dedup,
    "op5_line_dedup": op5_line_dedup,
    "op6_quality_classifier": op6_quality_classifier,
    "op7_pii": op7_pii,
    "op8_benchmark_decontamination": op8_benchmark_decontamination,
    "op9_order_minhash": op9_order_minhash,
    "op10_secrets": op10_secrets_scan,
    "op11_hard_negatives": op11_hard_negatives_mining,
    "op12_exact_topk": op12_exact_topk,
    "op13_spelling_variants": op13_spelling_variants,
}
ORACLE: dict[str, str] = {
    "op2_sharding": op02_sharding.ORACLE_SQL,
    "op5_line_dedup": op05_line_dedup.ORACLE_SQL,
    "op11_hard_negatives": op11_hard_negatives.ORACLE_SQL,
    "op12_exact_topk": op12_topk.ORACLE_SQL,
    "op13_spelling_variants": op13_spelling.ORACLE_SQL,
}
