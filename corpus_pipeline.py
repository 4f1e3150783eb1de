"""Corpus pipeline: documents to packed training sequences.

Five stages, each calling one operator of ``codefacts.llm`` on all that the
stage before kept. Between stages the documents are written as Parquet to the
folder all executors share (``spark.checkpoint.dir``) and read again, so a lost
executor never costs more than the stage it was working on. All stages but the
last return the columns of the input table.

Rows: null texts, repeated rows, ties and extra columns are treated as the
operators define it. No stage can be expressed whole in SQL (the classifier is
trained), so there is no ORACLE_SQL; the tests hold the run against a
brute-force version.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from codefacts.llm import op03_packing, op04_simhash, op05_line_dedup, op06_quality, op08_decontamination
from codefacts.session import checkpoint_dir
from codefacts.sources.tables import table

ORACLE_SQL = None


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return op06_quality.keep_good(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of recurring templates go from all documents but the first."""
    cut = op05_line_dedup.drop_recurring_lines(docs)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        cut = cut.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast(kind))
    return cut.select(*docs.columns)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies stays, the one with the smallest
    ``doc_id`` (null ones last; of rows that share it, the first by the text's
    hash). Rows are told apart by ``doc_id`` and text, so documents without an
    id, or with the same one, stay in their own groups."""
    keep = op04_simhash.first_of_components(docs, shingle=4, max_bits=4)
    key = F.struct("doc_id", F.xxhash64("text").alias("h")).alias("k")
    # repeated rows go before the shuffle (a window's group limit), not in one task
    first = Window.partitionBy("k").orderBy("row.text")
    rows = docs.select(key, F.struct("*").alias("row")).withColumn("n", F.row_number().over(first)).where("n = 1")
    return rows.join(keep.select(F.struct("doc_id", "h").alias("k")), "k").select("row.*")


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return op08_decontamination.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of each document in the training sequences."""
    return op03_packing.pack(docs)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("best_fit_packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, each written and reread."""
    folder = f"{checkpoint_dir(spark).rstrip('/')}/corpus-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{i}_{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
