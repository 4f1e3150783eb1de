"""JSON documents of unknown shape, SURVEY S4/S5.

A document is read whole and kept as ``VARIANT``, so fields that differ from
file to file need no schema and cost nothing until they are asked for. A file
that is no JSON does not end the read: its row has no document and its text
in ``broken``. A file without a byte has no row, as Spark's file scan leaves it out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from codefacts.sources.files import read_source_tree


def read_documents(spark: SparkSession, root: str, suffix: str = ".json") -> DataFrame:
    """``(source_file, document, broken)``, one row per file under ``root``."""
    files = read_source_tree(spark, root, suffix)
    doc = files.select(F.col("path").alias("source_file"), F.try_parse_json("content").alias("document"), "content")
    return doc.select("source_file", "document", F.when(F.col("document").isNull(), F.col("content")).alias("broken"))


def value_at(value: Column | str, path: str, kind: str = "string") -> Column:
    """The value at ``path``; NULL where it is absent or of another kind."""
    return F.try_variant_get(F.col(value) if isinstance(value, str) else value, path, kind)


def list_items(df: DataFrame, value: str, path: str, ord_col: str = "ord", item_col: str = "item") -> DataFrame:
    """A row per entry of the list at ``path`` inside the VARIANT column ``value``
    with its 0-based position. An absent list, a null or a value that is no list has none."""
    tvf = df.sparkSession.tvf.variant_explode(value_at(F.col(value), path, "variant").outer())
    rows = df.lateralJoin(tvf).where("key is null")
    return rows.select(*df.columns, F.col("pos").alias(ord_col), rows["value"].alias(item_col))
