"""Sharding by global byte-size prefix sums.

Documents are ordered by ``doc_id``; the running byte total of each document is
its running total inside its range partition plus the totals of the partitions
before it, and the shards are cut where that running total passes equal shares
of the whole. Shards are therefore contiguous in ``doc_id`` and differ in size
by about one document at most.

Only ``(doc_id, size, crc32)`` moves; texts are read where they lie.

Defined results: a null text has no bytes and counts as an empty one; a null
``doc_id`` sorts first; rows that share a ``doc_id`` are ordered by CRC and
size, identical rows take neighbouring slots; an empty table gives an empty
result; fewer documents than shards leave some shards empty; other columns of
the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from codefacts.llm.common import _by_range

OVERHEAD_BYTES = 16


def shard_documents(docs: DataFrame, n_shards: int = 40, overhead: int = OVERHEAD_BYTES,
                    partitions: int | None = None) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` per row of ``docs``."""
    keys = ["doc_id", "text_crc32", "size"]
    narrow = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + overhead).cast("long").alias("size"),
        F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).cast("long").alias("text_crc32"))
    dealt = _by_range(narrow, keys, partitions)

    # One row per range partition: totals, totals before it, grand total.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    totals = dealt.groupBy("_part").agg(F.sum("size").alias("b"), F.count(F.lit(1)).alias("n"))
    offsets = totals.select(
        "_part",
        F.coalesce(F.sum("b").over(before), F.lit(0)).alias("b_before"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n_before"),
        F.sum("b").over(whole).alias("total"))

    inside = Window.partitionBy("_part").orderBy(*keys)
    run = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = (dealt
              .withColumn("b_run", F.sum("size").over(run))
              .withColumn("n_run", F.row_number().over(inside))
              .join(offsets, "_part")
              # middle of the document on the byte line, in half bytes
              .withColumn("mid2", 2 * (F.col("b_before") + F.col("b_run")) - F.col("size"))
              .withColumn("shard", F.least(F.expr(f"int(mid2 * {n_shards} div (2 * total))"),
                                           F.lit(n_shards - 1)))
              .withColumn("row_index", F.col("n_before") + F.col("n_run") - 1))
    # one row per shard
    starts = placed.groupBy("shard").agg(F.min("row_index").alias("first_index"))
    return (placed.join(F.broadcast(starts), "shard")
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                    (F.col("row_index") - F.col("first_index")).cast("long").alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard")))


# The same rows in DuckDB for 40 shards (CRC-32 from its polynomial, byte by byte).
ORACLE_SQL = r"""
WITH crc_table AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce(range(8), lambda a, k: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, i) AS v
    FROM range(256) r(i))),
rows AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS hx, octet_length(encode(coalesce(text, ''))) + 16 AS size FROM documents),
sized AS (
  SELECT doc_id, size::BIGINT AS size, xor(4294967295, list_reduce(
    list_transform(regexp_extract_all(hx, '..'), lambda p: ('0x' || p)::BIGINT),
    lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]), 4294967295)) AS text_crc32
  FROM rows, crc_table),
placed AS (
  SELECT *, row_number() OVER w - 1 AS idx, sum(size) OVER (ORDER BY doc_id NULLS FIRST, text_crc32, size ROWS UNBOUNDED PRECEDING) AS run,
         sum(size) OVER () AS total FROM sized WINDOW w AS (ORDER BY doc_id NULLS FIRST, text_crc32, size)),
cut AS (SELECT *, least(39, (2 * run - size) * 40 // (2 * total))::INTEGER AS shard FROM placed)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard, idx - min(idx) OVER (PARTITION BY shard) AS slot,
       NULL::INTEGER AS grown_shard FROM cut
"""
