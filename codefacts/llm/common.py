"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType, StructField, StructType
from pyspark.sql.window import Window

from codefacts.session import checkpoint_dir


def pin(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back from there
    (cuts the lineage; the files outlive a lost executor)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def computed(df: DataFrame, source: str, name: str, kind: DataType, compute: Callable[[list], Iterable],
             keep_source: bool = False) -> DataFrame:
    """``df`` with the column ``name`` that ``compute`` makes of each batch of the
    column ``source``. The other columns pass through as Arrow, as they are
    (pandas would turn long ids into doubles beside a null)."""
    at, arrow = df.columns.index(source), to_arrow_type(kind)
    kept = [i for i in range(len(df.columns)) if keep_source or i != at]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            values = pa.array(compute(b.column(at).to_pylist()), arrow)
            yield pa.RecordBatch.from_arrays([*[b.column(i) for i in kept], values], [*[b.schema.names[i] for i in kept], name])
    fields = [df.schema.fields[i] for i in kept]
    return df.mapInArrow(run, StructType([*fields, StructField(name, kind)]))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, also where the body uses it
    inside a lambda (a plain reference would be computed per element)."""
    return F.transform(F.array(value), body)[0]


def text_or_empty(df: DataFrame, column: str = "text") -> Column:
    """Null texts count as empty texts everywhere in this package."""
    return F.coalesce(df[column], F.lit(""))


def global_order(df: DataFrame, keys: list[str], partitions: int | None = None) -> DataFrame:
    """Add ``row_index`` (0-based, gapless, in the order of ``keys``) without a
    single-task sort: rows are dealt out by range, numbered inside each range
    and shifted by the row counts of the ranges before. ``df`` should be narrow
    and fully ordered by ``keys`` up to identical rows."""
    dealt = _by_range(df, keys, partitions)
    inside = Window.partitionBy("_part").orderBy(*keys)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per range, so the unpartitioned window sees a table of that size only
    offsets = (dealt.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
               .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off")))
    return (dealt.withColumn("_rank", F.row_number().over(inside))
            .join(offsets, "_part")
            .withColumn("row_index", F.col("_off") + F.col("_rank") - 1)
            .drop("_part", "_rank", "_off"))


def _by_range(df: DataFrame, keys: list[str], partitions: int | None = None) -> DataFrame:
    """Deal rows out by range of ``keys`` and keep the range's number in ``_part``.
    Written once: range bounds come from a sample, so they must not be drawn again."""
    n = [partitions] if partitions else []
    return pin(df.repartitionByRange(*n, *keys).withColumn("_part", F.spark_partition_id()))


def _same(a: tuple, b: tuple) -> bool:
    return a[0] == b[0] and a[1] == b[1]


def _digest(df: DataFrame) -> tuple:
    r = df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return (r[0], r[1])


def components(edges: DataFrame) -> DataFrame:
    """Connected components of an undirected graph given as edges ``(u, v)`` of
    any orderable type: ``(node, root)`` for each node of an edge, ``root`` being
    the smallest node reachable.

    Alternating large-star and small-star steps: every node is linked to the
    smallest neighbour it knows of, which needs O(log n) rounds also for long
    chains. A round moves only edges; minima are pre-aggregated before their
    shuffle, and the join that hands them back is an inner join, which adaptive
    execution can split at hubs. Each round is checkpointed.
    """
    e = pin(edges.where("u <> v")
            .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    seen = _digest(e)
    while seen[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(low, "u").where("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        e = pin(large.join(low, "u")
                .select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"),
                        F.col("m").alias("v"))
                .distinct())
        now = _digest(e)
        if _same(now, seen):
            break
        seen = now
    return (e.select(F.col("u").alias("node"), F.col("v").alias("root"))
            .unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()))
