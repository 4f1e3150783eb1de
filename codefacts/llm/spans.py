"""Regex matches with their positions, by built-in functions only.

Splitting a text at a pattern gives the pieces between the matches and
``regexp_extract_all`` the matches themselves; running sums of both lengths are
the positions in code points. The sums run over one row per match, so a text
with very many matches costs no more per match than a short one.

Patterns are Java's. Runs are possessive where nothing after them could make a
shorter run match, which finds the same spans, needs no stack and does not
retry a long run from each of its characters.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

KEY = ["doc_id", "h"]


@dataclass(frozen=True)
class Kind:
    """A kind of span: pattern, a cheap test that any text with a match passes,
    and what a match must fulfil to count."""

    name: str
    pattern: str
    may_match: Callable[[Column], Column]
    keep: Callable[[Column], Column]


def keyed(docs: DataFrame) -> DataFrame:
    """``doc_id, h, text``: null texts are empty, ``h`` tells rows that share a
    ``doc_id`` apart."""
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", text.alias("text")).withColumn("h", F.xxhash64("text"))


def attach(rows: DataFrame, by_text: DataFrame, how: str = "inner") -> DataFrame:
    """``rows`` with the columns of ``by_text`` for the same text (null ``doc_id`` included)."""
    right = by_text.withColumnRenamed("doc_id", "_doc_id").withColumnRenamed("h", "_h")
    same = F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("h") == F.col("_h"))
    return rows.join(right, same, how).drop("_doc_id", "_h")


def outside(spans: DataFrame, base: DataFrame) -> DataFrame:
    """Those of ``spans`` that overlap none of ``base``."""
    held = attach(spans, per_text(base), "left")
    inside = F.exists("spans", lambda s: (s["start"] < F.col("end")) & (s["end"] > F.col("start")))
    return held.where(~F.coalesce(inside, F.lit(False))).drop("spans")


def find_spans(texts: DataFrame, kinds: list[Kind]) -> DataFrame:
    """``doc_id, h, kind (index), start, end, found`` for each kept match in the
    distinct rows of ``texts`` (as of ``keyed``)."""
    text = F.col("text")

    def matches(i: int, k: Kind) -> Column:
        cut = F.arrays_zip(
            F.transform(F.split(text, k.pattern, -1), F.length).alias("gap"),
            F.regexp_extract_all(text, F.lit(k.pattern), F.lit(0)).alias("found"))
        return F.struct(F.lit(i).alias("kind"), F.when(k.may_match(text), cut).alias("cut"))

    found = F.filter(F.array(*[matches(i, k) for i, k in enumerate(kinds)]), lambda x: F.size(x["cut"]) > 1)
    with_any = (texts.select(*KEY, found.alias("found")).where(F.size("found") > 0).dropDuplicates(KEY))
    each = (with_any.select(*KEY, F.explode("found").alias("f"))
            .select(*KEY, "f.kind", F.posexplode("f.cut").alias("i", "c"))
            .select(*KEY, "kind", "i", "c.gap", "c.found").where("found is not null"))
    run = (Window.partitionBy(*KEY, "kind").orderBy("i")
           .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = (each.withColumn("end", F.sum(F.col("gap") + F.length("found")).over(run))
              .withColumn("start", F.col("end") - F.length("found")))
    keep = F.coalesce(*[F.when(F.col("kind") == i, k.keep(F.col("found"))) for i, k in enumerate(kinds)])
    return placed.where(keep).select(*KEY, "kind", "start", "end", "found")


def per_text(spans: DataFrame) -> DataFrame:
    """``doc_id, h, spans``: the spans of a text as an array ordered by start,
    then kind."""
    item = F.struct("start", "kind", "end")
    return spans.groupBy(*KEY).agg(F.sort_array(F.collect_list(item)).alias("spans"))


def written(spans: Column, names: list[str]) -> Column:
    """``kind:start:end,...``"""
    label = F.array(*[F.lit(n) for n in names])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", label[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest_columns(texts: DataFrame, spans: DataFrame, names: list[str], n_base: int) -> DataFrame:
    """Per row of ``texts``: ``doc_id``, ``n_<kind>`` of the base kinds,
    ``base_sha256`` of the base spans and ``spans`` with all."""
    none = F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")
    joined = attach(texts.select(*KEY), per_text(spans), "left")
    base = joined.select("doc_id", F.coalesce("spans", none).alias("all")).withColumn("base", F.filter("all", lambda s: s["kind"] < n_base))

    def count(i):
        return F.size(F.filter("base", lambda s: s["kind"] == i)).cast("long")
    return base.select(
        "doc_id", *[count(i).alias(f"n_{n}") for i, n in enumerate(names[:n_base])],
        F.sha2(written(F.col("base"), names), 256).alias("base_sha256"),
        written(F.col("all"), names).alias("spans"))


def few(df: DataFrame, bound: int) -> DataFrame:
    """Mark ``df`` for broadcasting if it has at most ``bound`` rows; beyond that
    it is joined by a shuffle."""
    return F.broadcast(df) if df.limit(bound + 1).count() <= bound else df
