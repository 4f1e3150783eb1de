"""Line dedup by a log-template tree of fixed depth.

A line goes down the tree by its number of tokens and its first ``depth``
tokens; tokens with a digit are variable fields and count as ``<*>``. In a leaf
the most common token of each position (over the leaf's different lines) makes
the leaf's template; lines that agree with it in at least ``similarity`` of
their positions share that template, the positions in which they differ being
further variable fields. Any other line is a template of its own, fields
generalised. A template found in two or more documents is recurring: it stays
in the first of them (lowest ``doc_id``) and is dropped from all others.

Lines of fewer than ``min_tokens`` tokens are left alone: such lines recur by
chance.

Only hashes of lines move, and the tokens of lines in leaves that hold several
different lines; counts are pre-aggregated, so a line that is in every
document costs as much as any other. The texts move once, to meet the list of
their dropped lines.

Defined results: a null text stays null and has no lines; an empty text has one
empty line; rows that share a ``doc_id`` count as one document, so a line of one
is not recurring because of another; a null ``doc_id`` sorts first; a document whose lines are all dropped stays with an
empty text; other columns are passed on, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codefacts.llm.common import pin
from codefacts.llm.spans import few

FIELD = "<*>"
SPACE = r"[\x20\x09-\x0D]++"


def _lines(texts: DataFrame, min_tokens: int, depth: int) -> DataFrame:
    """``doc_id, h, line_no, n, line, leaf`` of the lines that can be templates;
    ``line`` has its tokens parted by one space and its variable fields
    generalised. Regex replacements run only on lines that need them, each step
    by itself so that nothing is computed twice."""
    raw = F.col("raw")
    odd = raw.contains("  ")
    for c in "\t\n\x0b\x0c\r":
        odd = odd | raw.contains(c)
    flat = F.trim(F.when(odd, F.regexp_replace(raw, SPACE, " ")).otherwise(raw))
    n = F.length("flat") - F.length(F.replace(F.col("flat"), F.lit(" "))) + 1
    masked = F.when(F.col("flat").rlike("[0-9]"), F.regexp_replace("flat", r"[^\x200-9]*+[0-9][^\x20]*+", FIELD))
    at = ["doc_id", "h", "line_no"]
    return (texts.select("doc_id", "h", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "raw"))
            .select(*at, flat.alias("flat"))
            .select(*at, "flat", n.alias("n")).where(F.col("n") >= min_tokens)
            .select(*at, "n", F.coalesce(masked, F.col("flat")).alias("line"))
            .select(*at, "n", "line", F.xxhash64("n", F.substring_index("line", " ", depth)).alias("leaf")))


def _extent(from_lines: bool) -> list:
    """Smallest and largest ``doc_id``, and whether there is a null one (the
    smallest of all): plain values, so they are combined before the shuffle."""
    if from_lines:
        return [F.min("doc_id").alias("low"), F.max("doc_id").alias("high"),
                F.max(F.col("doc_id").isNull()).alias("null_id")]
    return [F.min("low").alias("low"), F.max("high").alias("high"), F.max("null_id").alias("null_id")]


def _several() -> Column:
    return (F.col("low") != F.col("high")) | (F.col("null_id") & F.col("low").isNotNull())


def _templates(tokens: DataFrame) -> DataFrame:
    """``leaf, template``: most common token of each position, the smallest of equals."""
    each = tokens.select("leaf", F.posexplode("tokens").alias("pos", "token"))
    counted = each.groupBy("leaf", "pos", "token").agg(F.count(F.lit(1)).alias("c"))
    common = counted.groupBy("leaf", "pos").agg(F.min(F.struct((-F.col("c")).alias("c"), "token")).alias("best"))
    return common.groupBy("leaf").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("pos", "best.token"))), lambda x: x["token"]).alias("template"))


def recurring_lines(texts: DataFrame, similarity: float = 0.8, min_tokens: int = 5,
                    depth: int = 3, broadcast_rows: int = 200_000) -> DataFrame:
    """``doc_id, h, line_no`` of the lines to drop from ``texts`` (``doc_id, h, text``)."""
    lines = _lines(texts, min_tokens, depth)
    found = pin(lines.select("doc_id", "h", "line_no", "leaf", F.xxhash64("line").alias("lh")))
    distinct = found.groupBy("leaf", "lh").agg(*_extent(True))

    shared = (distinct.groupBy("leaf").agg(F.count(F.lit(1)).alias("c"), *_extent(False))
              .where((F.col("c") > 1) & _several()).select("leaf"))
    shared = few(pin(shared), broadcast_rows)
    tokens = (pin(lines.join(shared, "leaf").select("leaf", "line").distinct())
              .select("leaf", F.xxhash64("line").alias("lh"), F.split("line", " ").alias("tokens")))
    same = F.size(F.filter(F.zip_with("tokens", "template", lambda a, b: a == b), lambda e: e))
    members = (tokens.join(_templates(tokens), "leaf")
               .where(same >= F.lit(similarity) * F.size("tokens"))
               .select("leaf", "lh", F.lit(0).cast("long").alias("own")))

    family = distinct.join(members, ["leaf", "lh"], "left").withColumn("own", F.coalesce("own", "lh"))
    keep = F.when(~F.col("null_id"), F.col("low")).alias("keep")
    keeper = family.groupBy("leaf", "own").agg(*_extent(False)).where(_several()).select("leaf", "own", keep)
    drop = family.select("leaf", "lh", "own").join(keeper, ["leaf", "own"]).select("leaf", "lh", "keep")
    return (found.join(drop, ["leaf", "lh"]).where(~F.col("doc_id").eqNullSafe(F.col("keep")))
            .select("doc_id", "h", "line_no"))


def drop_recurring_lines(docs: DataFrame, similarity: float = 0.8, min_tokens: int = 5,
                         depth: int = 3) -> DataFrame:
    """``docs`` with ``text`` cut down, ``n_lines`` and ``n_dropped`` (columns of
    these names are replaced)."""
    packed = docs.select(F.struct("doc_id", F.xxhash64("text").alias("h")).alias("k"), F.struct("*").alias("row"))
    texts = docs.select("doc_id", F.xxhash64("text").alias("h"), "text")
    drops = (recurring_lines(texts, similarity, min_tokens, depth)
             .groupBy(F.struct("doc_id", "h").alias("k")).agg(F.collect_set("line_no").alias("gone")))
    parts = F.split("row.text", "\n", -1)
    kept = F.array_join(F.filter(parts, lambda ln, i: ~F.array_contains("gone", i)), "\n")
    out = packed.join(drops, "k", "left")
    names = [c for c in docs.columns if c not in ("text", "n_lines", "n_dropped")]
    text = F.when(F.col("gone").isNull(), F.col("row.text")).otherwise(kept)
    return out.select(*[F.col(f"row.`{c}`") for c in names], text.alias("text"),
                      F.greatest(F.size(parts), F.lit(0)).cast("long").alias("n_lines"),
                      F.greatest(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"))


# The same rows in DuckDB, by the tokens themselves instead of their hashes.
ORACLE_SQL = r"""
WITH each AS (
  SELECT doc_id, generate_subscripts(l, 1) - 1 AS line_no, unnest(l) AS raw
  FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents)),
masked AS (
  SELECT doc_id, line_no, raw, list_transform(
    list_filter(regexp_split_to_array(raw, '[\x20\x09-\x0D]+'), lambda t: t <> ''),
    lambda t: CASE WHEN regexp_matches(t, '[0-9]') THEN '<*>' ELSE t END) AS tok FROM each),
found AS (SELECT doc_id, line_no, tok, tok[1:3] AS lead, len(tok) AS n FROM masked WHERE len(tok) >= 5),
lines AS (SELECT n, lead, tok, min(doc_id) AS a, max(doc_id) AS b FROM found GROUP BY ALL),
counted AS (
  SELECT n, lead, pos, token, count(*) AS c
  FROM (SELECT n, lead, generate_subscripts(tok, 1) AS pos, unnest(tok) AS token FROM lines) GROUP BY ALL),
common AS (
  SELECT n, lead, pos, token FROM counted
  QUALIFY row_number() OVER (PARTITION BY n, lead, pos ORDER BY c DESC, token) = 1),
template AS (SELECT n, lead, list(token ORDER BY pos) AS tpl FROM common GROUP BY ALL),
family AS (
  SELECT l.*, CASE WHEN len(list_filter(list_zip(tok, tpl), lambda z: z[1] = z[2])) >= 0.8 * n THEN NULL ELSE tok END AS own
  FROM lines l JOIN template USING (n, lead)),
keeper AS (SELECT n, lead, own, min(a) AS keep FROM family GROUP BY ALL HAVING min(a) <> max(b)),
gone AS (
  SELECT f.doc_id, f.line_no FROM found f JOIN family m USING (n, lead, tok)
  JOIN keeper k ON k.n = m.n AND k.lead = m.lead AND k.own IS NOT DISTINCT FROM m.own
  WHERE f.doc_id <> k.keep),
kept AS (
  SELECT e.doc_id, count(*) AS n_lines, count(g.doc_id) AS n_dropped,
         coalesce(string_agg(CASE WHEN g.doc_id IS NULL THEN e.raw END, chr(10) ORDER BY e.line_no), '') AS text
  FROM each e LEFT JOIN gone g USING (doc_id, line_no) GROUP BY e.doc_id)
SELECT doc_id, text, n_lines, n_dropped FROM kept
"""
