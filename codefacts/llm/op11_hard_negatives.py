"""Hard negatives by slot-decomposed selection.

For an anchor and one of its positives the hard negatives are the rows of other
labels whose score lies in a window that ends at the positive's score. An
anchor's windows overlap. Their upper limits (the scores of its positives) cut
the scores into disjoint slots, one below each limit down to the next. Every
task keeps the ``k`` best rows per anchor and slot (the combiner), those are
merged per slot, and since slots are in descending order, the answer for a
limit is the first ``k`` of the suffix of slots from its own on: all windows of
an anchor are read off one list of at most ``k`` rows per slot. The windows'
lower limits are applied last; a row below one stands behind all above it.

Positives come first: rows are put in order of their label and cut into groups,
and blocks of anchors meet only the groups that hold one of their labels. For
the negatives, every block of anchors meets every group. Blocks and groups are
of bounded size, also if a label holds a third of all rows.

Defined results: see ``vectors`` for the rows that take part; a null label takes
no part either; a row with the anchor's own id, or another number of components,
is neither its positive nor its negative; an anchor without positives gives no
rows, a positive without negatives in its window neither; rows that share an id
and differ otherwise are anchors of their own (``anchor_row``); an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from codefacts.llm.common import global_order, pin
from codefacts.llm.vectors import LOW, Best, enough, grouped, in_blocks, matrix, meet, products, whole_vectors

TILE = 256          # anchors multiplied with a group at a time
FOUND = "anchor_row long, anchor_id long, slot int, vec_id long, score long"


def _frame(anchors: pd.DataFrame, best: Best, slots: int) -> pd.DataFrame:
    own = best.key // slots
    return pd.DataFrame({"anchor_row": anchors["row_index"].to_numpy()[own], "anchor_id": anchors["vec_id"].to_numpy()[own],
                         "slot": (best.key % slots).astype("int32"), "vec_id": best.id, "score": best.score})


def _tiles(left: pd.DataFrame, right: pd.DataFrame):
    """Anchors and rows of the same number of components, some anchors at a time."""
    for dim, anchors in left.groupby("dim"):
        rows = right[right["dim"] == dim]
        if len(rows):
            mat = matrix(rows["vec"], dim)
            for at in range(0, len(anchors), TILE):
                part = anchors.iloc[at:at + TILE]
                yield part, matrix(part["vec"], dim), rows, mat


def _positives(k: int):
    def one(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = [_frame(left[:0], Best(0, k), 1)]
        for anchors, a, rows, mat in _tiles(left.sort_values("label"), right):
            near = np.flatnonzero(rows["label"].isin(anchors["label"].unique()).to_numpy())
            if not len(near):
                continue
            ids, labels = rows["vec_id"].to_numpy()[near], rows["label"].to_numpy()[near]
            s = products(a, mat[near])
            same = ((anchors["label"].to_numpy()[:, None] == labels[None, :])
                    & (anchors["vec_id"].to_numpy()[:, None] != ids[None, :]))
            s[~same] = LOW
            i, j = np.nonzero(same & (s >= enough(s, k)[:, None]))
            best = Best(len(anchors), k)
            best.add(i, s[i, j], ids[j])
            out.append(_frame(anchors, best, 1))
        return pd.concat(out)
    return one


def _slots(k: int, slots: int, share: float):
    def one(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = [_frame(left[:0], Best(0, k), slots)]
        for anchors, a, rows, mat in _tiles(left, right):
            ids, labels = rows["vec_id"].to_numpy(), rows["label"].to_numpy()
            # limits of each anchor, highest first; below the last comes nothing
            limits = np.full((len(anchors), slots), LOW)
            for i, x in enumerate(anchors["limits"]):
                limits[i, :len(x)] = x
            real = limits > LOW
            # no window reaches below this (a little less, so that rounding drops nothing)
            floor = np.where(real & (limits >= 0), share * limits * (1 - 1e-9) - 1, np.inf).min(axis=1)
            best = Best(len(anchors) * slots, k)
            for at in range(0, len(ids), 4096):
                cut = slice(at, at + 4096)
                s = products(a, mat[cut])
                other = ((anchors["label"].to_numpy()[:, None] != labels[None, cut])
                         & (anchors["vec_id"].to_numpy()[:, None] != ids[None, cut]))
                i, j = np.nonzero(other & (s >= floor[:, None]) & (s <= limits[:, :1]))
                score = s[i, j]
                slot = ((limits[i] >= score[:, None]) & real[i]).sum(axis=1) - 1
                best.add(i * slots + slot, score, ids[cut][j])
            out.append(_frame(anchors, best, slots))
        return pd.concat(out)
    return one


def _best_of(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(table: DataFrame, is_anchor: Column, n_positives: int = 5, k: int = 5, lowest_percent: int = 80,
         scale: int = 256, vector: str = "embedding", id: str = "vec_id", label: str = "label",
         block_anchors: int = 2048, group_rows: int = 16384) -> DataFrame:
    """``anchor_row, anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score``: for each row that fulfils ``is_anchor`` (on the column
    ``vec_id``) and each of its first ``n_positives`` rows of the same label, the
    ``k`` best rows of other labels scoring at most the positive's score and at
    least ``lowest_percent`` of it."""
    given = table.where(F.col(label).isNotNull()).withColumn("label", F.col(label))
    keys = ["dim", "label", "vec_id", "vec"]
    rows = pin(global_order(whole_vectors(given, vector, id, ("label",), scale), keys)
               .withColumn("grp", grouped(F.col("row_index"), group_rows)))
    anchors = rows.where(is_anchor).select("row_index", *keys)
    numbered = global_order(anchors.withColumnRenamed("row_index", "anchor_index"), keys)
    asked = pin(numbered.withColumn("block", grouped(F.col("row_index"), block_anchors))
                .drop("row_index").withColumnRenamed("anchor_index", "row_index"))
    n_blocks = in_blocks(asked.count(), block_anchors)
    n_groups = in_blocks(rows.count(), group_rows)

    # positives: a block meets the groups that hold a label of its anchors
    held = rows.select("dim", "label", "grp").distinct()
    left = asked.join(held, ["dim", "label"]).select("block", "grp", "row_index", *keys)
    met = left.select("block", "grp").distinct()
    right = rows.join(met, "grp").select("block", "grp", *keys)
    pairs = meet(left, right, _positives(n_positives), FOUND)
    positives = pin(_best_of(pairs, ["anchor_row"], n_positives).drop("slot", "rank"))

    # negatives: the best of each slot between the positives' scores
    limits = (positives.groupBy(F.col("anchor_row").alias("row_index"))
              .agg(F.reverse(F.array_sort(F.collect_set("score"))).alias("limits")))      # at most n_positives
    left = (asked.join(limits, "row_index").select("block", "row_index", "limits", *keys)
            .withColumn("grp", F.explode(F.sequence(F.lit(0), F.lit(n_groups - 1)))))
    right = rows.select("grp", *keys).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
    pairs = meet(left, right, _slots(k, n_positives, lowest_percent / 100), FOUND)
    kept = _best_of(pairs, ["anchor_row", "slot"], k)

    # suffixes: at most n_positives * k rows of an anchor, highest first
    listed = kept.groupBy("anchor_row").agg(F.array_sort(F.collect_list(F.struct(
        F.negate("score").alias("low"), "vec_id", "score", "slot"))).alias("listed"))
    limit = F.col("score")
    exact = limit.cast("decimal(25,0)") * lowest_percent
    suffix = F.slice(F.filter("listed", lambda x: x["score"] <= limit), 1, k)
    window = F.filter(suffix, lambda x: x["score"].cast("decimal(25,0)") * 100 >= exact)
    return (positives.join(listed, "anchor_row")
            .select("anchor_row", "anchor_id", F.col("vec_id").alias("positive_id"), limit.alias("positive_score"),
                    F.posexplode(window).alias("at", "n"))
            .select("anchor_row", "anchor_id", "positive_id", (F.col("at") + 1).alias("rank"),
                    F.col("n.vec_id").alias("negative_id"), "positive_score", F.col("n.score").alias("negative_score")))


# The same rows in DuckDB: all products with the anchors, ranked.
ORACLE_SQL = """
WITH v AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_inner_product(a.v, c.v)::BIGINT AS score
  FROM v a, v c WHERE a.vec_id % 100 = 0 AND c.vec_id <> a.vec_id AND len(a.v) = len(c.v)),
p AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS n FROM s WHERE same)
  WHERE n <= 5),
w AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
   AND 80 * p.score <= 100 * s.score AND s.score <= p.score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM w WHERE rank <= 5
"""
