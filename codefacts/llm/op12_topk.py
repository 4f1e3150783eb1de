"""Exact top-k inner products by norm-bucketed retrieval.

All vectors are put in order of their length, longest first, and cut into
buckets of ``bucket_rows``. A query with a current k-th best score ``bound``
needs in a bucket a cosine of at least ``bound / (|q| * longest of the bucket)``,
the local cosine threshold:

* above 1, nothing in the bucket can qualify;
* for high thresholds the bucket is pruned by coordinates: the products over
  the query's largest coordinates, plus the most that the lengths of the other
  parts allow (Cauchy-Schwarz), must reach the bound;
* for low ones by length: only the bucket's rows of length ``bound / |q|`` or
  more, a leading part of it, are left.

From which threshold on coordinates are used is found for each bucket on a few
of its queries (results do not depend on it). What is left is verified by the
exact products, and the bound rises from bucket to bucket.

Spark deals the work out: groups of consecutive buckets meet blocks of queries
in one task each, both of bounded size however the rows are distributed. The
group of the longest vectors goes first and gives each query its first bound;
each task returns at most k rows per query, which are merged per query.

Defined results: see ``vectors`` for the rows that take part; vectors of
different lengths in components have no product; a query's candidates are the
rows with another id; a query with fewer candidates than k returns all; rows
that share an id and differ in the vector are queries of their own (column
``query_row`` of ``nearest`` tells them apart); an empty table or a table without queries gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from codefacts.llm.common import global_order, pin
from codefacts.llm.vectors import LOW, Best, enough, grouped, in_blocks, matrix, meet, products, whole_vectors

SLACK = 1e-9
FOCUS = 16          # coordinates of a query that coordinate pruning reads
LEAVES = 8          # coordinates are used where they leave less than 1 / LEAVES of a bucket
PROBES = 8          # queries that a bucket is tried on


class Bucket:
    """Consecutive rows in order of length, longest first."""

    def __init__(self, ids: np.ndarray, mat: np.ndarray, norms: np.ndarray):
        self.ids, self.mat, self.norms = ids, mat, norms
        self.by_coordinate = np.ascontiguousarray(mat.T)
        self.squares = self.by_coordinate ** 2

    def thresholds(self, bounds: np.ndarray, norms: np.ndarray) -> np.ndarray:
        """Local cosine threshold of each query; a negative bound is easiest for
        the shortest row."""
        length = np.where(bounds > 0, self.norms[0], self.norms[-1]) * norms
        safe = np.where(length > 0, length, 1)
        return np.where(bounds == LOW, -np.inf, np.where(length > 0, bounds / safe, np.where(bounds > 0, np.inf, -np.inf)))

    def by_length(self, q: np.ndarray, norm: np.ndarray, bound: np.ndarray) -> int:
        """How many leading rows any of the queries may need."""
        if len(q) == 0 or (bound <= 0).any():
            return len(self.ids)
        reach = (bound / np.where(norm > 0, norm, 1)).min() * (1 - SLACK)
        return int(np.searchsorted(-self.norms, -reach, side="right"))

    def by_coordinates(self, q: np.ndarray, norm: float, bound: int) -> np.ndarray:
        """Rows whose largest possible product with ``q`` reaches the bound."""
        size = min(FOCUS, len(q))
        at = np.argpartition(-np.abs(q), size - 1)[:size]
        part = q[at] @ self.by_coordinate[at]
        rest_q = np.sqrt(max(norm * norm - q[at] @ q[at], 0.0))
        rest = np.sqrt(np.maximum(self.norms ** 2 - self.squares[at].sum(axis=0), 0.0))
        most = part + rest_q * rest
        # not "<": rows whose lengths overflow are kept
        return np.flatnonzero(~(most < bound - SLACK * (abs(bound) + norm * self.norms[0]) - 1e-3))

    def coordinates_from(self, q: np.ndarray, norms: np.ndarray, bounds: np.ndarray, cos: np.ndarray) -> float:
        """The local cosine threshold from which coordinate pruning pays here."""
        usable = np.flatnonzero((cos > 0) & (cos <= 1 + SLACK))
        if len(usable) == 0 or q.shape[1] <= FOCUS:
            return np.inf
        order = usable[np.argsort(cos[usable])]
        tried = order[np.linspace(0, len(order) - 1, min(PROBES, len(order))).astype(int)]
        good = [cos[i] for i in tried
                if len(self.by_coordinates(q[i], norms[i], bounds[i])) * LEAVES < len(self.ids)]
        return min(good, default=np.inf)


def search(ids: np.ndarray, q: np.ndarray, bounds: np.ndarray, row_ids: np.ndarray, rows: np.ndarray, k: int,
           bucket_rows: int) -> Best:
    """The best ``k`` of ``rows`` (longest first) for each query that reach its bound."""
    best = Best(len(ids), k, bounds)
    norms = np.sqrt((q ** 2).sum(axis=1))
    lengths = np.sqrt((rows ** 2).sum(axis=1))
    for at in range(0, len(rows), bucket_rows):
        cut = slice(at, at + bucket_rows)
        b = Bucket(row_ids[cut], rows[cut], lengths[cut])
        cos = b.thresholds(best.bound, norms)
        start = b.coordinates_from(q, norms, best.bound, cos)
        alive = cos <= 1 + SLACK
        for i in np.flatnonzero(alive & (cos >= start)):
            left = b.by_coordinates(q[i], norms[i], best.bound[i])
            left = left[b.ids[left] != ids[i]]
            if len(left):
                best.add(np.full(len(left), i), products(q[i:i + 1], b.mat[left])[0], b.ids[left])
        some = np.flatnonzero(alive & (cos < start))
        m = b.by_length(q[some], norms[some], best.bound[some])
        for part in np.array_split(some, in_blocks(len(some), 1024)):
            if len(part) and m:
                s = products(q[part], b.mat[:m])
                s[ids[part][:, None] == b.ids[None, :m]] = LOW
                need = np.maximum(best.bound[part], enough(s, k))
                i, j = np.nonzero((s >= need[:, None]) & (ids[part][:, None] != b.ids[None, :m]))
                best.add(part[i], s[i, j], b.ids[j])
    return best


FOUND = "query_row long, query_id long, vec_id long, score long"


def _meet(asked: DataFrame, rows: DataFrame, n_blocks: int, first: int, last: int, k: int, bucket_rows: int) -> DataFrame:
    """Search the groups ``first`` to ``last`` for every query."""
    def one(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        for dim, qs in left.groupby("dim"):
            rs = right[right["dim"] == dim].sort_values("row_index")
            if not len(rs):
                continue
            ids = qs["vec_id"].to_numpy()
            b = search(ids, matrix(qs["vec"], dim), qs["bound"].to_numpy(), rs["vec_id"].to_numpy(),
                       matrix(rs["vec"], dim), k, bucket_rows)
            out.append(pd.DataFrame({"query_row": qs["row_index"].to_numpy()[b.key], "query_id": ids[b.key],
                                     "vec_id": b.id, "score": b.score}))
        return pd.concat(out) if out else pd.DataFrame(columns=["query_row", "query_id", "vec_id", "score"], dtype="int64")

    left = asked.select("block", "row_index", "vec_id", "dim", "vec", "bound",
                        F.explode(F.sequence(F.lit(first), F.lit(last))).alias("grp"))
    right = (rows.where(F.col("grp").between(first, last)).select("grp", "row_index", "vec_id", "dim", "vec")
             .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)))))
    return meet(left, right, one, FOUND)


def nearest(table: DataFrame, is_query: Column, k: int = 5, scale: int = 256, vector: str = "embedding",
            id: str = "vec_id", block_queries: int = 4096, group_rows: int = 16384, bucket_rows: int = 1024) -> DataFrame:
    """``query_row, query_id, rank, vec_id, score``: the ``k`` highest products
    of each row of ``table`` that fulfils ``is_query`` (on the column ``vec_id``)."""
    rows = pin(global_order(whole_vectors(table, vector, id, scale=scale), ["dim", "shorter", "vec_id", "vec"])
               .withColumn("grp", grouped(F.col("row_index"), group_rows)))
    queries = rows.where(is_query)
    n_blocks = in_blocks(queries.count(), block_queries)
    last = in_blocks(rows.count(), group_rows) - 1
    asked = queries.withColumn("block", F.pmod(F.xxhash64("row_index"), F.lit(n_blocks)).cast("int"))
    none = F.lit(int(LOW)).cast("long")
    found = _meet(asked.withColumn("bound", none), rows, n_blocks, 0, 0, k, bucket_rows)
    if last > 0:
        found = pin(found)
        low = (found.groupBy(F.col("query_row").alias("row_index"))
               .agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("low")))
        bounded = asked.join(low, "row_index", "left").withColumn("bound", F.coalesce("low", none))
        found = found.unionByName(_meet(bounded, rows, n_blocks, 1, last, k, bucket_rows))
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_row", "query_id", "rank", "vec_id", "score"))


# The same rows in DuckDB: every product of a query with another row.
ORACLE_SQL = """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM v q, v c WHERE q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(c.v) = len(q.v)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 5
"""
