"""Whole-numbered vectors in blocks, shared by the operators on ``embeddings``.

Each component x becomes floor(scale * x). Vectors with a null id, a null
vector, or a null or non-finite component take no part, and rows that repeat an
id, a vector and the other columns count once. Vectors travel as packed binary
(two bytes per component where that holds them) and are multiplied in blocks
inside tasks. Products are exact; one beyond the range of a long counts as the
nearest long.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOW = np.iinfo(np.int64).min


def whole_vectors(table: DataFrame, vector: str = "embedding", id: str = "vec_id", others: tuple[str, ...] = (),
                  scale: int = 256) -> DataFrame:
    """``vec_id, others, dim, shorter, vec`` of the rows that take part;
    ``shorter`` is the negated length, so that ascending order puts long vectors first."""
    x = F.col(vector).cast("array<double>")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    valid = (table.where(F.col(id).isNotNull() & x.isNotNull() & finite)
             .select(F.col(id).cast("long").alias("vec_id"), *others, x.alias("x")))
    names = ["vec_id", *others]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column(b.schema.get_field_index("x"))
            flat, ends = np.floor(scale * lists.flatten().to_numpy(zero_copy_only=False)), lists.offsets.to_numpy()
            rows = [flat[s - ends[0]:e - ends[0]] for s, e in zip(ends[:-1], ends[1:])]
            short = [r.size == 0 or np.abs(r).max() < 1 << 15 for r in rows]
            yield pa.RecordBatch.from_arrays(
                [b.column(b.schema.get_field_index(n)) for n in names]
                + [pa.array([r.size for r in rows], pa.int32()),
                   pa.array([-float(np.sqrt(r @ r)) for r in rows], pa.float64()),
                   pa.array([r.astype("<i2" if s else "<f8").tobytes() for r, s in zip(rows, short)], pa.binary())],
                [*names, "dim", "shorter", "vec"])
    kinds = ", ".join(f"{n} {valid.schema[n].dataType.simpleString()}" for n in names)
    return valid.mapInArrow(pack, f"{kinds}, dim int, shorter double, vec binary").dropDuplicates([*names, "vec"])


def matrix(packed, dim: int) -> np.ndarray:
    """One row of doubles per packed vector."""
    rows = [np.frombuffer(v, "<i2" if len(v) == 2 * dim else "<f8") for v in packed]
    return np.array(rows, dtype=np.float64).reshape(len(rows), dim)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of the rows of ``a`` and ``b`` as longs. Doubles are exact
    while every partial sum stays below 2**53; rows with larger components are
    multiplied in Python integers."""
    with np.errstate(invalid="ignore", over="ignore"):
        out = (a @ b.T).astype(np.int64)
    limit = np.sqrt((2.0 ** 53 - 1) / max(a.shape[1], 1))
    big_a, big_b = (np.flatnonzero(np.abs(m).max(axis=1, initial=0) > limit) for m in (a, b))
    for rows, cols in ((big_a, np.arange(len(b))), (np.arange(len(a)), big_b)):
        if len(rows) and len(cols):
            out[np.ix_(rows, cols)] = _in_integers(a[rows], b[cols])
    return out


def _in_integers(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    as_int = np.vectorize(int, otypes=[object])
    exact = as_int(a) @ as_int(b).T
    return np.clip(exact, int(LOW), -int(LOW) - 1).astype(np.int64)


class Best:
    """The ``k`` best (score, id) seen of each of ``n`` keys; ties go to smaller
    ids. ``bound`` is the score a new candidate must reach (the lowest long
    while a key has fewer than ``k``)."""

    def __init__(self, n: int, k: int, bound: np.ndarray | None = None):
        self.k = k
        self.bound = np.full(n, LOW) if bound is None else bound.astype(np.int64)
        self.key = np.empty(0, np.int64)
        self.score, self.id = np.empty(0, np.int64), np.empty(0, np.int64)

    def add(self, key: np.ndarray, score: np.ndarray, id: np.ndarray) -> None:
        reached = score >= self.bound[key]
        if not reached.any():
            return
        key, score, id = (np.concatenate([old, new[reached]]) for old, new in
                          ((self.key, key), (self.score, score), (self.id, id)))
        order = np.lexsort((id, ~score, key))       # ~score falls as score grows
        key, score, id = key[order], score[order], id[order]
        first = np.searchsorted(key, key, side="left")
        rank = np.arange(len(key)) - first
        kept = rank < self.k
        full = rank == self.k - 1
        self.bound[key[full]] = np.maximum(self.bound[key[full]], score[full])
        self.key, self.score, self.id = key[kept], score[kept], id[kept]


def enough(scores: np.ndarray, k: int) -> np.ndarray:
    """Per row of ``scores`` its ``k``-th largest value (the lowest if there are fewer)."""
    m = scores.shape[1]
    return np.partition(scores, max(m - k, 0), axis=1)[:, max(m - k, 0)] if m else np.full(len(scores), LOW)


def in_blocks(count: int, size: int) -> int:
    """Number of blocks of at most about ``size`` rows."""
    return max(-(-count // size), 1)


def meet(left: DataFrame, right: DataFrame, function, schema: str) -> DataFrame:
    """Apply ``function`` to the rows of both tables that share block and group."""
    # both come from the same rows, so the columns of one side are named anew
    apart = right.select(*[F.col(c).alias(c) for c in right.columns])
    return left.groupBy("block", "grp").cogroup(apart.groupBy("block", "grp")).applyInPandas(function, schema)


def grouped(row_index: Column, size: int) -> Column:
    return F.floor(row_index / F.lit(size)).cast("int")
