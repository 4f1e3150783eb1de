"""Conflict-constrained best-fit packing into sequences of fixed length.

A document's length is its number of words plus one end mark. Documents longer
than ``capacity`` are cut into full sequences and a rest; full sequences are
bins of their own. The rests are dealt by hash into groups of about
``group_rows`` documents, and each group is packed by best-fit decreasing: open
bins are kept in the order of their residual space and carry a bitmap of their
sources and one of their duplicate clusters; the search starts at the first
residual that is large enough (the successor) and goes on until it meets a bin
without the document's source and cluster, which is the tightest compatible
one. If there is none, a bin is opened.

So no bin holds two documents of one source, nor two copies of one text
(cluster: equal words without regard to case). A group is bounded whatever the
sources and clusters are, and a hot source or cluster is spread evenly over all
groups by the hash.

Defined results: a null text is empty; an empty text has length 1; a null
source conflicts with none; a null ``doc_id`` is allowed; repeated rows are
copies of each other; ties in length are packed in the order of ``doc_id``;
other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from codefacts.llm.common import pin

BLOCK = 128


def _bits(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Word index and bit of each code (-1: no bit), and the number of words."""
    word = np.where(codes >= 0, codes >> 6, 0)
    bit = np.where(codes >= 0, np.uint64(1) << (codes & 63).astype(np.uint64), np.uint64(0))
    return word, bit, int(codes.max(initial=0) >> 6) + 1


def best_fit(sizes: np.ndarray, sources: np.ndarray, clusters: np.ndarray, capacity: int) -> np.ndarray:
    """Bin of each piece, pieces taken in the given order. ``sources`` and
    ``clusters`` are codes from 0, -1 for none."""
    n = len(sizes)
    s_word, s_bit, s_words = _bits(sources)
    c_word, c_bit, c_words = _bits(clusters)
    s_map, c_map = np.zeros((s_words, n), np.uint64), np.zeros((c_words, n), np.uint64)
    free, order = np.empty(n + 1, np.int64), np.empty(n + 1, np.int64)   # by residual
    out, m, bins = np.empty(n, np.int64), 0, 0
    for i in range(n):
        size, at, found = sizes[i], int(np.searchsorted(free[:m], sizes[i])), -1
        while at < m:
            ids = order[at:min(at + BLOCK, m)]
            fits = ((s_map[s_word[i], ids] & s_bit[i]) | (c_map[c_word[i], ids] & c_bit[i])) == 0
            j = int(fits.argmax())
            if fits[j]:
                found = at + j
                break
            at += BLOCK
        if found < 0:
            b, left = bins, capacity - size
            bins += 1
        else:
            b, left = order[found], free[found] - size
            free[found:m - 1], order[found:m - 1] = free[found + 1:m].copy(), order[found + 1:m].copy()
            m -= 1
        s_map[s_word[i], b] |= s_bit[i]
        c_map[c_word[i], b] |= c_bit[i]
        if left > 0:                                                # full bins are closed
            to = int(np.searchsorted(free[:m], left, side="right"))
            free[to + 1:m + 1], order[to + 1:m + 1] = free[to:m].copy(), order[to:m].copy()
            free[to], order[to] = left, b
            m += 1
        out[i] = b
    return out


def _codes(values: pd.Series, only_repeated: bool) -> np.ndarray:
    """Codes of values, -1 for nulls and, if asked, for values that occur once."""
    if only_repeated:
        values = values.where(values.duplicated(keep=False))
    return pd.factorize(values)[0].astype(np.int64)


def _pack_group(capacity: int, whole_ids: bool):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        if whole_ids:       # nullable longs, so that no id turns into a double beside a null
            rows["doc_id"] = pd.array([None if i is None else int(i) for i in rows["doc_id"]], dtype="Int64")
        rows = rows.sort_values(["rest", "doc_id", "cluster"], ascending=[False, True, True], kind="stable",
                                na_position="first", ignore_index=True)
        part = rows["rest"].to_numpy() > 0
        tail = rows[part]
        bins = best_fit(tail["rest"].to_numpy(np.int64), _codes(tail["source"], False),
                        _codes(tail["cluster"], True), capacity)
        n_tail = int(bins.max(initial=-1)) + 1
        full = rows["n_full"].to_numpy(np.int64)
        whole = rows.loc[np.repeat(rows.index, full)]
        piece = np.concatenate([np.arange(k) for k in full]) if full.sum() else np.zeros(0, np.int64)
        out = pd.concat([
            pd.DataFrame({"doc_id": tail["doc_id"], "source": tail["source"], "cluster": tail["cluster"],
                          "piece": tail["n_full"], "n_tokens": tail["rest"], "bin": bins}),
            pd.DataFrame({"doc_id": whole["doc_id"], "source": whole["source"], "cluster": whole["cluster"],
                          "piece": piece, "n_tokens": capacity, "bin": n_tail + np.arange(len(whole))}),
        ], ignore_index=True)
        out["first_token"] = out["piece"] * capacity
        out["place"] = out.groupby("bin").cumcount()
        out["bin_offset"] = out.groupby("bin")["n_tokens"].cumsum() - out["n_tokens"]
        out["bin"] += rows["pack_group"].iloc[0] << 32
        return out[["doc_id", "source", "cluster", "piece", "first_token", "n_tokens", "bin", "place", "bin_offset"]]
    return run


def lengths(docs: DataFrame) -> DataFrame:
    """``doc_id, source, n_tokens, cluster`` per row of ``docs``."""
    words = F.filter(F.split(F.lower(F.coalesce("text", F.lit(""))), r"[\x20\x09-\x0D]++"), lambda w: w != "")
    return (docs.select("doc_id", "source", words.alias("w"))
            .select("doc_id", "source", (F.size("w") + 1).cast("long").alias("n_tokens"),
                    F.xxhash64("w", F.size("w")).alias("cluster")))


def pack(docs: DataFrame, capacity: int = 2048, group_rows: int = 4096) -> DataFrame:
    """One row per piece: ``doc_id, source, cluster, piece, first_token, n_tokens,
    bin, place, bin_offset``. ``bin`` is the group's number times 2**32 plus the
    bin's number in the group."""
    rows = pin(lengths(docs).withColumn("k", F.xxhash64("doc_id", "cluster")))
    groups = max(1, -(-rows.count() // group_rows))
    # rows with one id and one text are dealt over all groups by their place in the written rows
    repeated = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("k", F.lit(True).alias("again"))
    placed = rows.withColumn("row", F.monotonically_increasing_id()).join(repeated, "k", "left")
    salt = F.when(F.col("again"), F.xxhash64("k", "row")).otherwise(F.col("k"))
    kind = docs.schema["doc_id"].dataType
    pieces = placed.select(
        F.col("doc_id").cast("string"), "source", "cluster",
        F.expr(f"n_tokens div {capacity}").alias("n_full"), (F.col("n_tokens") % capacity).alias("rest"),
        F.pmod(salt, F.lit(groups)).alias("pack_group"))
    whole_ids = isinstance(kind, IntegralType)
    return pieces.groupBy("pack_group").applyInPandas(
        _pack_group(capacity, whole_ids), f"doc_id {kind.simpleString()}, source string, cluster long, piece long, first_token long, "
                               "n_tokens long, bin long, place long, bin_offset long")
