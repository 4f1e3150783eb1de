import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from codefacts.llm import op12_topk as T
from codefacts.llm import queries
from codefacts.llm.vectors import products

SCHEMA = "vec_id long, embedding array<float>, row_index string, rank int"


def brute(rows, every=50, k=5):
    good = {(i, tuple(math.floor(256 * float(np.float32(v))) for v in x)) for i, x in rows
            if i is not None and x is not None and all(v is not None and math.isfinite(v) for v in x)}
    out = []
    for i, x in good:
        if i % every == 0:
            s = sorted((-sum(a * b for a, b in zip(x, z)), j) for j, z in good if j != i and len(z) == len(x))[:k]
            out += [(i, r + 1, j, -n) for r, (n, j) in enumerate(s)]
    return sorted(out)


def run(spark, rows, every=50, parts=4, **options):
    df = spark.createDataFrame([(i, x, "x", 1) for i, x in rows], SCHEMA).repartition(parts)
    return sorted(tuple(r) for r in T.nearest(df, F.col("vec_id") % every == 0, **options).drop("query_row").collect())


def spread(n, dim, seed, longest=4.0):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        scale = math.exp(rnd.uniform(-longest, 0))
        out.append((i, [scale * rnd.gauss(0, 1) for _ in range(dim)]))
    return out


@pytest.mark.parametrize("options", [{}, {"block_queries": 4, "group_rows": 64, "bucket_rows": 16}])
def test_against_brute_force(spark, options):
    for dim, longest in ((3, 4.0), (24, 0.0)):
        rows = spread(500, dim, dim, longest)
        assert run(spark, rows, 10, **options) == brute(rows, 10)


def test_both_prunings_run_and_lose_nothing():
    rnd = np.random.default_rng(1)
    centres = rnd.normal(size=(6, 64))
    rows = np.floor(64 * (centres[rnd.integers(0, 6, 4000)] + 0.4 * rnd.normal(size=(4000, 64))))
    rows = rows[np.argsort(-(rows ** 2).sum(axis=1))]
    used = {"coordinates": 0, "length": 0, "rows": 0}

    class Counted(T.Bucket):
        def by_coordinates(self, q, norm, bound):
            left = super().by_coordinates(q, norm, bound)
            used["coordinates"] += 1
            used["rows"] += len(left)
            return left

        def by_length(self, q, norm, bound):
            used["length"] += len(q) > 0
            return super().by_length(q, norm, bound)
    plain = T.Bucket
    T.Bucket = Counted
    try:
        b = T.search(np.arange(0, 4000, 20), rows[::20], np.full(200, T.LOW), np.arange(4000), rows, 5, 256)
    finally:
        T.Bucket = plain
    s = products(rows[::20], rows)
    for i in range(200):
        want = sorted((-int(v), j) for j, v in enumerate(s[i]) if j != 20 * i)[:5]
        assert sorted(zip(-b.score[b.key == i], b.id[b.key == i])) == want
    assert used["coordinates"] > 1000 and used["length"] >= 1
    assert used["rows"] < 0.25 * used["coordinates"] * 256


def test_ties_and_copies(spark):
    rnd = random.Random(3)
    rows = [(i, [0.5, 0.25] if i % 3 else [rnd.choice([0.0, 1.0]), 0.5]) for i in range(240)]
    assert run(spark, rows, 20) == brute(rows, 20)
    assert run(spark, rows, 20, block_queries=2, group_rows=20, bucket_rows=7) == brute(rows, 20)


def test_odd_rows(spark):
    rows = [(0, [1.0, 1.0]), (0, [1.0, 1.0]), (50, None), (100, [None, 1.0]), (150, [float("nan"), 0.0]),
            (200, [float("inf"), 0.0]), (None, [1.0, 2.0]), (250, [0.0, 0.0]), (300, [-1.0, -1.0]), (1, [1.0]),
            (350, [2.0]), (400, []), (450, []), (2, [0.3, 0.4]), (2, [0.3, 0.4]), (2, [0.4, 0.3]), (3, [-5.0, 1.0])]
    assert run(spark, rows) == brute(rows)
    assert run(spark, rows, block_queries=1, group_rows=2, bucket_rows=1) == brute(rows)


def test_negative_and_large_products(spark):
    rows = [(i, [-1.0 - i / 50, 0.25]) if i % 50 else (i, [1.0, 0.0]) for i in range(200)]
    assert run(spark, rows, group_rows=16, bucket_rows=4) == brute(rows)
    big = [(i, [1e6 + i, float(i % 7), -1e5 * (i % 3)]) for i in range(120)]
    assert run(spark, big, group_rows=16, bucket_rows=4) == brute(big)
    huge = [(0, [1e20, 1.0]), (1, [1e20, 0.0]), (2, [-1e20, 0.0]), (3, [1e-3, 9.0])]
    assert [r[2:] for r in run(spark, huge)][0] == (1, (1 << 63) - 1)


def test_products_in_integers():
    a = np.array([[2.0 ** 40, 3.0], [1.0, 2.0]])
    b = np.array([[5.0, 7.0], [2.0 ** 20, 1.0]])
    assert products(a, b).tolist() == [[5 * 2 ** 40 + 21, 2 ** 60 + 3], [19, 2 ** 20 + 2]]


def test_empty_tables(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, [1.0])]) == []
    assert run(spark, [(50, [1.0])]) == []


def test_table_matches_sql(spark):
    d = "/root/testdata/sf0.1"
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{d}/embeddings.parquet'")
    rel = con.sql(T.ORACLE_SQL)
    got = queries.QUERIES["op12_exact_topk"](spark, d)
    assert rel.columns == got.columns
    assert sorted(rel.fetchall()) == sorted(map(tuple, got.collect()))
