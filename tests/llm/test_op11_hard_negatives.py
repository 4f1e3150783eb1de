import math
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from codefacts.llm import op11_hard_negatives as H
from codefacts.llm import queries
from codefacts.sources.tables import table

SCHEMA = "vec_id long, embedding array<float>, label int, dim string, slot int"


def floats(x):
    import numpy as np
    return [None if v is None else float(np.float32(v)) for v in x]


def brute(rows, every=100, n_positives=5, k=5):
    good = {(i, tuple(math.floor(256 * v) for v in floats(x)), y) for i, x, y in rows
            if i is not None and x is not None and y is not None and all(v is not None and math.isfinite(v) for v in x)}
    out = []
    for i, x, y in good:
        if i % every:
            continue
        scored = [(-sum(a * b for a, b in zip(x, z)), j, w) for j, z, w in good if j != i and len(z) == len(x)]
        for p, j, _ in sorted(s for s in scored if s[2] == y)[:n_positives]:
            hits = sorted((n, m) for n, m, w in scored if w != y and 80 * -p <= 100 * -n <= 100 * -p)[:k]
            out += [(i, j, r + 1, m, -p, -n) for r, (n, m) in enumerate(hits)]
    return sorted(out)


def run(spark, rows, every=100, parts=4, **options):
    df = spark.createDataFrame([(i, x, y, "x", 1) for i, x, y in rows], SCHEMA).repartition(parts)
    return sorted(tuple(r) for r in H.mine(df, F.col("vec_id") % every == 0, **options).drop("anchor_row").collect())


def clustered(n, dim, labels, seed):
    rnd = random.Random(seed)
    centres = [[rnd.gauss(0, 1) for _ in range(dim)] for _ in range(labels)]
    return [(i, [c + rnd.gauss(0, 1) for c in centres[rnd.randrange(labels)]], rnd.randrange(labels)) for i in range(n)]


@pytest.mark.parametrize("block,group", [(2048, 16384), (3, 17)])
def test_against_brute_force(spark, block, group):
    rows = clustered(400, 6, 3, 1)
    want = brute(rows, 10)
    assert len(want) > 100
    assert run(spark, rows, 10, block_anchors=block, group_rows=group) == want


def test_hot_label_and_ties(spark):
    rnd = random.Random(2)
    # few different vectors, so scores tie; one label holds most rows
    rows = [(i, [rnd.choice([0.5, 1.0]), rnd.choice([0.0, 1.0])], 0 if i % 3 else rnd.randrange(4)) for i in range(300)]
    assert run(spark, rows, 20, block_anchors=2, group_rows=16) == brute(rows, 20)


def test_odd_rows(spark):
    rows = [(0, [1.0, 1.0], 1), (1, [1.0, 0.9], 1), (2, [0.9, 0.9], 2), (3, [0.85, 1.0], None), (4, None, 2),
            (5, [float("nan"), 1.0], 2), (6, [float("inf"), 1.0], 2), (7, [None, 1.0], 2), (None, [1.0, 0.8], 2),
            (8, [1.0], 2), (9, [], 2), (2, [0.9, 0.9], 2), (2, [0.95, 0.8], 2), (0, [1.0, 1.0], 1), (100, [-1.0, -1.0], 1),
            (200, [0.0, 0.0], 3), (201, [0.0, 0.0], 3), (300, [], 2), (301, [], 1), (302, [], 2)]
    assert run(spark, rows) == brute(rows)
    assert run(spark, rows, block_anchors=1, group_rows=2) == brute(rows)


def test_large_components_stay_exact(spark):
    rows = [(i, [3e12 + i, -1e12 * i, 1.0], i % 2) for i in range(6)] + [(i, [5.0, 1.0, float(i)], i % 3) for i in range(6, 30)]
    want = [r for r in brute(rows, 5) if max(map(abs, r)) < 1 << 63]
    got = [r for r in run(spark, rows, 5, group_rows=7) if max(map(abs, r)) < (1 << 63) - 1]
    assert set(got) >= set(want) and want


def test_empty_tables(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, [1.0], 1), (2, [1.0], 2)]) == []


def test_table_matches_sql(spark):
    d = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{d}/embeddings.parquet'")
    rel = con.sql(H.ORACLE_SQL)
    got = queries.QUERIES["op11_hard_negatives"](spark, d)
    assert rel.columns == got.columns
    assert sorted(rel.fetchall()) == sorted(map(tuple, got.collect()))
    assert table(spark, d, "embeddings").count() == 500
