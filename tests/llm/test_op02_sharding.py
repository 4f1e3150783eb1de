import zlib

import duckdb

from codefacts.llm.op02_sharding import ORACLE_SQL, shard_documents
from codefacts.sources.tables import table

SCHEMA = "doc_id long, text string, shard string, size int, total int"


def brute(rows, n):
    def size(t):
        return len((t or "").encode()) + 16

    def crc(t):
        return zlib.crc32((t or "").encode())
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, crc(r[1]), size(r[1])))
    total, run, out, slots = sum(size(t) for _, t in rows), 0, [], {}
    for i, t in order:
        s = min(n - 1, (2 * run + size(t)) * n // (2 * total))
        run += size(t)
        out.append((i, size(t), crc(t), "bytes", s, slots.setdefault(s, 0), None))
        slots[s] += 1
    return sorted(out, key=str)


def run(spark, rows, n=40, parts=None):
    df = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in rows], SCHEMA)
    return sorted((tuple(r) for r in shard_documents(df, n, partitions=parts).collect()), key=str)


def test_against_brute_force(spark):
    rows = [(i * 7 % 501, "wé " * (i % 37)) for i in range(500)]
    rows += [(3, "long " * 4000), (None, "a"), (None, None), (9, None), (9, ""), (9, "twice"), (9, "twice")]
    for parts in (None, 1, 5):
        assert run(spark, rows, parts=parts) == brute(rows, 40)


def test_shards_are_even(spark):
    rows = [(i, "x" * (i * 13 % 97)) for i in range(4000)]
    sizes = {}
    for r in run(spark, rows):
        sizes[r[4]] = sizes.get(r[4], 0) + r[1]
    assert len(sizes) == 40 and max(sizes.values()) - min(sizes.values()) <= 2 * (97 + 16)


def test_few_and_no_rows(spark):
    assert run(spark, [(1, "a"), (2, "b")]) == brute([(1, "a"), (2, "b")], 40)
    assert run(spark, []) == []


def test_table_matches_sql(spark):
    con = duckdb.connect()
    con.sql("CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf0.001/documents.parquet'")
    rel = con.sql(ORACLE_SQL)
    got = shard_documents(table(spark, "/root/testdata/sf0.001", "documents"))
    assert rel.columns == got.columns
    assert sorted(rel.fetchall(), key=str) == sorted(map(tuple, got.collect()), key=str)
