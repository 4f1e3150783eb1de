import hashlib
import random

from pyspark.sql import functions as F

from codefacts.llm import op09_order_minhash as M
from codefacts.sources.tables import table


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", "y", 1) for i, t in rows],
                                 "doc_id long, text string, own string, k string, n_chars int")


def run(spark, rows):
    return sorted(M.edited_likeness(frame(spark, rows)).collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0))


def edits(rows):
    """(doc_id, n_chars, sha of edited text) by the contract; ids must differ."""
    rows = sorted((i, t or "") for i, t in rows)
    out = []
    for j, (i, t) in enumerate(rows):
        nxt, half = rows[(j + 1) % len(rows)][1], len(t) // 2
        out.append((i, len(t), hashlib.sha256((t[:len(t) - half] + nxt[:half]).encode()).hexdigest()))
    return out


def test_whole_table_edits_and_likeness(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = sorted(M.edited_likeness(docs).collect())
    assert [(r.doc_id, r.n_chars, r.edited_sha256) for r in got] == edits(rows)
    near = sum(r.near_edited for r in got) / len(got)
    other = sum(r.near_next for r in got) / len(got)
    assert .25 < near < .6 and other < .1
    by_text = {}
    for r, (_, t) in zip(got, sorted(rows)):
        assert by_text.setdefault(t, r.fingerprint) == r.fingerprint


def brute_occurrences(text, k=5):
    w, seen, out = text.split(), {}, []
    for i in range(max(len(w) - k + 1, min(1, len(w)))):
        g = tuple(w[i:i + k])
        out.append((g, seen.setdefault(g, 0)))
        seen[g] += 1
    return out


def test_tuples_follow_the_definition(spark):
    """Each selected k-mer is the smallest of its strip, numbered by occurrence; tuples keep text order."""
    rnd = random.Random(2)
    texts = [" ".join(rnd.choice("abcdefg") for _ in range(n)) for n in (0, 1, 3, 5, 6, 30, 200, 900)]
    texts += ["a a a a a a a a a a a a", "one line\n" * 40]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.t for r in M.with_tuples(df, {"text": "t"}).withColumn("t", M.labels(F.col("t"))).collect()}
    hashes = {}

    def h64(*sql):
        key = ",".join(sql)
        if key not in hashes:
            hashes[key] = spark.sql(f"SELECT xxhash64({key})").first()[0]
        return hashes[key]

    def batch(exprs):
        todo = [e for e in dict.fromkeys(exprs) if e not in hashes]
        for i in range(0, len(todo), 400):
            row = spark.range(1).selectExpr(*[f"xxhash64({e}) AS c{j}" for j, e in enumerate(todo[i:i + 400])]).first()
            hashes.update(zip(todo[i:i + 400], row))

    def signed32(x):
        return ((x & M.LOW) ^ (1 << 31)) - (1 << 31)
    batch([f"'{w}'" for t in texts for w in t.split()])
    for d, t in enumerate(texts):
        occ = brute_occurrences(t)
        n = len(t.split())
        keys = [",".join(f"{hashes[chr(39) + w + chr(39)]}L" for w in g) if n >= 5 else
                "array(" + ",".join(f"{hashes[chr(39) + w + chr(39)]}L" for w in g) + ")" for g, _ in occ]
        batch(keys)
        numbered = [f"{signed32(hashes[k])}L,{o}" for k, (_, o) in zip(keys, occ)]
        batch(numbered)
        strips = {}
        for pos, e in enumerate(numbered):
            v = (signed32(hashes[e]), pos)
            s = v[0] >> (M.STRIP_SHIFT - 32)
            strips[s] = min(strips.get(s, v), v)
        tuples = {}
        for s, v in strips.items():
            tuples.setdefault(s >> 1, []).append(v)
        want = []
        for p in sorted(tuples):
            e = ",".join(f"{v}L" for v, _ in sorted(tuples[p], key=lambda x: x[1]))
            batch([e])
            want.append(M.DIGITS[p + M.TUPLES // 2] + "%08x" % (hashes[e] & M.LOW))
        assert got[d] == want, d


def test_order_matters(spark):
    rnd = random.Random(4)
    blocks = [" ".join("w%d" % rnd.randrange(10 ** 6) for _ in range(60)) for _ in range(20)]
    texts = [" ".join(blocks), " ".join(reversed(blocks)), " ".join(blocks[:-1] + ["x"])]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    t = {r.doc_id: set(r.t) for r in M.with_tuples(df, {"text": "t"}).collect()}
    assert len(t[0] & t[2]) > 24 and len(t[0] & t[1]) < 24


def test_nulls_repeats_long_and_small_tables(spark):
    rows = [(3, None), (5, ""), (1, "a b c"), (9, "é😀 " * 40_000), (2, "a b c")]
    got = run(spark, rows)
    assert [(r.doc_id, r.n_chars, r.edited_sha256) for r in got] == edits(rows)
    assert got[0].fingerprint == got[1].fingerprint and got[0].near_next == 1.0
    assert [(r.fingerprint, r.near_edited) for r in got if r.doc_id in (3, 5)] == [("", 1.0), ("", 1.0)]
    twice = run(spark, [(1, "x y z"), (1, "x y z"), (2, "p q"), (None, "n"), (2, "other")])
    assert len(twice) == 5 and len({tuple(r) for r in twice if r.doc_id == 1}) == 1
    alone = run(spark, [(7, "just one text")])
    assert alone[0].near_next == 1.0
    assert run(spark, []) == []
