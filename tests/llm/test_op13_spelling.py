import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np

from codefacts.llm import op13_spelling as S
from codefacts.llm import queries


def lowered(w):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w)


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(rows):
    counts = Counter()
    for i, t in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = lowered(w)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            counts[w[:h % len(w)] + w[h % len(w) + 1:] if h % 199 == 0 else w] += 1
    n = {w: c for w, c in counts.items() if len(w) >= 6 and c >= 5}
    form, near = {}, {}
    for w in n:
        ns = [v for v in n if abs(len(v) - len(w)) < 2 and one_edit(v, w)]
        near[w] = len(ns)
        top = min(ns, key=lambda v: (-n[v], v), default=None)
        form[w] = top if top and n[top] >= 5 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], near[w], n[form[w]] if form[w] else None))
    return sorted(out)


def run(spark, rows, parts=3, **options):
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, word string, n int").repartition(parts)
    return sorted(tuple(r) for r in S.variants(df, **options).collect())


def corpus(seed, letters="abcé", n=60):
    rnd = random.Random(seed)
    base = ["".join(rnd.choice(letters) for _ in range(rnd.randint(6, 9))) for _ in range(n)]
    words = []
    for w in base:
        words += [w] * rnd.choice([5, 30, 160])
        for _ in range(3):
            i, c = rnd.randrange(len(w)), rnd.choice(letters)
            words += [rnd.choice([w[:i] + w[i + 1:], w[:i] + c + w[i:], w[:i] + c + w[i + 1:]])] * rnd.choice([1, 5, 6])
    rnd.shuffle(words)
    return [(i, " ".join(words[i::40])) for i in range(40)]


def test_against_brute_force(spark):
    for letters in ("abc", "abcdefghijklmnopqrstuvwxyzéèÿ×"):
        rows = corpus(len(letters), letters)
        want = brute(rows)
        assert sum(r[1] is not None for r in want) > 10
        assert run(spark, rows) == want


def test_every_alphabet_finds_its_pairs(spark):
    rows = corpus(5, "abim", 80)       # a and i share a symbol in the first alphabet
    want = brute(rows)
    for crowd in (1, 2, 64):
        assert run(spark, rows, alphabets=(2, 4, 256), crowd=crowd) == want
    assert run(spark, rows, alphabets=(256,), small=0) == want


def test_chain_of_forms(spark):
    chain = ["aaaaaaa", "aaaaaab", "aaaaabb", "aaaabbb"]
    rows = [(i, " ".join(w for w, times in zip(chain, (5, 25, 125, 625)) for _ in range(times // 5))) for i in range(5)]
    got = {r[0]: r for r in run(spark, rows)}
    assert got == {r[0]: r for r in brute(rows)}
    assert got["aaaaaaa"][2] == "aaaabbb" and got["aaaabbb"][1] is None


def test_odd_rows(spark):
    long = "q" * 40000
    rows = [(None, "Straße STRASSE ÀÉÎÕÜý"), (1, None), (2, ""), (3, "×÷×÷×÷ abc1abcdefg_abcdefg")] * 6
    rows += [(7, "ABCDEFG abcdefh"), (7, "ABCDEFG abcdefh")] * 5 + [(8, f"{long} {long}x {long[1:]}y")] * 5
    assert run(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert run(spark, []) == [] and run(spark, [(1, "short words only")]) == []


def test_neighbourhoods_are_whole():
    def strings(r, symbols):
        out = {r[:i] + r[i + 1:] for i in range(len(r))}
        for c in range(1, symbols + 1):
            out |= {r[:i] + (c,) + r[i:] for i in range(len(r) + 1)} | {r[:i] + (c,) + r[i + 1:] for i in range(len(r))}
        return out

    def plain(r):
        return sum(c * pow(int(S.BASE), i, 1 << 64) for i, c in enumerate(r)) % (1 << 64)
    for word in ("a", "banana", "éàz×zzz"):
        for symbols in (2, 8, 256):
            r = tuple(int(x) for x in S.reduced(word, symbols))
            got = set(np.concatenate(list(S.neighbour_keys(word, symbols))).tolist())
            assert got == {plain(x) for x in strings(r, symbols)}
            assert int(S.key(word, symbols)) == plain(r) and plain(r) in got


def test_table_matches_sql(spark):
    d = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{d}/documents.parquet'")
    rel = con.sql(S.ORACLE_SQL)
    got = queries.QUERIES["op13_spelling_variants"](spark, d)
    assert rel.columns == got.columns
    assert sorted(rel.fetchall(), key=str) == sorted(map(tuple, got.collect()), key=str)
