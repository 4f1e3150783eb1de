import random
from itertools import combinations

import pytest
import xxhash

from codefacts.llm import op04_simhash as S


def brute_fp(text, k=4):
    words, cur = [], ""
    for ch in text or "":
        if ch in " \t\n\x0b\x0c\r":
            if cur:
                words.append(cur)
            cur = ""
        else:
            cur += ch.lower() if "A" <= ch <= "Z" else ch
    if cur:
        words.append(cur)
    if not words:
        return 0
    grams = [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)]
    hs = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(fps, bits=4):
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in combinations(sorted(set(fps)), 2):
        if bin(a ^ b).count("1") <= bits:
            ra, rb = find(a), find(b)
            root[max(ra, rb)] = min(ra, rb)
    return {f: find(f) for f in fps}


def test_triples_cover_every_four_positions():
    t = S.position_triples()
    assert len(t) == len(set(t)) == 20
    assert all(any(set(x) <= set(c) for x in t) for c in combinations(range(8), 4))


@pytest.mark.parametrize("text", ["", None, "  \t\n", "One", "a b c", "A bÉ c d", "x " * 9,
                                  "nul\x00 a b c\x1fd e f", "the cat sat on the mat " * 40])
def test_fingerprint_matches_the_definition(text):
    assert S.fingerprint(text) == brute_fp(text)


def docs_frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "x", 7) for i, t in rows],
                                 "doc_id long, text string, lang string, fp string, root long")


def run(spark, rows, **kw):
    got = S.simhash_components(docs_frame(spark, rows), **kw).collect()
    return sorted((r.doc_id if r.doc_id is not None else -1, r.fingerprint, r.component_id) for r in got)


def test_components_against_brute_force(spark):
    rnd = random.Random(5)
    words = ["w%d" % i for i in range(400)]
    base = [" ".join(rnd.choice(words) for _ in range(150)) for _ in range(12)]
    rows = []
    for n in range(90):
        w = rnd.choice(base).split()
        if rnd.random() < .7:
            w[rnd.randrange(len(w))] = "edit%d" % n
        rows.append((500 - n, " ".join(w)))
    rows += [(1000, None), (1001, ""), (1002, "\n"), (1003, "short one"), (1003, "short one"), (None, "short one")]
    fp = {t: brute_fp(t) for _, t in rows}
    comp = brute_components(list(fp.values()))
    low = {}
    for i, t in rows:
        if i is not None:
            low[comp[fp[t]]] = min(low.get(comp[fp[t]], i), i)
    want = sorted((-1 if i is None else i, "%016x" % fp[t], low[comp[fp[t]]]) for i, t in rows)
    assert run(spark, rows) == want


@pytest.mark.parametrize("bits", [3, 4])
def test_long_posting_lists_give_the_same_components(spark, bits):
    rnd = random.Random(9)
    centres = [rnd.getrandbits(64) for _ in range(3)]
    fps = {c ^ sum(1 << b for b in rnd.sample(range(24), rnd.randrange(6))) for c in centres for _ in range(60)}
    df = spark.createDataFrame([(S._signed(f),) for f in fps], "fp long")
    mask = (1 << 64) - 1

    def comps(limit):
        from codefacts.llm.common import components
        stars = components(S.fingerprint_links(df, bits, limit)).collect()
        groups = {}
        for r in stars:
            groups.setdefault(r.root, set()).add(r.node & mask)
        return sorted(map(sorted, groups.values()))
    want = {}
    for f, r in brute_components(list(fps), bits).items():
        want.setdefault(r, set()).add(f)
    want = sorted(sorted(g) for g in want.values() if len(g) > 1)
    assert comps(2000) == want
    assert comps(2) == want


def test_chain_of_links_and_empty_table(spark):
    from codefacts.llm.common import components
    e = spark.createDataFrame([(i + 1, i) for i in range(70)] + [(200, 100), (5, 5)], "u long, v long")
    got = {r.node: r.root for r in components(e).collect()}
    assert got == {i: 0 for i in range(71)} | {200: 100, 100: 100}
    assert run(spark, []) == []
