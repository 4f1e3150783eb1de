import random

import numpy as np

from codefacts.llm import op03_packing as P


def brute(sizes, sources, clusters, capacity):
    """Scan every open bin; the tightest compatible one, the one longest at that residual first."""
    bins, out, clock = [], [], 0
    for size, s, c in zip(sizes, sources, clusters):
        clock += 1
        ok = [(b["free"], b["since"], i) for i, b in enumerate(bins)
              if b["free"] >= size and b["free"] > 0 and (s < 0 or s not in b["s"]) and (c < 0 or c not in b["c"])]
        if ok:
            i = min(ok)[2]
        else:
            i = len(bins)
            bins.append({"free": capacity, "s": set(), "c": set()})
        b = bins[i]
        b["free"] -= size
        b["since"] = clock
        b["s"].add(s)
        b["c"].add(c)
        out.append(i)
    return out


def test_best_fit_against_brute_force():
    rnd = random.Random(6)
    for n, n_src, n_clu in ((0, 1, 1), (1, 1, 1), (300, 3, 200), (600, 150, 500), (500, 20, 8)):
        sizes = sorted((rnd.randrange(1, 100) for _ in range(n)), reverse=True)
        src = [rnd.randrange(-1, n_src) for _ in range(n)]
        clu = [rnd.randrange(-1, n_clu) for _ in range(n)]
        got = P.best_fit(np.array(sizes, np.int64), np.array(src, np.int64), np.array(clu, np.int64), 100)
        assert got.tolist() == brute(sizes, src, clu, 100)


def frame(spark, rows):
    return spark.createDataFrame([(i, t, s, 1, "b") for i, t, s in rows],
                                 "doc_id long, text string, source string, bin int, cluster string")


def test_every_token_once_and_no_conflict(spark):
    rnd = random.Random(1)
    rows = [(i, f"u{i} " + "w " * rnd.choice([0, 3, 20, 55, 230]), rnd.choice(["hot"] * 5 + ["s%d" % i for i in range(12)]))
            for i in range(400)]
    rows += [(1000 + i, "Same Copy words" if i % 2 else "same  copy WORDS", "c%d" % i) for i in range(40)]
    rows += [(7, None, None), (8, "", None), (None, "x", "hot"), (9009, "x " * 5000, "hot"), (10, "z", "s1"), (10, "z", "s1")]
    capacity = 64
    out = P.pack(frame(spark, rows), capacity=capacity, group_rows=100).collect()
    total = sum(len((t or "").split()) + 1 for _, t, _ in rows)
    assert sum(r.n_tokens for r in out) == total
    bins = {}
    for r in out:
        bins.setdefault(r.bin, []).append(r)
    for b in bins.values():
        b.sort(key=lambda r: r.place)
        assert sum(r.n_tokens for r in b) <= capacity
        assert [r.place for r in b] == list(range(len(b)))
        assert [r.bin_offset for r in b] == [sum(x.n_tokens for x in b[:i]) for i in range(len(b))]
        known = [r.source for r in b if r.source is not None]
        assert len(known) == len(set(known))
        assert len({r.cluster for r in b}) == len(b)
    pieces = sorted((r.piece, r.first_token, r.n_tokens) for r in out if r.doc_id == 9009)
    assert len(pieces) == -(-5001 // capacity) and all(f == p * capacity for p, f, _ in pieces)
    assert len({r.cluster for r in out if r.doc_id is not None and 1000 <= r.doc_id < 1040}) == 1


def test_same_result_again_and_empty_table(spark):
    rows = [(i, "w " * (i % 50), "s%d" % (i % 7)) for i in range(200)]
    a, b = (sorted(map(tuple, P.pack(frame(spark, r), 64, 50).collect())) for r in (rows, rows[::-1]))
    assert a == b
    assert P.pack(frame(spark, [])).count() == 0
