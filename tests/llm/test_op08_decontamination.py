import random
import re
from collections import Counter

import pytest

from codefacts.llm import op08_decontamination as D
from codefacts.sources.tables import table


def words(t):
    return re.findall(r"[^\W_]+", (t or "").lower())


def grams(w):
    k = min(5, len(w))
    return Counter(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if w else Counter()


def brute(docs, items, similarity=.8):
    """Best similarity over all windows of an item's size, for all pairs."""
    out = {}
    for i, t in docs:
        w = words(t)
        for j, it in items:
            q = words(it)
            if not q or not w:
                continue
            g, best = grams(q), 0
            if not set(g) & set(tuple(w[p:p + min(5, len(q))]) for p in range(len(w))):
                continue
            for p in range(max(1, len(w) - len(q) + 1)):
                x = grams(w[p:p + len(q)])
                both = sum((g & x).values())
                best = max(best, both / (sum(g.values()) + sum(x.values()) - both))
            if best >= similarity:
                out[i, j] = best
    return out


def got(spark, docs, items, **kw):
    d = spark.createDataFrame([(i, t, 1, "z") for i, t in docs], "doc_id long, text string, k int, start string")
    b = spark.createDataFrame([(i, t, 2) for i, t in items], "item_id long, text string, sh int")
    rows = D.contaminated(d, b, **kw).collect()
    assert len({(r.doc_id, r.item_id) for r in rows}) == len(rows)
    return {(r.doc_id, r.item_id): r.similarity for r in rows}


def test_whole_tables_against_brute_force(spark):
    for sf in ("sf0.001", "sf0.01"):
        docs, items = (table(spark, f"/root/testdata/{sf}", t) for t in ("documents", "benchmark"))
        want = brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()],
                     [(r.item_id, r.text) for r in items.collect()])
        have = {(r.doc_id, r.item_id): r.similarity for r in D.contaminated(docs, items).collect()}
        assert want and have == pytest.approx(want)


def planted():
    rnd = random.Random(8)
    w = lambda n: " ".join("w%d" % rnd.randrange(3000) for _ in range(n))
    items = [(i, w(rnd.choice([1, 3, 4, 5, 9, 30, 60, 200]))) for i in range(40)]
    items += [(100, None), (101, ""), (102, "the the the the the the the"), (103, items[5][1]), (5, items[5][1])]
    docs = []
    for i in range(160):
        q = words(rnd.choice(items)[1])
        if q and rnd.random() < .7:
            for _ in range(rnd.randrange(4)):
                q[rnd.randrange(len(q))] = "edit"
        docs.append((i, f"{w(40)}. {', '.join(q).upper()}! {w(30)}"))
    docs += [(900, None), (901, ""), (902, "the " * 3000), (903, items[6][1]), (903, items[6][1]), (904, "w1")]
    return docs, items


def test_edits_short_items_and_repeats(spark):
    docs, items = planted()
    want = brute(docs, items)
    assert len({j for _, j in want}) > 25
    assert got(spark, docs, items) == pytest.approx(want)
    assert got(spark, docs, items, broadcast_rows=0) == pytest.approx(want)


def test_moved_parts_of_an_item_are_found(spark):
    rnd = random.Random(9)
    w = lambda n: ["w%d" % rnd.randrange(5000) for _ in range(n)]
    items = [w(n) for n in (60, 120, 121, 300)]
    docs = []
    for q in items:
        for cut in (len(q) // 2, len(q) // 3, len(q) - 20):
            docs.append((len(docs), " ".join(w(50) + q[cut:] + q[:cut] + w(50))))
    docs.append((len(docs), " ".join(items[1][60:] + items[1][:60])))
    items = [(j, " ".join(q)) for j, q in enumerate(items)]
    want = brute(docs, items)
    assert len(want) == len(docs) and max(want.values()) < .98
    assert got(spark, docs, items) == pytest.approx(want)


def test_documents_of_one_repeated_passage(spark):
    item = " ".join("v%d" % i for i in range(40))
    docs = [(1, (item + " ") * 50), (2, " ".join(item.split()[:37])), (3, " ".join(item.split()[:30])), (4, "v1 v2 v3 v4 v5")]
    want = brute(docs, [(7, item)])
    assert set(want) == {(1, 7), (2, 7)}
    assert got(spark, docs, [(7, item)]) == pytest.approx(want)


def test_removal_keeps_rows_and_columns(spark):
    docs, items = planted()
    d = spark.createDataFrame([(i, t, "c") for i, t in docs] + [(None, None, "c")], "doc_id long, text string, row string")
    b = spark.createDataFrame(items, "item_id long, text string")
    bad = {i for i, _ in brute(docs, items)}
    left = D.remove_contaminated(d, b)
    assert left.columns == d.columns
    assert sorted(r.doc_id for r in left.collect() if r.doc_id is not None) == sorted(i for i, _ in docs if i not in bad)


def test_empty_tables(spark):
    assert got(spark, [], [(1, "a b c d e f")]) == {}
    assert got(spark, [(1, "a b c d e f")], []) == {}
    assert got(spark, [(1, "a b c d e f")], [(1, " ")]) == {}
