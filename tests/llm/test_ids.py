"""Ids above 2**53 beside a null id come back as they are."""

from codefacts.llm import op01_html, op03_packing, op04_simhash, op06_quality

BIG = [(1 << 53) + 1, (1 << 53) + 3, None]


def docs(spark):
    rows = [(i, f"some quite ordinary words of text {n} " * (n + 1), "s", (1 << 60) + 1 if i else None)
            for n, i in enumerate(BIG)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, extra long").coalesce(1)


def ids(rows, name="doc_id"):
    return sorted((r[name] for r in rows), key=str)


WANT = sorted(BIG, key=str)


def test_html(spark):
    pages = spark.createDataFrame([(i, "u", "<p>é text of a page</p>") for i in BIG], "page_id long, url string, html string")
    got = op01_html.extract(pages.coalesce(1)).collect()
    assert ids(got, "page_id") == WANT and {r.n_chars for r in got} == {len(r.text) for r in got}


def test_packing(spark):
    assert ids(op03_packing.pack(docs(spark)).collect()) == WANT


def test_packing_deals_out_repeated_rows(spark):
    same = spark.range(600).selectExpr("cast(null as long) doc_id", "'one text' text", "'s' source")
    out = op03_packing.pack(same, capacity=64, group_rows=50).collect()
    assert len(out) == 600 and len({r.bin for r in out}) == 600
    sizes = {}
    for r in out:
        sizes[r.bin >> 32] = sizes.get(r.bin >> 32, 0) + 1
    assert len(sizes) == 12 and max(sizes.values()) < 100


def test_simhash(spark):
    got = op04_simhash.simhash_components(docs(spark)).collect()
    assert ids(got) == WANT
    assert {r.component_id for r in got} <= set(BIG)
    assert {r.doc_id for r in op04_simhash.first_of_components(docs(spark)).collect()} <= set(BIG)


def test_quality(spark):
    labels = spark.createDataFrame([(BIG[0], 1), (BIG[1], 0)], "doc_id long, quality int")
    got = op06_quality.classify(docs(spark), labels).collect()
    assert ids(got) == WANT
    model = op06_quality.train(docs(spark), labels)
    kept = op06_quality._scored(docs(spark), model).collect()
    assert ids(kept) == WANT and {r.extra for r in kept} == {(1 << 60) + 1, None}


def test_training_does_not_depend_on_the_order_of_rows(spark):
    rows = [(n // 2, f"text {n} of some sort " * (n % 9 + 1)) for n in range(60)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(30)], "doc_id long, quality int")
    one, two = (op06_quality.train(spark.createDataFrame(part, "doc_id long, text string").repartition(3), labels)
                for part in (rows, rows[::-1]))
    assert all((one[k] == two[k]).all() for k in one)
