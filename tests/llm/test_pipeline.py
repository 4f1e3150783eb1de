import re

import corpus_pipeline as C
from codefacts.llm import op03_packing, op06_quality
from codefacts.sources.tables import table

from .test_op04_simhash import brute_components, brute_fp
from .test_op05_line_dedup import oracle
from .test_op08_decontamination import brute as brute_items

SF = "/root/testdata/sf0.001"


def test_stages():
    assert [n for n, _ in C.STAGES] == ["quality_classifier", "line_dedup", "simhash_near_dedup",
                                        "benchmark_decontamination", "best_fit_packing"]


def test_each_stage_against_brute_force_on_its_own_input(spark, tmp_path):
    docs = table(spark, SF, "documents")
    names, kinds, seen = docs.columns, docs.dtypes, {}
    for name, stage in C.STAGES:
        out = stage(spark, docs, SF)
        out.write.parquet(f"{tmp_path}/{name}")
        out = spark.read.parquet(f"{tmp_path}/{name}")
        seen[name] = (docs.collect(), out.collect())
        if name != "best_fit_packing":
            assert out.columns == names and out.dtypes == kinds
        docs = out

    before, after = seen["quality_classifier"]
    model = op06_quality.train(table(spark, SF, "documents"), table(spark, SF, "labels"))
    good = {r.doc_id for r in op06_quality.score(table(spark, SF, "documents"), model).where("score >= .5").collect()}
    assert {r.doc_id for r in after} == good and 0 < len(after) < len(before)

    before, after = seen["line_dedup"]
    assert sorted((r.doc_id, r.text) for r in after) == [x[:2] for x in oracle([(r.doc_id, r.text) for r in before])]
    assert all(r.n_chars == len(r.text) for r in after)

    before, after = seen["simhash_near_dedup"]
    fp = {r.doc_id: brute_fp(r.text) for r in before}
    comp, first = brute_components(list(fp.values())), {}
    for i in sorted(fp):
        first.setdefault(comp[fp[i]], i)
    assert sorted(r.doc_id for r in after) == sorted(first.values())

    before, after = seen["benchmark_decontamination"]
    items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    bad = {i for i, _ in brute_items([(r.doc_id, r.text) for r in before], items)}
    assert sorted(r.doc_id for r in after) == sorted(r.doc_id for r in before if r.doc_id not in bad)

    before, after = seen["best_fit_packing"]
    words = {r.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) + 1 for r in before}
    placed = {}
    for r in after:
        placed[r.doc_id] = placed.get(r.doc_id, 0) + r.n_tokens
    assert placed == words


def test_run_equals_the_stages(spark):
    docs = table(spark, SF, "documents")
    for _, stage in C.STAGES:
        docs = stage(spark, docs, SF)
    assert sorted(map(tuple, C.run(spark, SF).collect())) == sorted(map(tuple, docs.collect()))


def test_odd_rows(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, row int, score string, k int"
    words = " ".join("w%d" % i for i in range(60))
    rows = [(1, words, "en", "a", 1, 1, "s", 2), (1, words, "en", "a", 1, 1, "s", 2), (2, words, "en", None, 1, 1, "s", 2),
            (3, None, None, None, None, None, None, None), (None, "lone row " * 9, "en", "a", 0, 0, "", 0),
            (4, "", "en", "b", 0, 0, "", 0)]
    docs = spark.createDataFrame(rows, schema)
    for name, stage in C.STAGES[1:4]:
        docs = stage(spark, docs, SF)
        assert docs.columns == [c.split()[0] for c in schema.split(", ")]
    kept = docs.collect()
    assert sorted(r.doc_id for r in kept if r.doc_id) == [1, 2]     # 2 is empty now, and first of the empty ones
    assert next(r.text for r in kept if r.doc_id == 1) == words
    assert op03_packing.pack(docs).count() == len(kept)
    empty = spark.createDataFrame([], schema)
    for name, stage in C.STAGES:
        assert stage(spark, empty, SF).count() == 0


def test_near_dedup_keeps_one_row_of_each_component(spark):
    def words(tag, n=60):
        return " ".join(f"{tag}{i}" for i in range(n))
    big = 2 ** 60 + 1
    rows = [(None, words("a")), (None, words("b")), (None, words("b")), (None, words("c")), (5, words("c")),
            (7, words("d")), (7, words("e")), (7, words("e")), (8, words("e")), (9, words("f")), (9, words("c")),
            (big, words("g")), (None, None), (None, ""), (None, None)]
    docs = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "doc_id long, text string, n int")
    out = dict(C.STAGES)["simhash_near_dedup"](spark, docs, SF)
    assert out.columns == docs.columns
    got = [(r.doc_id, r.text or "") for r in out.collect()]
    want = [(None, words("a")), (None, words("b")), (5, words("c")), (7, words("d")), (7, words("e")),
            (9, words("f")), (big, words("g")), (None, "")]
    assert sorted(got, key=str) == sorted(want, key=str)
