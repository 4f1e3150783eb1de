import zlib

import numpy as np
import pytest

from codefacts.llm import op06_quality as Q
from codefacts.sources.tables import table

SF = "/root/testdata/sf0.1"


def test_gradients_against_differences():
    r = np.random.default_rng(1)
    sizes = np.array([1, 3, 2])
    x = r.normal(size=(6, Q.WIDTH))
    m = {"mean": np.zeros(Q.WIDTH), "std": np.ones(Q.WIDTH), "V": r.normal(size=(Q.WIDTH, 3)) / 5,
         "U": r.normal(size=(Q.WIDTH, 3)) / 5, "w": r.normal(size=3), "E": r.normal(size=(Q.WIDTH, 3)) / 5,
         "e0": r.normal(size=3), "c": r.normal(size=3), "c0": np.array(.2)}
    y = np.array([1.0, 0.0, 1.0])

    def loss():
        p = Q.forward(m, x, sizes)["p"]
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()
    grads = Q.gradients(m, x, sizes, y)
    for k in Q.LEARNED:
        m[k] = np.array(m[k], dtype=float)
        flat = m[k].reshape(-1)
        for i in range(0, flat.size, max(1, flat.size // 5)):
            old = flat[i]
            flat[i] = old + 1e-6
            up = loss()
            flat[i] = old - 1e-6
            down = loss()
            flat[i] = old
            assert np.reshape(grads[k], -1)[i] == pytest.approx((up - down) / 2e-6, abs=1e-6)


def test_attention_sums_to_one_and_bags_do_not_mix():
    r = np.random.default_rng(0)
    bags = [r.normal(size=(n, Q.WIDTH)).astype(np.float32) for n in (2, 1, 4)]
    m = Q.fit(bags, [0, 1, 0], steps=5)
    f = Q.forward(m, np.concatenate(bags), np.array([2, 1, 4]))
    assert np.add.reduceat(f["a"], f["starts"]) == pytest.approx(np.ones(3), abs=1e-5)
    alone = [Q.forward(m, b, np.array([len(b)]))["p"][0] for b in bags]
    assert f["p"] == pytest.approx(alone, abs=1e-5)


@pytest.mark.parametrize("text", [None, "", " ", "x", "word " * 500_000, "\x00 😀"])
def test_whole_texts_are_encoded(text):
    x = Q.encode(text)
    assert x.shape == (max(1, -(-len((text or "").split()) // Q.PASSAGE)), Q.WIDTH) and np.isfinite(x).all()


@pytest.fixture(scope="module")
def scored(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    return (Q.classify(docs, labels, max_documents=1500).join(labels, "doc_id", "left").toPandas())


def test_held_out_accuracy(scored):
    assert len(scored) == 10_000 and scored.score.between(0, 1).all()
    assert (scored.held_out == [zlib.crc32(str(i).encode()) % 3 == 1 for i in scored.doc_id]).all()
    assert ((scored.score >= .5).astype(int) == scored.predicted).all()
    own = scored[scored.held_out & scored.quality.notna()]
    good, bad = own[own.quality == 1].score.to_numpy(), own[own.quality == 0].score.to_numpy()
    assert (good[:, None] > bad[None, :]).mean() > .99
    assert (own.predicted == own.quality).mean() > .98


def test_labels_of_the_held_out_fold_and_other_columns_do_not_count(spark):
    docs, labels = table(spark, "/root/testdata/sf0.01", "documents"), table(spark, "/root/testdata/sf0.01", "labels")
    a = sorted(map(tuple, Q.classify(docs, labels).select("doc_id", "score").collect()))
    flipped = labels.selectExpr("doc_id", "CASE WHEN crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 3 = 1 "
                                          "THEN 1 - quality ELSE quality END AS quality")
    other = docs.selectExpr("doc_id", "text", "'zz' AS lang", "'q' AS source")
    assert a == sorted(map(tuple, Q.classify(other, flipped).select("doc_id", "score").collect()))


def test_odd_tables(spark):
    docs = spark.createDataFrame([(1, None, 1.0, 2), (1, None, 1.0, 2), (None, "a", 2.0, 3), (2, "", None, 4)],
                                 "doc_id long, text string, score double, quality int")
    none = spark.createDataFrame([], "doc_id long, quality int")
    one = spark.createDataFrame([(1, 1), (2, None), (None, 0)], "doc_id long, quality int")
    for labels in (none, one):
        got = Q.classify(docs, labels).collect()
        assert len(got) == 4 and {r.score for r in got} == {.5} and {r.predicted for r in got} == {1}
        kept = Q.keep_good(docs, labels)
        assert kept.columns == docs.columns and sorted(map(str, kept.collect())) == sorted(map(str, docs.collect()))
    assert Q.classify(docs.limit(0), one).count() == 0
