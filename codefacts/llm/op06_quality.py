"""Quality classifier by attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE`` words. Every passage of every
document is encoded (surface statistics, novelty against the passages before
it, hashed words); a gated attention a_k ~ softmax(w . (tanh(V h_k) * sigm(U h_k)))
weighs the encoded passages, and a logistic layer scores their weighted sum.
All layers are learned together from document labels only.

The model is fitted on at most ``max_documents`` labelled documents (those with
the smallest hash of their id, outside the held-out fold) and takes them in that
order, with all their passages, as long as those are at most ``max_passages``;
both are the documented bounds of what reaches the driver. Scoring reads whole
texts.

Defined results: null and empty texts are one empty passage and get a score;
repeated rows get a row each; a null ``doc_id`` is not held out and has no
label; without labels of both classes every score is 0.5; labels that are null
are ignored, of several labels of a document the smallest counts, of several
labelled texts the first by its hash; other columns are ignored.
"""

from __future__ import annotations

import zlib
from operator import eq

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType
from pyspark.sql.window import Window

from codefacts.llm.common import computed, pin

PASSAGE = 64
HASHED = 32
SURFACE = 15
WIDTH = SURFACE + HASHED
SYMBOLS = "#$%&*@~^_<>{}\\"


def passages(text: str | None) -> list[list[str]]:
    words = (text or "").split()
    return [words[i:i + PASSAGE] for i in range(0, len(words), PASSAGE)] or [[]]


def encode(text: str | None) -> np.ndarray:
    """One row of features per passage, in order."""
    out, seen = [], set()
    for ws in passages(text):
        n, s = max(len(ws), 1), " ".join(ws)
        c = max(len(s), 1)
        pairs, distinct = set(zip(ws, ws[1:])), set(ws)
        again = sum(map(eq, ws, ws[1:]))
        hashed = [0.0] * HASHED
        for w in distinct:
            h = zlib.crc32(w.encode("utf-8", "replace"))
            hashed[h % HASHED] += 1.0 if h & 0x80000000 else -1.0
        out.append([
            np.log1p(len(ws)), c / n / 8, len(distinct) / n, again / n,
            len(pairs & seen) / max(len(pairs), 1), 1.0 - len(pairs) / n,
            sum(map(str.isupper, ws)) / n, sum(map(str.istitle, ws)) / n, sum(map(str.isalpha, ws)) / n,
            sum(map(s.count, "0123456789")) / c * 4, sum(map(s.count, SYMBOLS)) / n,
            s.count("|") / n, s.count("!") / n, (s.count(".") + s.count("?")) / n, s.count(",") / n,
            *[v / (n + 16) for v in hashed]])
        seen |= pairs
    return np.array(out, dtype=np.float32)


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _bags(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts = np.concatenate(([0], np.cumsum(sizes)[:-1])).astype(np.int64)
    return starts, np.repeat(np.arange(len(sizes)), sizes)


def forward(m: dict, x: np.ndarray, sizes: np.ndarray) -> dict:
    """All intermediate values for bags of ``sizes`` consecutive rows of ``x``."""
    starts, of = _bags(sizes)
    h = (x - m["mean"]) / m["std"]
    t, g = np.tanh(h @ m["V"]), _sigmoid(h @ m["U"])
    a = (t * g) @ m["w"]
    e = np.exp(a - np.maximum.reduceat(a, starts)[of])
    a = e / np.add.reduceat(e, starts)[of]
    z = np.tanh(h @ m["E"] + m["e0"])
    bag = np.add.reduceat(a[:, None] * z, starts, axis=0)
    p = _sigmoid(bag @ m["c"] + m["c0"])
    return {"h": h, "t": t, "g": g, "a": a, "z": z, "bag": bag, "p": p, "starts": starts, "of": of}


LEARNED = ("V", "U", "w", "E", "e0", "c", "c0")


def gradients(m: dict, x: np.ndarray, sizes: np.ndarray, y: np.ndarray) -> dict:
    """Gradients of the mean log loss."""
    f = forward(m, x, sizes)
    of, a, z, h, t, g = (f[k] for k in ("of", "a", "z", "h", "t", "g"))
    d = (f["p"] - y) / len(y)
    d_bag = d[:, None] * m["c"]
    d_z = a[:, None] * d_bag[of]
    d_a = (z * d_bag[of]).sum(1)
    d_s = a * (d_a - np.add.reduceat(a * d_a, f["starts"])[of])       # softmax within bags
    d_t, d_g, d_pre = np.outer(d_s, m["w"]) * g, np.outer(d_s, m["w"]) * t, d_z * (1 - z * z)
    return {"c": f["bag"].T @ d, "c0": d.sum(), "E": h.T @ d_pre, "e0": d_pre.sum(0),
            "w": (t * g).T @ d_s, "V": h.T @ (d_t * (1 - t * t)), "U": h.T @ (d_g * g * (1 - g))}


def fit(bags: list[np.ndarray], labels: list[int], hidden: int = 16, steps: int = 200,
        rate: float = 0.03, decay: float = 1e-4, seed: int = 0) -> dict | None:
    """Full-batch Adam; None unless both labels occur."""
    y = np.array(labels, dtype=np.float32)
    if not bags or y.min() == y.max():
        return None
    x, sizes = np.concatenate(bags), np.array([len(b) for b in bags])
    r = np.random.default_rng(seed)
    draw = lambda *shape: r.normal(0, 1 / np.sqrt(shape[0]), shape)
    m = {"mean": x.mean(0), "std": x.std(0) + 1e-3, "V": draw(WIDTH, hidden), "U": draw(WIDTH, hidden),
         "w": draw(hidden), "E": draw(WIDTH, hidden), "e0": np.zeros(hidden), "c": draw(hidden),
         "c0": np.log(y.mean() / (1 - y.mean()))}
    m = {k: np.asarray(v, dtype=np.float32) for k, v in m.items()}
    one, two = {k: 0.0 for k in LEARNED}, {k: 0.0 for k in LEARNED}
    for i in range(1, steps + 1):
        d = gradients(m, x, sizes, y)
        for k in LEARNED:
            grad = d[k] + decay * m[k]
            one[k] = .9 * one[k] + .1 * grad
            two[k] = .999 * two[k] + .001 * grad ** 2
            step = rate * (one[k] / (1 - .9 ** i)) / (np.sqrt(two[k] / (1 - .999 ** i)) + 1e-8)
            m[k] = (m[k] - step).astype(np.float32)
    return m


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, max_documents: int = 4000, max_passages: int = 200_000) -> dict | None:
    """Fit on the bounded sample of labelled documents outside the held-out fold."""
    known = (labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality")))
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_documents)     # at most max_documents rows

    # of rows that share an id, the first by the text's hash
    texts = (docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").groupBy("doc_id", "quality")
             .agg(F.min(F.struct(F.xxhash64("text"), "text")).alias("t")).select("doc_id", "quality", "t.text"))
    bags = pin(computed(texts, "text", "x", BinaryType(), lambda ts: [encode(t).tobytes() for t in ts]))
    run = Window.orderBy(F.xxhash64("doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sizes = (bags.select("doc_id", (F.octet_length("x") / (4 * WIDTH)).alias("n"))     # at most max_documents rows
             .withColumn("n", F.sum("n").over(run)).where(F.col("n") <= max_passages).select("doc_id"))
    got = bags.join(F.broadcast(sizes), "doc_id").toPandas()
    got = got.sort_values("doc_id")
    bags = [np.frombuffer(x, dtype=np.float32).reshape(-1, WIDTH) for x in got["x"]]
    return fit(bags, got["quality"].tolist())


def score(docs: DataFrame, model: dict | None) -> DataFrame:
    """``doc_id, score`` per row of ``docs`` from its whole text."""
    return _scored(docs.select("doc_id", "text"), model, keep_text=False)


def _scored(docs: DataFrame, model: dict | None, keep_text: bool = True) -> DataFrame:
    """``docs`` with a column ``score`` added."""
    def scores(texts: list) -> np.ndarray:
        s = [np.zeros(0)]
        for i in range(0, len(texts), 256):
            bags = [encode(t) for t in texts[i:i + 256]]
            if model:
                s.append(forward(model, np.concatenate(bags), np.array([len(x) for x in bags]))["p"])
            else:
                s.append(np.full(len(bags), .5))
        return np.concatenate(s).astype(np.float64)
    return computed(docs, "text", "score", DoubleType(), scores, keep_source=keep_text)


def classify(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """``doc_id, held_out, score, predicted``."""
    return score(docs, train(docs, labels, **options)).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """``docs`` without the documents that the classifier rejects."""
    model = train(docs, labels, **options)
    names = docs.columns            # renamed on the way, so that none can clash
    plain = docs.toDF(*[f"c{i}" if c != "text" else "text" for i, c in enumerate(names)])
    kept = _scored(plain, model).where("score >= 0.5").drop("score")
    return kept.toDF(*names)
