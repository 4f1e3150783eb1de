"""Spelling variants by reduced-alphabet generation.

Letters are hashed to a few symbols (code point modulo ``symbols``), which turns
words into reduced words. For every word the full neighbourhood of its reduced
word is generated: all strings that one inserted, deleted or replaced symbol
gives, and the reduced word itself (two letters may share a symbol). Words that
differ by one edit have reduced words that differ by one edit or none, so
joining the neighbourhoods with the reduced vocabulary finds every pair; the
original strings then decide.

Neighbours are joined by 64-bit polynomial keys, computed from running sums
without building the strings, so a word of L letters costs L * (2 * symbols)
numbers however long it is. Equal keys of different strings only add
candidates, which the check on the strings removes.

A reduced word that more than ``crowd`` words share would pair them all up.
These words are left to the next alphabet, which has more symbols (the last one
tells all letters apart, so nothing is left over); every word is looked up
there as well, so each pair is found in exactly one alphabet, the one that
settles its second word.

Defined results: null texts have no words and a null ``doc_id`` is written as
nothing; repeated rows count again; ties go to the smallest word in code-point
order; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codefacts.llm.common import pin
from codefacts.llm.spans import few

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RUN = "[A-Za-zÀ-ÿ]+"
ALPHABETS = (8, 32, 256)
BASE = np.uint64(0x9E3779B97F4A7C15)            # odd, so it has an inverse
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
SLICE = 1 << 14                                 # positions of a word handled at a time


def vocabulary(docs: DataFrame, text: str = "text", id: str = "doc_id", min_chars: int = 6, min_count: int = 5,
               every: int = 199) -> DataFrame:
    """``word, n``: runs of letters, A-Z lower-cased. Where ``every`` divides the
    CRC-32 h of ``<id>:<run>``, the run's letter h % length is left out."""
    runs = docs.select(F.coalesce(F.col(id).cast("string"), F.lit("")).alias("id"),
                       F.explode(F.regexp_extract_all(text, F.lit(RUN), F.lit(0))).alias("run"))
    # ``lower`` is faster, but it also changes letters outside A-Z
    plain = F.octet_length("run") == F.length("run")
    run = runs.select("id", F.when(plain, F.lower("run")).otherwise(F.translate("run", UPPER, LOWER)).alias("run"))
    h = F.crc32(F.concat("id", F.lit(":"), "run"))
    at = (h % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    word = F.when(h % every == 0, cut).otherwise(F.col("run"))
    return (run.where(F.length("run") >= min_chars).select(word.alias("word")).where(F.length("word") >= min_chars)
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count))


def _sums(x: np.ndarray) -> np.ndarray:
    """Running sums with a leading zero, modulo 2**64."""
    return np.concatenate([np.zeros(1, np.uint64), np.cumsum(x, dtype=np.uint64)])


def _powers(n: int) -> np.ndarray:
    return np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(n, BASE), dtype=np.uint64)])


def reduced(word: str, symbols: int) -> np.ndarray:
    """The reduced word as numbers 1 to ``symbols``."""
    return np.frombuffer(word.encode("utf-32-le"), "<u4").astype(np.uint64) % np.uint64(symbols) + np.uint64(1)


def key(word: str, symbols: int) -> np.uint64:
    r = reduced(word, symbols)
    return (r * _powers(len(r))[:-1]).sum(dtype=np.uint64)


def neighbour_keys(word: str, symbols: int) -> Iterator[np.ndarray]:
    """Keys of the reduced word's whole one-edit neighbourhood, in pieces."""
    r = reduced(word, symbols)
    n, power = len(r), _powers(len(r))
    before = _sums(r * power[:-1])              # of the letters in front of a position
    whole = before[-1]
    others = np.arange(1, symbols + 1, dtype=np.uint64)
    for a in range(0, n + 1, SLICE):
        gap = np.arange(a, min(a + SLICE, n + 1))
        yield ((before[gap] + BASE * (whole - before[gap]))[:, None] + power[gap][:, None] * others).ravel()    # inserted
        at = gap[gap < n]
        if len(at):
            yield before[at] + INVERSE * (whole - before[at + 1])                                               # deleted
            yield (whole + power[at][:, None] * (others - r[at][:, None])).ravel()                              # replaced


def _keyed(words: DataFrame, symbols: int) -> DataFrame:
    """``words`` with the ``key`` of each reduced word."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = np.array([key(w, symbols) for w in b.column(0).to_pylist()], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(keys)], ["word", "key"])
    return words.select("word").mapInArrow(run, "word string, key long")


def _neighbours(words: DataFrame, symbols: int) -> DataFrame:
    """``key, near_key``: each reduced word's key with those of its neighbourhood."""
    def rows(b):
        for w in b.column(0).to_pylist():
            own = key(w, symbols)
            for near in neighbour_keys(w, symbols):
                near = np.unique(near)
                yield np.full(len(near), own), near

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch(held):
            return pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(c).view(np.int64)) for c in zip(*held)], ["key", "near_key"])
        for b in batches:
            held, size = [], 0
            for own, near in rows(b):
                held.append((own, near))
                size += len(near)
                if size > 1 << 17:
                    yield batch(held)
                    held, size = [], 0
            if held:
                yield batch(held)
    return words.select("word").mapInArrow(run, "key long, near_key long")


def near_pairs(vocab: DataFrame, alphabets: tuple[int, ...] = ALPHABETS, crowd: int = 64, small: int = 500_000) -> DataFrame:
    """``word, near``, both ways: all pairs of words that differ by exactly one
    inserted, deleted or replaced code point. ``alphabets`` ends with one that
    tells all letters apart."""
    words = vocab.select("word")
    open_words, out = words, None
    for i, symbols in enumerate(alphabets):
        last = i == len(alphabets) - 1
        keyed = pin(_keyed(words, symbols))
        here = keyed if i == 0 else keyed.join(open_words, "word", "left_semi")
        sizes = pin(here.groupBy("key").agg(F.count(F.lit(1)).alias("size")))
        settled = sizes if last else sizes.where(F.col("size") <= crowd)
        met = (_neighbours(words, symbols)
               .join(few(settled.select(F.col("key").alias("near_key")), small), "near_key").distinct())
        near = here.select(F.col("word").alias("near"), F.col("key").alias("near_key"))
        candidates = keyed.join(met, "key").join(near, "near_key").select("word", "near")
        # -1 beyond one edit
        found = pin(candidates.where(F.levenshtein("word", "near", 1) == 1).distinct())
        out = found if out is None else out.unionByName(found)
        crowded = sizes.where(F.col("size") > crowd)
        if last or crowded.isEmpty():
            return out
        open_words = pin(here.join(crowded, "key", "left_semi").select("word"))


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of the words with a form. Forms are followed in steps of
    doubling length; each is at least ``times`` as frequent, so there are few."""
    at = pin(forms.select("word", F.col("form").alias("root")))
    while True:
        further = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = pin(at.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"),
                                                           F.col("next").isNotNull().alias("moved")))
        at = step.drop("moved")
        if step.where("moved").isEmpty():
            return at


def variants(docs: DataFrame, min_chars: int = 6, min_count: int = 5, times: int = 5, text: str = "text",
             id: str = "doc_id", **options) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for each word of the vocabulary:
    the form is the most frequent near word, if at least ``times`` as frequent."""
    if times < 2:
        raise ValueError("a form must be more frequent than its word")
    vocab = pin(vocabulary(docs, text, id, min_chars, min_count))
    near = near_pairs(vocab, **options)
    known = vocab.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    best = (near.join(known, "near").groupBy("word")
            .agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct(F.negate("near_n").alias("low"), "near")).alias("best")))
    top = F.when(-F.col("best.low") >= F.col("n") * times, F.col("best"))
    rows = pin(vocab.join(best, "word", "left")
               .select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                       top["near"].alias("form"), (-top["low"]).alias("form_n")))
    roots = _roots(rows.where(F.col("form").isNotNull()))
    return (rows.join(roots, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))


# The same rows in DuckDB: words that share a deletion at the same place differ by
# a replaced letter there, a word that is another one's deletion by an inserted one.
ORACLE_SQL = r"""
WITH RECURSIVE crc_table AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce(range(8), lambda a, k: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, i) AS v
    FROM range(256) r(i))),
runs AS (
  SELECT id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n FROM (
    SELECT coalesce(doc_id::VARCHAR, '') AS id, unnest(regexp_extract_all(text, '[A-Za-z\x{00C0}-\x{00FF}]+')) AS run FROM documents)
  GROUP BY ALL),
hashed AS (
  SELECT run, n, xor(4294967295, list_reduce(
    list_transform(regexp_extract_all(hex(encode(id || ':' || run)), '..'), lambda p: ('0x' || p)::BIGINT),
    lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]), 4294967295)) AS h
  FROM runs, crc_table WHERE length(run) >= 6),
words AS (
  SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n
    FROM hashed)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
cut AS (
  SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS (
  SELECT a.word, b.word AS near FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT c.word, w.word FROM cut c JOIN words w ON c.rest = w.word
  UNION SELECT w.word, c.word FROM cut c JOIN words w ON c.rest = w.word),
best AS (
  SELECT r.word, count(*) AS n_near, arg_min(struct_pack(f := w.word, c := w.n), (-w.n, encode(w.word))) AS top
  FROM near r JOIN words w ON r.near = w.word GROUP BY r.word),
forms AS (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.top.c >= 5 * w.n THEN b.top.f END AS form,
         CASE WHEN b.top.c >= 5 * w.n THEN b.top.c END AS form_n
  FROM words w LEFT JOIN best b ON w.word = b.word),
walk AS (
  SELECT word, word AS at FROM forms
  UNION ALL SELECT k.word, f.form FROM walk k JOIN forms f ON k.at = f.word WHERE f.form IS NOT NULL)
SELECT f.word, f.form, k.at AS root, f.n, f.n_near, f.form_n
FROM forms f JOIN walk k ON f.word = k.word JOIN forms e ON k.at = e.word WHERE e.form IS NULL
"""
