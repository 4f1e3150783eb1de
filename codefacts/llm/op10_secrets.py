"""Secret scan: fixed patterns, and character Markov models for the rest.

Assignments, access keys and hex strings are found by pattern. Assigned values
and access keys also are the labelled samples of random strings; tokens of
comparable length that are words and short numbers, joined or not, are the
samples of ordinary identifiers. Both classes get a first-order character model
from transition counts over all documents. In a random string any character may
follow, so its counts are smoothed evenly; an identifier's transition that was
seen seldom falls back to the frequency of its second character, so that a
character no identifier holds speaks against one wherever it stands. A token is a secret if the log-likelihood ratio of the two models over its
transitions exceeds ``margin`` and is clearly positive per transition.

What reaches the driver is one count per pair of characters and class, bounded
by the alphabet. Samples can also be given as a table ``(token, is_random)``.

Defined results: null and empty texts have no spans; repeated rows get a row
each; rows with the same ``doc_id`` and different texts are kept apart; without
samples of both classes the models add nothing; other columns are ignored.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codefacts.llm.common import let, pin
from codefacts.llm.spans import Kind, digest_columns, find_spans, keyed, outside

# The kinds of secret in their listed order, and the characters of tokens.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*+[:=]\x20*+["']?([A-Za-z0-9+/_.=-]++)"""
ACCESS = r"AKIA[A-Z0-9]{14,}+"
HEX = r"[0-9a-f]{16,}+"
NAMES = ["assign", "access", "hex", "random"]
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
TOKEN = r"[A-Za-z0-9+/_=-]"
NAME = r"(?:[A-Za-z]++|[0-9]{1,4}+(?![0-9]))(?:[+/_=-]++(?:[A-Za-z]++|[0-9]{1,4}+(?![0-9])))*+"
SIZE = len(ALPHABET)


def _value(found: Column) -> Column:
    return F.regexp_extract(found, ASSIGN, 2)


KINDS = [
    Kind("assign", ASSIGN, lambda t: t.contains(":") | t.contains("="), lambda m: F.length(_value(m)) >= 12),
    Kind("access", ACCESS, lambda t: t.contains("AKIA"), lambda m: F.lit(True)),
    Kind("hex", HEX, lambda t: t.rlike(HEX), lambda m: F.lit(True)),
]


def weak_samples(texts: DataFrame, base: DataFrame, min_chars: int) -> DataFrame:
    """``token, is_random``: values of the fixed patterns as random strings (but
    for hex strings, which would teach an alphabet of 16 characters), tokens of words and short numbers as ordinary identifiers, from all documents."""
    value = F.when(F.col("kind") == 0, _value(F.col("found"))).otherwise(F.col("found"))
    random = base.where("kind <> 2").select(value.alias("token"), F.lit(True).alias("is_random"))
    words = F.regexp_extract_all(F.col("text"), F.lit(rf"(?<!{TOKEN}){NAME}(?!{TOKEN})"), F.lit(0))
    ordinary = texts.select(F.explode(F.filter(words, lambda w: F.length(w) >= min_chars)).alias("token"),
                            F.lit(False).alias("is_random"))
    return random.unionByName(ordinary)


def _codes(token: Column) -> Column:
    """Indexes of a token's characters in the alphabet; others are left out."""
    return F.filter(F.transform(F.split(token, ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1), lambda i: i >= 0)


def transition_counts(samples: DataFrame) -> DataFrame:
    """``is_random, step, n``; ``step`` numbers the pairs of characters."""
    def pairs(c):
        return F.when(F.size(c) > 1, F.transform(F.sequence(F.lit(0), F.size(c) - 2),
                                                 lambda i: c[i] * SIZE + c[i + 1]))
    return (samples.select("is_random", F.explode(let(_codes(F.col("token")), pairs)).alias("step"))
            .groupBy("is_random", "step").agg(F.count(F.lit(1)).alias("n")))


def ratio_table(samples: DataFrame) -> list[float] | None:
    """Log-likelihood ratio (random over ordinary) of each transition; None if a
    class has no sample."""
    counts = {True: [0] * SIZE * SIZE, False: [0] * SIZE * SIZE}
    seen = set()
    for r in transition_counts(samples).collect():      # at most 2 * SIZE * SIZE rows
        counts[r.is_random][r.step] += r.n
        seen.add(r.is_random)
    if len(seen) < 2:
        return None

    def log_p(c, own):
        rows = [sum(c[i * SIZE:(i + 1) * SIZE]) for i in range(SIZE)]
        return [math.log((n + SIZE * own[i % SIZE]) / (rows[i // SIZE] + SIZE)) for i, n in enumerate(c)]
    even = [1 / SIZE] * SIZE
    ordinary = counts[False]
    own = [(sum(ordinary[j::SIZE]) + 1) / (sum(ordinary) + SIZE) for j in range(SIZE)]
    return [round(a - b, 3) for a, b in zip(log_p(counts[True], even), log_p(ordinary, own))]


def ratio(token: Column, table: list[float]) -> Column:
    """Summed log-likelihood ratio over a token's transitions."""
    llr = F.from_json(F.lit(json.dumps(table)), "array<double>")

    def total(c):
        return F.when(F.size(c) < 2, F.lit(0.0)).otherwise(F.aggregate(
            F.sequence(F.lit(0), F.size(c) - 2), F.lit(0.0), lambda s, i: s + llr[c[i] * SIZE + c[i + 1]]))
    return let(_codes(token), total)


def random_token(min_chars: int, table: list[float], margin: float, per_step: float) -> Kind:
    pattern = rf"{TOKEN}{{{min_chars},}}+"

    def keep(m):
        return let(ratio(m, table), lambda r: (r >= margin) & (r >= per_step * (F.length(m) - 1)))
    return Kind("random", pattern, lambda t: F.exists(
        F.regexp_extract_all(t, F.lit(pattern), F.lit(0)), keep), keep)


def secret_spans(docs: DataFrame, samples: DataFrame | None = None, min_chars: int = 16,
                 sample_chars: int = 12, margin: float = 6.0, per_step: float = 0.25) -> DataFrame:
    """All spans, ``doc_id, h, kind, start, end, found``; kind 0-2 as ``KINDS``, 3 by the models."""
    texts = keyed(docs)
    base = pin(find_spans(texts, KINDS))
    table = ratio_table(samples if samples is not None else weak_samples(texts, base, sample_chars))
    if table is None:
        return base
    extra = find_spans(texts, [random_token(min_chars, table, margin, per_step)]).withColumn("kind", F.lit(3))
    return base.unionByName(outside(extra, base))


def scan(docs: DataFrame, **options) -> DataFrame:
    """Per row: counts of the fixed kinds, digest of their spans, all spans."""
    return digest_columns(keyed(docs), secret_spans(docs, **options), NAMES, 3)
