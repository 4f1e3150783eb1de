"""SimHash near-duplicates by a byte-position inverted index with count filtering.

A 64-bit fingerprint is eight positional bytes. Two fingerprints that differ in
at most ``max_bits`` = 4 bits differ in at most 4 bytes, so they share at least
8 - 4 = 4 positional bytes: that is the guaranteed number of matches. Reading
single-byte posting lists would tally nearly every pair (each list holds 1/256
of all fingerprints), so the index intersects the lists three at a time: any
four matching positions contain one of 20 fixed position triples, hence every
qualifying pair meets in the posting list of at least one triple (24 bits). A
pair is taken at its first shared triple, its shared positional bytes are
tallied, pairs under the guaranteed minimum go, and the rest is verified by its
Hamming distance.

Equal fingerprints are collapsed first, so a group of copies of any size is one
entry. A posting list longer than ``list_limit`` is not paired up. There
every fingerprint is sent to all values within 2 bits of it (outside the bytes
the list shares); two fingerprints are within 4 bits exactly if they meet at
such a value, and linking each to the smallest one at each value gives true
links only and the same components, in linear time.

Defined results: a text without words (null, empty, white space) has the
fingerprint zero and is linked like any other; texts of fewer words than the
shingle length have one shingle, the whole sequence; repeated rows yield a row
each; null ``doc_id`` rows take part, and a component of such rows only has a
null ``component_id``; other columns of the input are ignored.
"""

from __future__ import annotations

from itertools import accumulate, combinations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from codefacts.llm.common import components, computed, pin

SEED = 42
BYTES = 8
CHUNK = 1 << 16


def position_triples() -> list[tuple[int, int, int]]:
    """Turan's cover: positions in three parts; triples inside a part, and two of
    a part with one of the next. Every 4 of the 8 positions contain one."""
    parts = [(0, 1, 2), (3, 4, 5), (6, 7)]
    out = []
    for i, p in enumerate(parts):
        out += list(combinations(p, 3))
        out += [(a, b, c) for a, b in combinations(p, 2) for c in parts[(i + 1) % 3]]
    return [tuple(sorted(t)) for t in out]


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """Unsigned 64-bit SimHash of a text. ``bytes.lower`` touches A-Z only and
    ``bytes.split`` cuts at ASCII white space."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = [e + i for i, e in enumerate(accumulate(map(len, words)))]
    starts = [0] + [e + 1 for e in ends[:-1]]
    spans = list(zip(starts, ends[shingle - 1:])) if len(words) >= shingle else [(0, len(joined))]
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, dtype=np.int64)
    for i in range(0, len(spans), CHUNK):
        h = np.array([digest(joined[a:b], SEED) for a, b in spans[i:i + CHUNK]], dtype="<u8")
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(spans), bitorder="little").view("<u8")[0])


def with_fingerprints(docs: DataFrame, shingle: int = 4, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keys`` and ``fp`` per row, ``fp`` as a signed long with the same bits."""
    return computed(docs.select(*keys, "text"), "text", "fp", LongType(), lambda texts: np.array(
        [fingerprint(t, shingle) for t in texts], dtype=np.uint64).view(np.int64))


def _signed(bits: int) -> int:
    return bits - (1 << 64) if bits >= 1 << 63 else bits


def _byte_mask(positions) -> int:
    return _signed(sum(0xFF << (8 * p) for p in positions))


def _zero(x: Column, mask: int) -> Column:
    return x.bitwiseAND(F.lit(mask)) == 0


def fingerprint_links(fps: DataFrame, max_bits: int = 4, list_limit: int = 2000) -> DataFrame:
    """Links ``(u, v)``, u > v, between distinct values ``fp``. Below
    ``list_limit`` these are all pairs within ``max_bits`` bits; in longer
    posting lists enough of them to give the same components."""
    if not 0 <= max_bits <= 4:
        raise ValueError("the triple index is exact for at most 4 differing bits")
    need = BYTES - max_bits
    triples = position_triples()
    masks = [_byte_mask(t) for t in triples]

    entries = F.array(*[F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("key"))
                        for i, m in enumerate(masks)])
    postings = fps.select("fp", F.explode(entries).alias("e")).select("fp", "e.t", "e.key")
    shared = (postings.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    lists = pin(postings.join(shared, ["t", "key"]))

    short = lists.where(F.col("n") <= list_limit)
    a, b = short.select("t", "key", F.col("fp").alias("u")), short.select("t", "key", F.col("fp").alias("v"))
    x = F.col("u").bitwiseXOR(F.col("v"))
    first = F.coalesce(*[F.when(_zero(x, m), F.lit(i)) for i, m in enumerate(masks)])
    tally = sum((F.when(_zero(x, _byte_mask([p])), 1).otherwise(0) for p in range(BYTES)), F.lit(0))
    pairs = (a.join(b, ["t", "key"])
             .where((F.col("u") > F.col("v")) & (first == F.col("t"))
                    & (tally >= need) & (F.bit_count(x) <= max_bits))
             .select("u", "v"))

    long_lists = lists.where(F.col("n") > list_limit)
    if not long_lists.isEmpty():
        pairs = pairs.unionByName(_meeting_links(long_lists, triples, max_bits))
    return pairs.distinct()


def _meeting_links(lists: DataFrame, triples, max_bits: int) -> DataFrame:
    """Links inside long posting lists by meeting values (see the module text).
    The smallest fingerprint within ``near`` bits of a value is linked with all
    that are within ``far`` bits of it, near + far being ``max_bits``."""
    near, far = max_bits // 2, max_bits - max_bits // 2

    def flips(weight: int) -> DataFrame:
        # fixed size: 20 triples with at most 821 masks each
        rows = [(i, _signed(sum(1 << b for b in c)))
                for i, t in enumerate(triples) for w in range(weight + 1)
                for c in combinations([b for b in range(64) if b // 8 not in t], w)]
        return F.broadcast(lists.sparkSession.createDataFrame(rows, "t int, flip long"))

    def reach(weight: int, name: str) -> DataFrame:
        return lists.join(flips(weight), "t").select(
            "t", "key", F.col("fp").alias(name), F.col("fp").bitwiseXOR(F.col("flip")).alias("at"))

    low = reach(near, "v").groupBy("t", "key", "at").agg(F.min("v").alias("v"))
    return (reach(far, "u").join(low, ["t", "key", "at"]).where("u <> v")
            .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")))


def _rooted(fps: DataFrame, max_bits: int, list_limit: int) -> DataFrame:
    """``fps`` with the ``root`` of each fingerprint's component."""
    stars = components(fingerprint_links(fps.select("fp"), max_bits, list_limit))
    return (fps.join(stars.withColumnRenamed("node", "fp"), "fp", "left")
            .withColumn("root", F.coalesce("root", "fp")))


def simhash_components(docs: DataFrame, shingle: int = 4, max_bits: int = 4,
                       list_limit: int = 2000) -> DataFrame:
    """``doc_id, fingerprint, component_id`` per row of ``docs``."""
    rows = pin(with_fingerprints(docs, shingle))
    fps = rows.groupBy("fp").agg(F.min("doc_id").alias("low_id"))
    rooted = _rooted(fps, max_bits, list_limit)
    ids = rooted.groupBy("root").agg(F.min("low_id").alias("component_id"))
    by_fp = rooted.join(ids, "root").select("fp", "component_id")
    return (rows.join(by_fp, "fp")
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"))


def first_of_components(docs: DataFrame, shingle: int = 4, max_bits: int = 4, list_limit: int = 2000) -> DataFrame:
    """``doc_id, h`` (``h``: ``xxhash64`` of the text), one row per component:
    the smallest ``doc_id``, null ones last, and the smallest ``h`` of equals."""
    named = docs.select("doc_id", F.xxhash64("text").alias("h"), "text")
    rows = pin(with_fingerprints(named, shingle, ("doc_id", "h")))
    key = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "h")
    rooted = _rooted(rows.groupBy("fp").agg(F.min(key).alias("low")), max_bits, list_limit)
    return rooted.groupBy("root").agg(F.min("low").alias("low")).select("low.doc_id", "low.h")
