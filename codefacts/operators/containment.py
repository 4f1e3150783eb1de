"""First-containing-key join without a nested loop.

Find, for every needle ``u``, the key ``k`` with the least ``key_ord`` such
that ``u`` occurs in ``k``. A plain ``contains`` condition plans as a
broadcast nested-loop join, which does not survive large inputs on either
side. Instead every needle is looked up by its rarest gram:

1. Grams. A needle is cut into all its grams of the largest size in ``SIZES``
   that fits it; keys are cut into grams of the sizes that needles use, one row
   per position and size, so rows grow with a key's length only.
2. Counts. How often each gram occurs in the keys is counted (pre-aggregated
   before the shuffle). A needle with a gram that no key holds occurs nowhere
   and goes no further.
3. Lookup. Each needle meets the keys at its rarest gram alone, and the whole
   needle is compared where it would have to start.

All joins are equi-joins (hash or sort-merge, chosen by AQE; hot grams can be
split, the joins are inner). Grams are compared by hash, the needle by text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codefacts.session import shuffled

SIZES = (1, 2, 4, 8, 16)


def _grams(text: Column, size: Column) -> Column:
    """``array<struct<at, g>>``: 1-based position and hash of every gram of ``size`` characters."""
    def cut(chars):
        at = F.sequence(F.lit(1), F.greatest(F.size(chars) - size + 1, F.lit(1)))
        return F.transform(at, lambda i: F.struct(i.alias("at"), F.xxhash64(F.slice(chars, i, size)).alias("g")))
    # the characters are split once, not once per gram
    return F.transform(F.array(F.split(text, "", -1)), cut)[0]


def first_containing(needles: DataFrame, keys: DataFrame, needle_id: str = "needle_id",
                     needle: str = "needle", key: str = "key", key_ord: str = "key_ord",
                     payload: str = "value") -> DataFrame:
    """``(needle_id, value, key_ord)`` of the first key containing each needle.

    ``needles(needle_id, needle)``; ``keys(key, key_ord, value)``. Empty
    needles match nothing.
    """
    size = F.lit(SIZES[0])
    for s in SIZES[1:]:
        size = F.when(F.length("_u") >= s, s).otherwise(size)
    n = (needles.select(F.col(needle_id).alias("_nid"), F.col(needle).alias("_u"))
         .where(F.col("_u").isNotNull() & (F.length("_u") > 0)).withColumn("_q", size))
    used = sorted(r[0] for r in n.select("_q").distinct().collect())      # at most one value per size
    k = (keys.where(F.col(key).isNotNull())
         .select(F.col(key).alias("_k"), F.col(key_ord).alias("_ko"), F.col(payload).alias("_v"))
         .withColumn("_q", F.explode(F.array(*map(F.lit, used)) if used else F.array().cast("array<int>")))
         .where(F.length("_k") >= F.col("_q")))
    held = k.select("_k", "_ko", "_v", "_q", F.inline(_grams(F.col("_k"), F.col("_q"))))
    counts = held.groupBy("_q", "g").agg(F.count(F.lit(1)).alias("_c"))
    own = n.select("_nid", "_u", "_q", F.inline(_grams(F.col("_u"), F.col("_q"))))
    rarest = (own.join(shuffled(counts), ["_q", "g"])
              .groupBy("_nid", "_u", "_q").agg(F.count(F.lit(1)).alias("_found"),
                                               F.min_by(F.struct("at", "g"), F.struct("_c", "at")).alias("_r"))
              .where(F.col("_found") == F.length("_u") - F.col("_q") + 1)
              .select("_nid", "_u", "_q", F.col("_r.at").alias("_at"), F.col("_r.g").alias("g")))
    start = F.col("at") - F.col("_at") + 1
    hit = rarest.join(shuffled(held), ["_q", "g"]).where((start >= 1) & (F.col("_k").substr(start, F.length("_u")) == F.col("_u")))
    return (hit.groupBy("_nid")
            .agg(F.min_by(F.struct("_v", "_ko"), "_ko").alias("_w"))
            .select(F.col("_nid").alias(needle_id), F.col("_w._v").alias(payload),
                    F.col("_w._ko").alias(key_ord)))
