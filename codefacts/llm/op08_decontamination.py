"""Benchmark decontamination by SimHash of item-sized windows.

1. Windows. Of all windows with an item's number of words those are kept that
   can qualify at all: at similarity ``t`` a window of ``w`` shingles and an item
   of ``m`` share at least ``t / (1 + t) * (w + m)``, so a window stays if it holds
   that many shingles of items of its size, in any order. Shingles are five words
   (the whole item if it is shorter), over all positions of all documents.
2. Fingerprints. Each window and item gets a 64-bit SimHash of its words,
   weighted by their counts.
3. Multi-index. The fingerprint is four blocks of 16 bits. Within ``radius`` =
   15 bits some block differs by three bits at most; items are entered under each
   block's value and its neighbours within three bits, each different fingerprint
   of the windows is looked up once by its own values, so every item within the
   radius is found, also of other sizes.
4. Verification. Exact weighted Jaccard similarity of the shingles,
   sum of minimum counts over sum of maximum counts, at least ``similarity``.

Words are maximal runs of letters and digits, lower-cased.

Defined results: null or wordless texts and items match nothing; repeated items
and repeated documents count once; a null ``doc_id`` or ``item_id`` is carried
along; empty tables give an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codefacts.llm.common import let, pin
from codefacts.llm.spans import few

NOT_WORD = r"[^\p{L}\p{N}]++"
SHINGLE = 5
RADIUS = 15
BLOCKS = 4
WIDTH = 64 // BLOCKS
FLIPS = 3


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), NOT_WORD), lambda w: w != "")


def shingles(hashes: Column, size: int) -> Column:
    """Hashes of all runs of ``size`` words of a sequence of word hashes."""
    runs = F.transform(F.sequence(F.lit(0), F.size(hashes) - size),
                       lambda i: F.xxhash64(*[hashes[i + j] for j in range(size)]))
    return F.when(F.size(hashes) >= size, runs).otherwise(F.array().cast("array<bigint>"))


def _own_shingles(hashes: Column) -> Column:
    """Shingles of an item or a window: five words, or the whole if shorter."""
    out = shingles(hashes, SHINGLE)
    for n in range(1, SHINGLE):
        out = F.when(F.size(hashes) == n, shingles(hashes, n)).otherwise(out)
    return out


def simhash(hashes: Column) -> Column:
    """Bit b is set if it is set in more than half of the word hashes."""
    def bit(b):
        ones = F.aggregate(hashes, F.lit(0), lambda s, h: s + F.getbit(h, F.lit(b)).cast("int"))
        return F.when(2 * ones > F.size(hashes), F.lit((1 << b) - (1 << 64 if b == 63 else 0))).otherwise(F.lit(0))
    out = bit(0)
    for b in range(1, 64):
        out = out.bitwiseOR(bit(b))
    return out


def _hashes(text: Column) -> Column:
    return F.transform(words(text), lambda w: F.xxhash64(w))


def _items(benchmark: DataFrame) -> DataFrame:
    """``item (item_id, hash of words), wh, sh, n`` per different item with words."""
    raw = benchmark.select("item_id", _hashes(F.col("text")).alias("wh")).where(F.size("wh") > 0)
    return (raw.select(F.struct("item_id", F.xxhash64("wh").alias("h")).alias("item"), "wh",
                       F.size("wh").alias("n")).dropDuplicates(["item"])
            .withColumn("sh", _own_shingles(F.col("wh"))))


def _block(fp: Column, b: int) -> Column:
    return F.shiftrightunsigned(fp, WIDTH * b).bitwiseAND(F.lit((1 << WIDTH) - 1))


def _windows(texts: DataFrame, items: DataFrame, similarity: float, broadcast_rows: int) -> DataFrame:
    """``k, n, starts``: the item-sized windows that share enough shingles with items of their size."""
    sizes = [r[0] for r in items.select(F.least("n", F.lit(SHINGLE))).distinct().collect()]   # five values at most
    known = few(pin(items.select("n", F.explode("sh").alias("sh")).distinct()), broadcast_rows)
    hashes = texts.select("k", _hashes(F.col("text")).alias("wh"))
    hits = None
    for s in sizes:
        at = hashes.select("k", F.size("wh").alias("len"), F.posexplode(shingles(F.col("wh"), s)).alias("pos", "sh"))
        hit = at.join(known.where(F.least("n", F.lit(SHINGLE)) == s), "sh").select("k", "n", "len", "pos")
        hits = hit if hits is None else hits.unionByName(hit)
    if hits is None:
        return None
    one = F.least("n", F.lit(SHINGLE)) - 1
    own = F.least("n", "len") - one                     # shingles of a window
    need = F.ceil(similarity / (1 + similarity) * (F.col("n") - one + own) - 1e-6).cast("int")
    spans = (hits.groupBy("k", "n").agg(F.min("len").alias("len"), F.sort_array(F.collect_set("pos")).alias("at"))
             .select("*", own.alias("own"), F.greatest(need, F.lit(1)).alias("need")).where(F.size("at") >= F.col("need")))

    def starts(at):
        def run(i):
            # windows that hold the hits i to i + need - 1 and not the hit before
            first, last = at[i], at[i + F.col("need") - 1]
            low = F.greatest(last - F.col("own") + 1, F.when(i > 0, at[F.greatest(i - 1, F.lit(0))] + 1).otherwise(0), F.lit(0))
            high = F.least(first, F.greatest(F.col("len") - F.col("n"), F.lit(0)))
            return F.when(low <= high, F.sequence(low, F.greatest(low, high))).otherwise(F.array().cast("array<int>"))
        return F.flatten(F.transform(F.sequence(F.lit(0), F.size(at) - F.col("need")), run))
    return spans.select("k", "n", let(F.col("at"), starts).alias("starts")).where(F.size("starts") > 0)


def contaminated(docs: DataFrame, benchmark: DataFrame, similarity: float = 0.8, radius: int = RADIUS,
                 broadcast_rows: int = 500_000) -> DataFrame:
    """``doc_id, item_id, start_word, n_words, similarity, distance`` and the row key ``k``:
    the best window for each pair of a document and an item that it holds."""
    if not 0 <= radius <= RADIUS:
        raise ValueError("three flipped bits in one of four blocks are exact for a radius up to 15")
    items = pin(_items(benchmark))
    texts = docs.select(F.struct("doc_id", F.xxhash64("text").alias("h")).alias("k"), "text").where("text is not null")
    kind = docs.schema["doc_id"].dataType.simpleString()
    where = _windows(texts, items, similarity, broadcast_rows)
    if where is None:
        empty = (f"doc_id {kind}, item_id {benchmark.schema['item_id'].dataType.simpleString()}, start_word int, "
                 f"n_words int, similarity double, distance int, k struct<doc_id:{kind},h:bigint>")
        return docs.sparkSession.createDataFrame([], empty)
    laid = pin(where.groupBy("k").agg(F.flatten(F.collect_list(F.transform("starts", lambda s: F.struct(
        s.alias("start"), F.col("n").alias("n"))))).alias("laid")))
    n_laid = laid.agg(F.coalesce(F.sum(F.size("laid") + 1), F.lit(0))).first()[0]     # bounds the bytes, not only the rows
    laid = F.broadcast(laid) if n_laid <= broadcast_rows else laid
    cut = (texts.join(laid, "k").dropDuplicates(["k"])
           .select("k", _hashes(F.col("text")).alias("wh"), "laid")
           .select("k", F.explode(F.transform("laid", lambda w: F.struct(
               w["start"].alias("start"), w["n"].alias("n"),
               F.slice("wh", w["start"] + 1, w["n"]).alias("wh")))).alias("w"))
           .select("k", "w.start", "w.n", "w.wh"))
    windows = pin(cut.select("k", "start", "n", let(F.col("wh"), simhash).alias("fp"),
                             let(F.col("wh"), _own_shingles).alias("sh")))

    masks = ",".join(str(x) for x in range(1 << WIDTH) if x.bit_count() <= FLIPS)

    def neighbours(b):
        return F.transform(F.expr(f"array({masks})").cast("array<bigint>"), lambda flip: F.struct(
            F.lit(b).alias("b"), _block(F.col("item_fp"), b).bitwiseXOR(flip).alias("v")))
    entered = items.select("item", let(F.col("wh"), simhash).alias("item_fp"), F.size("sh").alias("n_item"))
    entered = entered.select("*", F.explode(F.flatten(F.array(*map(neighbours, range(BLOCKS))))).alias("e"))
    entered = entered.select("item", "item_fp", "n_item", "e.b", "e.v")
    looked = windows.select("fp").distinct().select("fp", F.explode(F.array(*[
        F.struct(F.lit(b).alias("b"), _block(F.col("fp"), b).alias("v")) for b in range(BLOCKS)])).alias("e"))
    looked = looked.select("fp", "e.b", "e.v")
    apart = F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp")))
    found = (entered.join(few(pin(looked), broadcast_rows), ["b", "v"]).where(apart <= radius)
             .select("fp", "item", "n_item", apart.alias("distance")).distinct())
    pairs = windows.select("k", "start", "n", "fp").join(few(pin(found), broadcast_rows), "fp").drop("fp")

    counts = (items.select("item", F.explode("sh").alias("sh")).groupBy("item", "sh")
              .agg(F.count(F.lit(1)).alias("c_item")))
    own = (pairs.join(windows.select("k", "start", "n", "sh"), ["k", "start", "n"])
           .select("k", "start", "n", "item", "n_item", "distance", F.size("sh").alias("n_own"), F.explode("sh").alias("sh"))
           .groupBy("k", "start", "n", "item", "n_item", "distance", "n_own", "sh")
           .agg(F.count(F.lit(1)).alias("c_own")))
    least = F.sum(F.least("c_own", "c_item"))
    scored = (own.join(counts, ["item", "sh"])
              .groupBy("k", "start", "n", "item", "n_item", "distance", "n_own").agg(least.alias("both"))
              .withColumn("similarity", F.col("both") / (F.col("n_own") + F.col("n_item") - F.col("both")))
              .where(F.col("similarity") >= similarity))
    best = scored.groupBy("k", "item").agg(F.min(F.struct(
        (-F.col("similarity")).alias("s"), "start", "n", "distance")).alias("w"))
    return best.select("k.doc_id", "item.item_id", F.col("w.start").alias("start_word"), F.col("w.n").alias("n_words"),
                       (-F.col("w.s")).alias("similarity"), "w.distance", "k")


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without the documents that hold an item."""
    held = contaminated(docs, benchmark, **options).select("k").distinct()
    packed = docs.select(F.struct("doc_id", F.xxhash64("text").alias("h")).alias("k"), F.struct("*").alias("row"))
    return packed.join(few(pin(held), 500_000), "k", "left_anti").select("row.*")
