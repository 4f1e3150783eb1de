"""Order MinHash fingerprints.

A text is its sequence of words; its k-mers are the runs of ``kmer`` words
(fewer words: the whole sequence), numbered by occurrence, so that the second
copy of a k-mer differs from the first. One hash of (k-mer, occurrence) orders
them. The range of the hash is cut into ``tuples`` x 2 equal strips, the
smallest k-mer of each strip is selected, the two of a tuple are put back into
text order, and the ordered pair is hashed: two texts agree in a tuple only if
the same k-mers are selected and they stand in the same order, which edits that
move text break although the set of k-mers stays.

Everything is done row by row on sorted arrays of longs (hash above, position
below), so no k-mer is ever shuffled; documents move once to meet the beginning
of the next document.

Likeness: the share of equal tuples among those that are not empty in both,
to the power 1/2 (a tuple agrees if both of its k-mers do).

Defined results: null texts are empty; texts without words have an empty
fingerprint, alike (1.0) to each other and to nothing else; "next" is the next
row in the order of (doc_id, xxhash64 of the text), null ``doc_id`` first;
repeated rows count once in that order and get a row each; a single document is
its own next; other columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from codefacts.llm.common import global_order, pin

DIGITS = "0123456789abcdefghijklmnopqrstuv"
TUPLES = len(DIGITS)
STRIP_SHIFT, TUPLE_SHIFT = 58, 59           # 64 strips, 32 tuples
LOW = (1 << 32) - 1


def _words(text: Column) -> Column:
    return F.filter(F.split(text, r"[\x20\x09-\x0D]++"), lambda w: w != "")


def _kmers(wh: Column, kmer: int) -> Column:
    """Hashes of the k-mers of a sequence of word hashes."""
    n = F.size(wh)
    many = F.transform(F.sequence(F.lit(0), n - kmer), lambda i: F.xxhash64(*[wh[i + j] for j in range(kmer)]))
    return F.when(n >= kmer, many).when(n > 0, F.array(F.xxhash64(wh))).otherwise(F.array().cast("array<bigint>"))


def _pack(high: Column, low: Column) -> Column:
    return F.shiftleft(high, 32).bitwiseOR(low.cast("long"))


def _count_up(a: Column) -> Column:
    return F.when(F.size(a) > 0, F.sequence(F.lit(0), F.size(a) - 1)).otherwise(F.array().cast("array<int>"))


def _differs(a: Column, shift: int):
    """Does element ``i`` differ from the one before in the bits from ``shift`` up?"""
    return lambda x, i: (i == 0) | (F.shiftright(x, shift) != F.shiftright(F.get(a, i - 1), shift))


def _run_starts(s: Column) -> Column:
    """Indexes at which a run of equal k-mers begins."""
    return F.filter(_count_up(s), lambda i: _differs(s, 32)(F.get(s, i), i))


def with_tuples(df: DataFrame, columns: dict[str, str], kmer: int = 5) -> DataFrame:
    """Add, for each text column, an array of its tuple tokens (a long: tuple
    number above, hash of the ordered tuple below) under the name given. Each
    step reads the one before more than once, so the optimiser keeps them apart."""
    keep = df.columns
    step = {c: f"_{i}" for i, c in enumerate(columns)}
    cols = lambda s: {c: F.col(step[c] + s) for c in columns}

    df = df.withColumns({step[c] + "w": F.transform(_words(F.col(c)), lambda w: F.xxhash64(w)) for c in columns})
    df = df.withColumns({step[c] + "k": _kmers(w, kmer) for c, w in cols("w").items()})
    df = df.withColumns({step[c] + "s": F.sort_array(F.transform(k, _pack)) for c, k in cols("k").items()})
    df = df.withColumns({step[c] + "r": _run_starts(s) for c, s in cols("s").items()})

    def numbered(s, r):
        def run(first, j):
            end = F.coalesce(F.get(r, j + 1), F.size(s)) - 1
            return F.transform(F.sequence(first, end), lambda i: _pack(
                F.xxhash64(F.shiftright(F.get(s, i), 32), i - first), F.get(s, i).bitwiseAND(F.lit(LOW))))
        return F.sort_array(F.flatten(F.transform(r, run)))
    df = df.withColumns({step[c] + "t": numbered(F.col(step[c] + "s"), F.col(step[c] + "r")) for c in columns})
    df = df.withColumns({step[c] + "m": F.filter(t, _differs(t, STRIP_SHIFT)) for c, t in cols("t").items()})

    def tokens(m):
        def token(x, i):
            y, place = F.get(m, i + 1), F.shiftright(x, TUPLE_SHIFT)
            hx, hy = F.shiftright(x, 32), F.shiftright(y, 32)
            in_order = x.bitwiseAND(F.lit(LOW)) <= y.bitwiseAND(F.lit(LOW))
            both = F.when(in_order, F.xxhash64(hx, hy)).otherwise(F.xxhash64(hy, hx))
            h = F.when(F.shiftright(y, TUPLE_SHIFT) == place, both).otherwise(F.xxhash64(hx))
            return F.when(_differs(m, TUPLE_SHIFT)(x, i), _pack(place + TUPLES // 2, h.bitwiseAND(F.lit(LOW))))
        return F.filter(F.transform(m, token), lambda t: t.isNotNull())
    df = df.withColumns({columns[c]: tokens(m) for c, m in cols("m").items()})
    return df.select(*keep, *columns.values())


def labels(tokens: Column) -> Column:
    """Tokens as text: a digit for the tuple, eight hex digits for its hash."""
    return F.transform(tokens, lambda t: F.concat(
        F.substring(F.lit(DIGITS), (F.shiftright(t, 32) + 1).cast("int"), F.lit(1)),
        F.lower(F.lpad(F.hex(t.bitwiseAND(F.lit(LOW))), 8, "0"))))


def likeness(a: Column, b: Column) -> Column:
    """Likeness of two token arrays, 0 to 1."""
    places = F.size(F.array_union(F.transform(a, lambda t: F.shiftright(t, 32)), F.transform(b, lambda t: F.shiftright(t, 32))))
    return F.when(places == 0, F.lit(1.0)).otherwise(F.sqrt(F.size(F.array_intersect(a, b)) / places))


def fingerprints(docs: DataFrame, kmer: int = 5) -> DataFrame:
    """``doc_id, fingerprint`` per row: the plain operator."""
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return (with_tuples(texts, {"text": "tokens"}, kmer)
            .select("doc_id", F.array_join(labels(F.col("tokens")), "").alias("fingerprint")))


def neighbours(rows: DataFrame) -> DataFrame:
    """``k, next_k, n_chars, copies`` for each different ``(k, n_chars)`` of
    ``rows``: its successor in the order of ``k``, the first after the last."""
    distinct = rows.groupBy("k", "n_chars").agg(F.count(F.lit(1)).alias("copies"))
    order = pin(global_order(distinct, ["k"]))
    n = order.count()
    after = order.select(F.pmod(F.col("row_index") - 1, F.lit(max(n, 1))).alias("row_index"),
                         F.col("k").alias("next_k"))
    return order.join(after, "row_index").select("k", "next_k", "n_chars", "copies")


def edited_likeness(docs: DataFrame, kmer: int = 5) -> DataFrame:
    """Fingerprint of each document and of its edited text (the last half replaced
    by the beginning of the next document), and how alike they and the next
    document's are."""
    text = F.coalesce("text", F.lit(""))
    keyed = docs.select("doc_id", text.alias("text")).select(
        F.struct("doc_id", F.xxhash64("text").alias("h")).alias("k"), "text")
    links = pin(neighbours(keyed.select("k", F.length("text").alias("n_chars"))))

    one = Window.partitionBy("k").orderBy("k")
    texts = keyed.withColumn("_n", F.row_number().over(one)).where("_n = 1").drop("_n")
    half = F.expr("n_chars div 2").cast("int")
    given = (texts.withColumnRenamed("k", "next_k").join(links, "next_k")
             .select("k", "next_k", "n_chars", "copies", F.substring("text", F.lit(1), half).alias("given")))
    edited = F.concat(F.substring("text", F.lit(1), F.col("n_chars") - half), F.col("given"))
    both = texts.join(given, "k").select("k", "next_k", "n_chars", "copies", "text", edited.alias("edited"))
    done = pin(with_tuples(both, {"text": "own", "edited": "changed"}, kmer)
               .select("k", "next_k", "n_chars", "copies", F.sha2("edited", 256).alias("edited_sha256"),
                       "own", "changed"))
    others = done.select(F.col("k").alias("next_k"), F.col("own").alias("other"))
    return (done.join(others, "next_k")
            .withColumn("_copy", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))))
            .select("k.doc_id", F.col("n_chars").cast("long").alias("n_chars"), "edited_sha256",
                    F.array_join(labels(F.col("own")), "").alias("fingerprint"),
                    F.array_join(labels(F.col("changed")), "").alias("edited_fingerprint"),
                    likeness(F.col("own"), F.col("changed")).alias("near_edited"),
                    likeness(F.col("own"), F.col("other")).alias("near_next")))
