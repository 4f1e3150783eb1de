"""Personal data: direct identifiers and the terms that give them away.

Direct identifiers (e-mail, IP address, card, phone) are found by pattern. The
terms around them are judged by what they disclose: over all lines of the
corpus, a term t tells PMI(t; e) = ln(p(t, e) / (p(t) p(e))) about an entity e,
of the IC(e) = -ln p(e) there is to know. A term that tells at least
``disclose`` of IC(e) is generalised, one that tells all of it (it never occurs
without the entity) is removed, wherever it occurs. Probabilities are shares of
all lines; a pair is believed from ``support`` different lines on, so copies of
one line prove nothing. A term holds a letter: runs of digits are mostly parts of
other numbers.

Only lines with an identifier yield (term, entity) pairs; the corpus is then
counted for the terms of believed pairs.

Defined results: null and empty texts have no spans; repeated rows get a row
each with the same spans; rows with the same ``doc_id`` and different texts are
kept apart; null ``doc_id`` is allowed; other columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codefacts.llm.common import let, pin
from codefacts.llm.spans import KEY, Kind, attach, digest_columns, few, find_spans, keyed, outside

# The kinds of direct identifier in their listed order.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
NAMES = ["email", "ip", "card", "phone", "term"]
TERM = r"[\p{L}\p{N}]++"
NOT_TERM = r"[^\p{L}\p{N}]++"


def _digits(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def _ip_parts(found: Column) -> Column:
    return F.forall(F.split(found, r"\."), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", "").rlike(
        "^(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))


def _luhn(found: Column) -> Column:
    def total(d):
        def worth(i):
            n = F.substring(d, F.length(d) - i, F.lit(1)).cast("int")
            return F.when(i % 2 == 0, n).otherwise(F.when(n > 4, 2 * n - 9).otherwise(2 * n))
        return F.aggregate(F.sequence(F.lit(0), F.length(d) - 1), F.lit(0), lambda s, i: s + worth(i))
    d = _digits(found)
    return F.when(F.length(d).between(12, 19), let(d, total) % 10 == 0).otherwise(False)


KINDS = [
    Kind("email", EMAIL, lambda t: t.contains("@"), lambda m: F.lit(True)),
    Kind("ip", IP, lambda t: t.rlike(r"[0-9]\.[0-9]"), _ip_parts),
    Kind("card", CARD, lambda t: t.rlike(r"[0-9](?:[\x20-]?[0-9]){11}"), _luhn),
    Kind("phone", PHONE, lambda t: t.rlike(r"\+[0-9]"), lambda m: F.length(_digits(m)).between(9, 15)),
]


def _lines(texts: DataFrame) -> DataFrame:
    return texts.select(*KEY, F.explode(F.split("text", "\n")).alias("line"))


def _terms(line: Column, min_chars: int) -> Column:
    words = F.filter(F.split(F.lower(line), NOT_TERM), lambda w: (F.length(w) >= min_chars) & w.rlike(r"\p{L}"))
    return F.array_distinct(words)


def _norm(kind: Column, found: Column) -> Column:
    return F.when(kind.isin(2, 3), _digits(found)).otherwise(F.lower(found))


def disclosing_terms(texts: DataFrame, support: int = 2, disclose: float = 0.9,
                     min_chars: int = 3, broadcast_rows: int = 100_000) -> DataFrame:
    """``term, share``: the largest share of an entity's information content that
    the term tells, for terms that tell at least ``disclose`` of one."""
    lines = _lines(texts)
    marked = lines.where(F.col("line").rlike("@|[0-9]")).select(F.col("line").alias("text")).withColumn(
        "h", F.xxhash64("text")).groupBy("h", "text").agg(F.count(F.lit(1)).alias("n_lines"))
    marked = marked.withColumn("doc_id", F.lit(0))
    # each different line once, with the number of its occurrences
    entities = find_spans(marked, KINDS).select("h", "kind", _norm(F.col("kind"), F.col("found")).alias("entity"))
    entities = pin(entities.distinct().join(marked.select("h", "text", "n_lines"), "h"))

    own = F.array_distinct(F.flatten(F.transform(F.array("entity"), lambda e: F.split(e, NOT_TERM))))
    pairs = (entities.select("h", "kind", "entity", "n_lines",
                             F.explode(F.array_except(_terms(F.col("text"), min_chars), own)).alias("term"))
             .groupBy("term", "kind", "entity")
             .agg(F.count(F.lit(1)).alias("lines"), F.sum("n_lines").alias("n_te")).where(F.col("lines") >= support))
    pairs = pin(pairs)
    candidates = few(pairs.select("term").distinct(), broadcast_rows)
    counts = (lines.select(F.explode(_terms(F.col("line"), min_chars)).alias("term"))
              .join(candidates, "term").groupBy("term").agg(F.count(F.lit(1)).alias("n_t")))
    n_e = entities.groupBy("kind", "entity").agg(F.sum("n_lines").alias("n_e"))
    n = lines.count()
    n_te, n_t, of_entity = (F.col(c).cast("double") for c in ("n_te", "n_t", "n_e"))   # products of counts outgrow a long
    told = F.log(n_te * float(n) / (n_t * of_entity)) / F.log(F.lit(float(n)) / of_entity)
    return (pairs.join(counts, "term").join(n_e, ["kind", "entity"]).where(F.col("n_e") < n)
            .groupBy("term").agg(F.max(told).alias("share")).where(F.col("share") >= disclose))


def term_spans(texts: DataFrame, terms: DataFrame, broadcast_rows: int = 100_000) -> DataFrame:
    """Spans (kind 4) of the given terms in all texts that hold one."""
    listed = few(terms.select("term"), broadcast_rows)
    held = (texts.select(*KEY, F.explode(F.array_distinct(F.split(F.lower("text"), NOT_TERM))).alias("term"))
            .join(listed, "term").groupBy(*KEY).agg(F.collect_set("term").alias("terms")))
    held = few(pin(held), broadcast_rows)
    in_texts = attach(texts, held)
    word = Kind("term", TERM, lambda t: F.lit(True), lambda m: F.lit(True))
    words = find_spans(in_texts, [word])
    return (words.withColumn("term", F.lower("found")).join(listed, "term")
            .select(*KEY, F.lit(4).alias("kind"), "start", "end", "found"))


def personal_spans(docs: DataFrame, support: int = 2, disclose: float = 0.9) -> DataFrame:
    """All spans, ``doc_id, h, kind, start, end, found``; kind 0-3 as ``KINDS``, 4 for terms."""
    texts = keyed(docs)
    base = find_spans(texts, KINDS)
    terms = pin(disclosing_terms(texts, support, disclose))
    if terms.isEmpty():
        return base
    # a term inside a direct identifier is covered by it
    return base.unionByName(outside(term_spans(texts, terms), base))


def scan(docs: DataFrame, support: int = 2, disclose: float = 0.9) -> DataFrame:
    """Per row: counts of the direct identifiers, digest of their spans, all spans."""
    return digest_columns(keyed(docs), personal_spans(docs, support, disclose), NAMES, 4)


def sanitised(docs: DataFrame, support: int = 2, disclose: float = 0.9) -> DataFrame:
    """``doc_id, text`` with identifiers replaced by their kind in brackets, and
    disclosing terms by ``[term]`` (generalised) or nothing (removed)."""
    texts = keyed(docs)
    terms = pin(disclosing_terms(texts, support, disclose)).withColumnRenamed("term", "low")
    spans = personal_spans(docs, support, disclose)
    label = F.array(*[F.lit(f"[{n}]") for n in NAMES])
    put = (spans.join(terms, F.lower("found") == F.col("low"), "left")
           .withColumn("put", F.when((F.col("kind") == 4) & (F.col("share") >= 1), "")
                       .otherwise(label[F.col("kind")])))
    by_text = put.groupBy(*KEY).agg(F.sort_array(F.collect_list(F.struct("start", "kind", "end", "put"))).alias("s"))

    def rebuilt(text, s):
        start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("out"))

        def step(acc, x):
            piece = F.concat(F.substring(text, acc["at"].cast("int") + 1, (x["start"] - acc["at"]).cast("int")), x["put"])
            nxt = F.struct(x["end"].alias("at"), F.concat(acc["out"], F.array(piece)).alias("out"))
            return F.when(x["start"] >= acc["at"], nxt).otherwise(acc)
        return F.aggregate(s, start, step, lambda acc: F.concat(
            F.array_join(acc["out"], ""), F.substring(text, acc["at"].cast("int") + 1, F.length(text))))
    joined = attach(texts, by_text, "left")
    return joined.select("doc_id", F.when(F.col("s").isNull(), F.col("text")).otherwise(
        rebuilt(F.col("text"), F.col("s"))).alias("text"))
