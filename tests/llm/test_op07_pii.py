import hashlib
import math
import re

import pytest

from codefacts.llm import op07_pii as P
from codefacts.sources.tables import table

# The patterns of the contract.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
NAMES = [*PATTERNS, "term"]
HOSTILE = [
    None, "", " ", "a@b.co_x@d.ef a@b a@b.c..d x+y%z@q-.r-", "..@a.b", "1.2.3.4.5.6.7.8", "256.1.1.1 0255.1.1.01 1.2.3",
    "4539 1488 0343 6467 and 4539-1488-0343-6467, 4539  1488", "+1 (555) 010-2020. +44 20 7946 0958 +1 +12345678",
    "éé😀 me@x.org 😀+1 (017) 555-7713😀", "9" * 5000, "1 " * 5000 + "x", "a" * 20000 + "@", "@" * 300, "+1" * 200,
    "1." * 3000, "a@b.c" * 400, "4111111111111111" * 2, "4111 1111 1111 1111", "the " * 5000 + "4111111111111111",
    "x@y.z\n" * 50, "\x01 a@b.cd \x01",
]


def luhn(d):
    t = 0
    for i, c in enumerate(reversed(d)):
        n = int(c) * (1 + i % 2)
        t += n - 9 if n > 9 else n
    return t % 10 == 0


def brute(text):
    out = []
    for k, (name, p) in enumerate(PATTERNS.items()):
        for m in re.finditer(p, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": name == "ip" and all(int(x) <= 255 for x in m[0].split(".")),
                  "card": 12 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[name]
            if ok:
                out.append((m.start(), k, m.end()))
    return sorted(out)


def digest(spans, names):
    return ",".join(f"{names[k]}:{a}:{b}" for a, k, b in spans)


def expected(i, text):
    b = brute(text)
    return (i, *[sum(s[1] == k for s in b) for k in range(4)], hashlib.sha256(digest(b, NAMES).encode()).hexdigest())


def got(df):
    return sorted((tuple(r)[:6] for r in P.scan(df).collect()), key=str)


def test_base_spans_of_hostile_texts(spark):
    rows = [(i, t) for i, t in enumerate(HOSTILE)] + [(3, HOSTILE[3]), (None, HOSTILE[9]), (3, "b@c.de")]
    df = spark.createDataFrame([(i, t, "x", 5) for i, t in rows], "doc_id long, text string, h string, start int")
    assert got(df) == sorted((expected(i, t) for i, t in rows), key=str)


def test_zero_padded_addresses(spark):
    texts = ["from 010.000.000.001 on", "192.168.000.001 000.000.000.000 0.0.0.0", "00000.1.2.0000255 000256.1.1.1",
             "0" * 300 + ".1.1.1"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert got(df) == sorted((expected(i, t) for i, t in enumerate(texts)), key=str)
    assert sorted((r.doc_id, r.n_ip) for r in P.scan(df).collect()) == [(0, 1), (1, 3), (2, 1), (3, 1)]


def test_base_spans_of_the_whole_table(spark):
    df = table(spark, "/root/testdata/sf0.01", "documents")
    assert got(df) == sorted((expected(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()), key=str)


def test_empty_table(spark):
    assert got(spark.createDataFrame([], "doc_id long, text string")) == []


@pytest.fixture(scope="module")
def corpus(spark):
    rows = [(i, f"plain line {i} about the weather\nZorblax wrote m.k@corp.example again {'abcdefgh'[i]}")
            for i in range(8)]
    rows += [(100 + i, "nothing about the weather or again") for i in range(40)]
    rows += [(300, "only zorblax here, plain 😀 Zorblax!"), (301, "copy x.y@one.example unique"),
             (302, "copy x.y@one.example unique"), (303, "copy x.y@one.example unique")]
    return spark.createDataFrame(rows, "doc_id long, text string")


def brute_terms(rows, support, disclose):
    lines = [ln for t in rows for ln in t.split("\n")]
    n, words = len(lines), [set(w for w in re.split(r"[\W_]+", ln.lower()) if len(w) >= 3) for ln in lines]
    ents = [set(re.findall(PATTERNS["email"].replace("(", "(?:"), ln)) for ln in lines]
    out = {}
    for e in set().union(*ents):
        n_e = sum(e in x for x in ents)
        for t in set().union(*[w for w, x in zip(words, ents) if e in x]) - set(re.split(r"\W+", e)):
            both = [i for i in range(n) if t in words[i] and e in ents[i]]
            if len({lines[i] for i in both}) < support:
                continue
            n_t = sum(t in w for w in words)
            share = math.log(len(both) * n / (n_t * n_e)) / math.log(n / n_e)
            if share >= disclose:
                out[t] = max(share, out.get(t, 0))
    return out


def test_disclosing_terms_against_brute_force(spark, corpus):
    rows = [r.text for r in corpus.collect()]
    for support, disclose in ((3, .9), (2, .5), (1, .7)):
        have = {r.term: r.share for r in
                P.disclosing_terms(P.keyed(corpus), support, disclose).collect()}
        assert have == pytest.approx(brute_terms(rows, support, disclose)), (support, disclose)


def test_runs_of_digits_are_no_terms(spark):
    rows = [(i, f"case 77105 of kv7 for Wexford, mail a.b@corp.example {'abcd'[i]}") for i in range(4)]
    rows += [(9, "77105 kv7 wexford"), (10, "case of mail for"), *[(20 + i, "nothing here") for i in range(30)]]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    terms = {r.term for r in P.disclosing_terms(P.keyed(df), 2, .8).collect()}
    assert terms == {"kv7", "wexford", "case", "for", "mail"}
    assert {r.doc_id: r.spans for r in P.scan(df, disclose=.8).collect()}[9] == "term:6:9,term:10:17"


def test_terms_are_spans_wherever_they_occur(spark, corpus):
    spans = {r.doc_id: r.spans for r in P.scan(corpus, disclose=.85).collect()}
    assert spans[300] == "term:5:12,term:27:34"
    assert spans[100] == ""
    assert "email" in spans[1] and "term" in spans[1]


def test_sanitised_text(spark, corpus):
    out = {r.doc_id: r.text for r in P.sanitised(corpus, disclose=.85).collect()}
    assert "corp.example" not in " ".join(out.values()) and "zorblax" not in " ".join(out.values()).lower()
    assert out[100] == "nothing about the weather or again"
    assert out[301] == "copy [email] unique"


def test_shuffle_path_equals_broadcast_path(spark, corpus):
    k = P.keyed(corpus)
    a = {tuple(r) for r in P.disclosing_terms(k, 2, .5).collect()}
    assert a == {tuple(r) for r in P.disclosing_terms(k, 2, .5, broadcast_rows=0).collect()}
    terms = P.disclosing_terms(k, 2, .5)
    a = {tuple(r) for r in P.term_spans(k, terms).collect()}
    assert a and a == {tuple(r) for r in P.term_spans(k, terms, broadcast_rows=0).collect()}
