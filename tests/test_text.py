"""T1-T5 against plain Python on random texts (property tests)."""

import random
import re

from pyspark.sql import functions as F

from codefacts.functions import text as T

ALPHABET = "ab{}()x \n가"


def _texts(n, seed):
    rnd = random.Random(seed)
    out = ["", "{{}}", "x{a{b}c}d{", "가나{다}", "(((", ")))("]
    for _ in range(n):
        out.append("".join(rnd.choice(ALPHABET) for _ in range(rnd.randint(0, 80))))
    return out


def _balanced_py(s, start, budget, o, c):
    depth = 0
    for i in range(start, min(start + budget, len(s))):
        if s[i] == o:
            depth += 1
        elif s[i] == c:
            depth -= 1
            if depth == 0:
                return s[start:i + 1]
    return ""


def test_finditer_positions(spark):
    texts = _texts(300, 1)
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for pat in [r"a\w*\{", r"(?<=x)a", r"\(+", r"b(?=\})"]:
        got = df.select("t", T.finditer("t", "(?U)" + pat).alias("it")).collect()
        for r in got:
            exp = [(m.start() + 1, m.group(0)) for m in re.finditer(pat, r.t)]
            assert [(x.pos, x.m) for x in r.it] == exp, (pat, r.t)


def test_balanced_and_pairs(spark):
    texts = _texts(300, 2)
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for o, c in (("{", "}"), ("(", ")")):
        rows = (df.select("t", F.posexplode(T.finditer("t", "\\" + o)).alias("i", "h"))
                .select("t", F.col("h.pos").alias("p"),
                        T.balanced("t", F.col("h.pos"), 25, o, c).alias("b"),
                        T.pair_len(T.bracket_pairs("t", o, c), F.col("h.pos")).alias("n"))
                .collect())
        for r in rows:
            assert r.b == _balanced_py(r.t, r.p - 1, 25, o, c)
            full = _balanced_py(r.t, r.p - 1, 10 ** 6, o, c)
            assert r.n == len(full)


def test_context_distinct_keywords(spark):
    df = spark.createDataFrame([("abcdefghij",)], "t string")
    r = df.select(T.before("t", F.lit(5), 3).alias("b"), T.after("t", F.lit(5), 3).alias("a"),
                  T.before("t", F.lit(2), 5).alias("b0")).first()
    assert (r.b, r.a, r.b0) == ("bcd", "efg", "a")
    df = spark.createDataFrame([("x1 y x2 x1 x3",)], "t string")
    r = df.select(T.distinct_matches("t", r"x(\d)", 1).alias("d"),
                  T.contains_any("t", ["zz", "y x"]).alias("k")).first()
    assert r.d == ["1", "2", "3"] and r.k


def test_strip_matches_python(spark):
    vals = ["  a b \t\n", "　x　", "", "   "]
    df = spark.createDataFrame([(v,) for v in vals], "t string")
    got = [r.s for r in df.select(T.strip_ws("t").alias("s")).collect()]
    assert got == [v.strip() for v in vals]


def test_many_brackets_in_one_text(spark):
    n = 60_000
    df = spark.createDataFrame([("}" + "{a{b}" * (n // 3) + "}" * 5,)], "t string")
    r = df.select(T.bracket_pairs("t").alias("p"), F.size(T.finditer("t", "[{}]")).alias("n")).first()
    text = df.first().t
    stack, want = [], {}
    for i, c in enumerate(text, 1):
        if c == "{":
            stack.append(i)
        elif c == "}" and stack:
            want[stack.pop()] = i
    assert r.p == want and r.n == sum(text.count(c) for c in "{}")


def test_blocks_carry_whole_bodies(spark):
    df = spark.createDataFrame([("f() {" + "x" * 250_000 + "{ }} g() { h() {",), ("none",)], "t string")
    got = [r.b for r in df.select(T.blocks("t", r"\w\(\) \{").alias("b")).collect()]
    assert [len(b.body) for b in got[0]] == [250_005, 0, 0] and got[1] is None


def test_groups_of_one_walk(spark):
    """The groups of each match are those of ``re``, an optional one without a part being empty."""
    import re
    texts = ["ab=1; a=22 (x) c=3", "a=1a=2", "", "=", "if (t) {a} else {b} if(u){c}", "ab ab.cd ef.gh"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    for rx, n in ((r"(\w+)=(\d)", 2), (r"if\s*\(([^)]*)\)\s*\{([^}]*)\}\s*(?:else\s*\{([^}]*)\})?", 3), (r"(?<!\w)(\w++)\.(?=(\w+))", 2)):
        got = df.select("t", T.groups("t", rx, n).alias("g")).collect()
        assert {r.t: [tuple(x) for x in r.g] for r in got} == {t: [tuple(x or "" for x in m.groups()) for m in re.finditer(rx, t)] for t in texts}
    one = df.select(T.groups("t", r"(\w+)=(\d)", 2).alias("g"))._jdf.queryExecution().optimizedPlan().toString()
    assert one.count("regexp_extract_all") == 1


def test_script_choices_with_and_without_a_ternary(spark):
    from codefacts.operators import client as C
    scripts = ["x = a.type === 'B' ? listA() : listB()\n", "let type = 1; // no choice?\n", "status\n  ? one() : two()", None,
               "v = status ? a() : b(); w = role\n", "const t = term ?\n go (): stay ()"]
    df = spark.createDataFrame([(str(i), s) for i, s in enumerate(scripts)], "file string, script string").selectExpr("file", "'' AS template", "script")
    got = {r.file: (r.condition, list(r.true_calls), list(r.false_calls)) for r in C.conditional_api(df).where("pattern = 'script_ternary'").collect()}
    assert got == {"0": ("x = a.type === 'B'", ["listA"], ["listB"]), "4": ("v = status", ["a"], ["b"]),
                   "5": ("const t = term", ["go"], ["stay"])}


def test_top_pieces_at_any_depth(spark):
    """Whole runs are taken by a pattern of a few levels; deeper and unpaired brackets are counted as before."""
    rnd = random.Random(11)
    texts = ["".join(rnd.choice("()[]{}(){};;\nab é") for _ in range(rnd.randrange(60))) for _ in range(150)]
    texts += ["", ";", "(" * 40 + ";" + ")" * 40 + ";x", "a;" + "{[(" * 9 + ";x;" + ")]}" * 9 + ";b\n(", "}};(;" + "()" * 50 + ";);"]

    def want(text):
        depth, start, out = 0, 0, []
        for i, c in enumerate(text):
            if c in ";\n" and not depth:
                out.append((start + 1, i - start))
                start = i + 1
            depth = depth + 1 if c in "([{" else max(depth - 1, 0) if c in ")]}" else depth
        return out + [(start + 1, len(text) - start)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", T.top_pieces("t", r"\n;").alias("p"))
    assert all([tuple(p) for p in r.p] == want(r.t) for r in df.collect())
    # the fold has a step per declaration, not per line of the bodies
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "split(" not in plan
