"""Both masks of a file come from one cut of its text, with the same literals as the plain pattern."""

import json
import random

from pyspark.sql import functions as F

from codefacts.functions import text as T
from codefacts.operators import gofacts as G

PLAIN = r'"(?:[^"\\\n]|\\.)*+"|`[^`]*`|' + r"'(?:[^'\\\n]|\\.)*+'" + r"|//[^\n]*|/\*[\s\S]*?\*/"
TEXTS = ['a "x\\"y" b', '"open\n c "ok" // "no"', "'\\'' + '\"' / 2", "`raw \\` /* a\n \"b\" */ x", '"\\\\" "a\\\nb" c', "/ * // é\n/* é */ 'é'", "", "x"]


def test_literals_of_the_plain_pattern(spark):
    texts = spark.createDataFrame([(t,) for t in TEXTS], "c string")
    for r in texts.select("c", F.regexp_extract_all("c", F.lit(PLAIN), 0).alias("plain"),
                          F.regexp_extract_all("c", F.lit(G.RX_LITERAL), 0).alias("found"), G.mask("c").alias("m")).collect():
        assert r.found == r.plain
        want = r.c
        for tok in r.plain:
            want = want.replace(tok, "".join("\n" if ch == "\n" else " " for ch in tok), 1)
        assert r.m == want


def test_both_masks_come_from_one_cut(spark):
    files = spark.createDataFrame([("a.go", 'x := "s" // c')], "path string, content string").repartition(1)
    mf = G.masked_files(files)
    assert (mf.first().masked, mf.first().nocomment) == ("x :=         ", 'x := "s"     ')
    plan = mf._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all(") == 1


def test_document_searches_a_file_once(spark):
    """Every part of a document masked and searched the file anew."""
    text = "package a\nimport \"fmt\"\nconst A = 1\ntype S struct {\n\tN int\n}\ntype I interface {\n\tDo() error\n}\nfunc F() { fmt.Print(\"x\") }\n"
    docs = G.file_documents(spark.createDataFrame([("a.go", text), ("b.go", "package b\n")], "path string, content string"))
    plan = docs._jdf.queryExecution().optimizedPlan().toString()
    assert "split(content" not in plan
    got = {r.file_path: json.loads(r.document) for r in docs.collect()}
    assert set(got) == {"a.go", "b.go"} and got["b.go"] == {"file_path": "b.go", "imports": []}
    d = got["a.go"]
    assert d["imports"] == ["fmt"] and [c["name"] for c in d["consts"]] == ["A"]
    assert [(i["name"], [m["name"] for m in i["methods"]]) for i in d["interfaces"]] == [("I", ["Do"])]
    assert [(x["name"], [f["name"] for f in x["fields"]]) for x in d["structs"]] == [("S", ["N"])]
    assert [(f["function_name"], f["calls"]) for f in d["functions"]] == [("F", ["fmt.Print"])]


def test_ends_of_blocks_at_any_depth(spark):
    """A pattern finds the ends of blocks of a few levels, a count the others: the same ends."""
    rnd = random.Random(4)
    texts = ["".join(rnd.choice("{}{}a\n") for _ in range(rnd.randrange(1, 40))) for _ in range(120)]
    texts += ["{" * n + "}" * n + "}" for n in range(1, 12)] + ["{" * 9, "{}{", "x{}}", "{" + "{}" * 60, "{" + "{a}" * 60 + "}"]

    def want(t):
        depth = 0
        for i, c in enumerate(t):
            depth += {"{": 1, "}": -1}.get(c, 0)
            if c == "}" and not depth:
                return i + 1
        return 0
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", T.block_end("t", F.lit(1)).alias("n")).collect()
    opened = [r for r in rows if r.t.startswith("{")]
    assert len(opened) > 50 and all(r.n == want(r.t) for r in opened)


def test_functions_few_and_many(spark):
    """Up to a few functions are searched one by one, of more all brackets are paired: the same rows."""
    def go(n):
        return "".join(f"func F{i}(a func(int) (x int), b struct{{ c int }}) (r int, e error) {{\n\tif a {{ x({{}}) }}\n}}\n" for i in range(n)) + "func Open(a int\n"
    files = spark.createDataFrame([(f"{n}.go", go(n)) for n in (1, 2, 5)], "path string, content string")
    rows = G.functions(G.masked_files(files)).collect()
    assert sorted((r.path, r.function_name) for r in rows) == sorted((f"{n}.go", f"F{i}") for n in (1, 2, 5) for i in range(n))
    assert len({(r.signature.replace(r.function_name, ""), r.body) for r in rows}) == 1
