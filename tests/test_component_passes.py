"""Component texts are read once, in time that grows with their length, with the same facts as the plain patterns."""

import time

import pytest
from pyspark.sql import functions as F

from codefacts.functions import text as T
from codefacts.operators import client as C
from codefacts.operators import linking as L
from codefacts.plans import link_checks
from conftest import SMOKE

TAGS = {"RX_TEMPLATE": "<template>", "RX_SCRIPT": "<script>", "RX_SELECT": "<select[^>]*>", "RX_THEAD": "<thead>", "RX_TBODY": "<tbody>",
        "RX_TR": "<tr[^>]*>", "RX_TD": "<td[^>]*>"}


@pytest.mark.parametrize("name", TAGS)
def test_sections_of_the_plain_pattern(spark, name):
    tag = name[3:].lower()
    plain = rf"{TAGS[name]}([\s\S]*?)</{tag}>"
    texts = [f"<{tag}>a < b\n</ {tag}></{tag}x></{tag}> c</{tag}>", f"<{tag}><{tag}>é</{tag}></{tag}><{tag}></{tag}>", f"<{tag}>open <b",
             f"</{tag}><{tag}>{'<' * 50_000}</{tag}>", "", f"<{tag}"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select(F.regexp_extract_all("t", F.lit(plain), 1).alias("a"), F.regexp_extract_all("t", F.lit(getattr(C, name)), 1).alias("b")).collect():
        assert r.a == r.b


@pytest.mark.parametrize("of", [L.ui_pages, L.component_map])
def test_no_filter_reads_the_texts_again(spark, monkeypatch, of):
    plans, cut = [], L.cut
    monkeypatch.setattr(L, "cut", lambda df: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or cut(df))
    of(link_checks.components(spark, SMOKE), link_checks.routes(spark, SMOKE))
    assert "regexp_extract" in plans[0] and "Filter " not in plans[0]


def test_script_ternary_is_tried_once_a_line(spark):
    script = "x = " + "type a " * 400 + "\nlet f = status == 'A' ?\n one() : two() + role ? p() : q(); type ? r() : s()"
    df = spark.createDataFrame([("f", "", script)], "file string, template string, script string")
    plain = C.RX_SCRIPT_TERNARY.replace(r"(?:\G|(?<![^\n;]))", "")
    C.conditional_api(df.limit(0)).collect()
    start = time.time()
    got = C.conditional_api(df).collect()
    took = time.time() - start
    tail = spark.createDataFrame([(script[script.index("\n"):],)], "t string")
    want = tail.select(F.regexp_extract_all("t", F.lit(plain), 1).alias("c"), F.regexp_extract_all("t", F.lit(plain), 2).alias("y")).first()
    assert [(r.condition, r.true_calls) for r in got] == [(c.strip(), [y]) for c, y in zip(want.c, want.y)] and len(got) == 3
    assert took < 5


def test_blocks_counted_one_by_one_are_those_of_all_pairs(spark, monkeypatch):
    texts = ["f() { a { b } c } }", "f() { open { b }", "f() {} f() { x }", "} f() { { } } {", "𝒜 f() { é }", "none"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    few = df.select(T.blocks("t", r"f\(\) \{")).collect()
    monkeypatch.setattr(T, "FEW_BLOCKS", -1)
    assert few == df.select(T.blocks("t", r"f\(\) \{")).collect()
    first = [r[0] for r in df.select(T.first_block("t", r"f\(\) \{")).collect()]
    assert first == [r[0][0].body if r[0] else None for r in few]


def test_loop_fields_of_chains(spark):
    html = '<tr v-for="row in rows"><td>{{ row.a.b }} xrow.c a.row.d row.length 1.row.é row. e</td></tr>'
    df = spark.createDataFrame([(html,), ("<p>row.a</p>",)], "t string")
    assert [r[0] for r in df.select(C.vfor_fields("t")).collect()] == [["a", "d", "é"], []]
