"""Small hand-written fixtures, one per semantics decision."""

import random

from pyspark.sql import functions as F

from codefacts.operators import audit as A
from codefacts.operators import callgraph as cg
from codefacts.operators import client as C
from codefacts.operators import gofacts as G
from codefacts.operators import linking as L
from codefacts.operators import observed as J
from codefacts.operators import schemas as S
from codefacts.operators.containment import first_containing


def files(spark, rows):
    return spark.createDataFrame(rows, "path string, content string")


def test_q1_q2_duplicate_and_qualified(spark):
    fns = spark.createDataFrame([("a.go", 0, "Get"), ("b.go", 0, "Get"), ("m.go", 0, "main"),
                                 ("l.go", 0, "Load")], "path string, ord int, function_name string")
    calls = spark.createDataFrame([("a.go", 0, "Get", "Load"), ("b.go", 0, "Get", "fmt.Println"),
                                   ("m.go", 0, "main", "svc.Load"), ("m.go", 0, "main", "Get")],
                                  "path string, function_ord int, function_name string, callee string")
    reg = {r.function_name: r.path for r in cg.registry(fns).collect()}
    assert reg["Get"] == "b.go"
    assert cg.full_registry(fns).count() == 4
    edges = {(r.caller, r.callee) for r in cg.call_edges(fns, calls).collect()}
    assert edges == {("main", "svc.Load"), ("main", "Get")}          # b.go's Get has no internal call
    text = {(r.function_name, r.caller) for r in cg.callers(fns, cg.call_edges(fns, calls), "text").collect()}
    base = {(r.function_name, r.caller) for r in cg.callers(fns, cg.call_edges(fns, calls), "base").collect()}
    assert ("Load", None) in text and ("Load", "main") in base
    st = cg.graph_stats(fns, calls).first()
    assert (st.total_functions, st.total_raw_calls, st.filtered_external_calls, st.internal_calls) == (3, 4, 1, 3)


GO_SRC = '''package x

type Point struct {
\tX int
}

type A struct {
\tB *B `json:"b"`
\tSkip string `json:"-"`
\tP Point
}

type B struct {
\tA *A
\tHTTPServerID2Name string
}

type Base struct {
\tID int
}

type E struct {
\tName string
\tBase
\ttypes.Base
\t*Base
}

func h(w http.ResponseWriter) {
\tr.GET("/x", h)
\terrors.New("bad " + "thing")
}
'''


def test_go_quirks(spark):
    mf = G.masked_files(files(spark, [("x.go", GO_SRC)]))
    calls = {r.callee: r.kind for r in G.calls(G.functions(mf)).collect()}
    assert calls["r.GET"] == "router"                                   # Q3
    msgs = sorted(r.message for r in G.error_messages(G.calls(G.functions(mf))).collect())
    assert msgs == ["bad ", "thing"]
    st = G.structs(mf)
    reg, fields = S.struct_registry(st), G.struct_fields(st)
    roots = spark.createDataFrame([("A",), ("E",)], "root string")
    rows = S.expand_schemas(spark, roots, reg, fields).collect()
    a = {tuple(r.path): r for r in rows if r.root == "A"}
    assert a[("-",)].go_type == "string"                                # Q7
    assert a[("p",)].go_type == "Point" and a[("p",)].is_array is False  # Q6 suffix rule: primitive
    assert a[("b", "a")].go_type == "A"
    assert a[("b", "a", "<A>")].description == "recursive/deep reference"  # E8/E9 cycle
    assert ("b", "http_server_id2_name") in a                          # E3
    e = sorted(tuple(r.path) for r in rows if r.root == "E")
    assert e == [("id",), ("id",), ("name",)]                           # Q12: Base and types.Base, not *Base
    no_suffix = S.expand_schemas(spark, roots, reg, fields, suffix_rule=False).collect()
    assert any(tuple(r.path) == ("p", "x") for r in no_suffix if r.root == "A")


def test_depth_limit(spark):
    src = "package x\n" + "".join(f"type S{i} struct {{\n\tN *S{i + 1}\n}}\n" for i in range(7))
    mf = G.masked_files(files(spark, [("d.go", src)]))
    st = G.structs(mf)
    rows = S.expand_schemas(spark, spark.createDataFrame([("S0",)], "root string"), S.struct_registry(st),
                            G.struct_fields(st)).collect()
    deepest = max(rows, key=lambda r: len(r.path))
    assert len(deepest.path) == 7 and deepest.depth == 6
    four = S.expand_schemas(spark, spark.createDataFrame([("S0",)], "root string"), S.struct_registry(st),
                            G.struct_fields(st), max_depth=4).collect()
    deepest = max(four, key=lambda r: len(r.path))
    assert deepest.json_key == "<S5>" and deepest.depth == 5


def test_h1_perm_masks(spark):
    df = spark.createDataFrame([(0,), (1,), (3,), (12,), (15,), (None,)], "m int")
    got = [r.r for r in df.select(C.decode_perm("m").alias("r")).collect()]
    assert got == [[], ["Admin"], ["Admin", "Employee"], ["Professor", "Student"],
                   ["Admin", "Employee", "Professor", "Student"], []]


def test_q11_q16_q19(spark):
    client = "class Client {\n  big(a) {\n    // " + "x" * 200_000 + "\n    axios.get('/api/big')\n  }\n" \
             "  ok(a, b) {\n    return axios.post('/api/ok')\n  }\n}\n"
    api = {r.client_method for r in C.api_methods(files(spark, [("c.js", client)])).collect()}
    assert api == {"big", "ok"}
    short = C.api_methods(files(spark, [("c.js", client)]), budget=3000).collect()
    assert {r.client_method for r in short} == {"ok"}                  # Q11, only on request
    vue = ("<template><div><template>inner</template>rest</div></template>\n"
           "<script setup>\nexport default { name: 'Q' }\n</script>\n"
           "<script>\nClient.조회(1)\n</script>")
    comp = C.split_sfc(files(spark, [("v.vue", vue)])).first()
    assert comp.template == "<div><template>inner"                     # Q19
    assert "조회" in comp.script
    calls = C.split_sfc(files(spark, [("v.vue", vue)])).select(C.client_call_list("script").alias("c")).first()
    assert calls.c == ["조회"]                                          # Q16
    sec = J.sections(files(spark, [("v.vue", vue)])).first()
    assert "name: 'Q'" in sec.script and sec.component_name == "Q"    # J19 takes setup


def test_q20_route_matching(spark):
    comps = spark.createDataFrame([("X.vue", "", "")], "file string, template string, script string")
    routes = spark.createDataFrame([("r.js", 0, "/my", "src/views/MyX.vue", [], False, False)],
                                   "source string, ord int, path string, component_file string, "
                                   "required_roles array<string>, needs_graduated boolean, needs_not_graduated boolean")
    assert L.component_routes(comps, routes).first().route == "/my"
    assert L.component_routes(comps, routes, match="suffix").first().route is None


def test_l4_tiers_and_q5(spark):
    eps = spark.createDataFrame([(0, "EP-0", "GET /api/a"), (1, "EP-1", "/api/b"), (2, "EP-2", "POST /api/c/all"),
                                 (3, "EP-3", "/api/c/all/x")], "ord int, ep_id string, route string")
    calls = spark.createDataFrame([(1, "GET", "/api/a"), (2, "PUT", "/api/b"), (3, "GET", "/api/c"),
                                   (4, "GET", "/api/zz"), (5, "GET", "")],
                                  "call_id int, http_method string, url string")
    got = {r.call_id: (r.ep_id, r.tier) for r in L.resolve_urls(calls, L.endpoint_map(eps)).collect()}
    assert got == {1: ("EP-0", 1), 2: ("EP-1", 2), 3: ("EP-2", 3), 4: (None, None), 5: (None, None)}


def test_containment_matches_brute_force(spark):
    rnd = random.Random(7)
    alpha = "ab/"
    keys = ["".join(rnd.choice(alpha) for _ in range(rnd.randint(1, 12))) for _ in range(60)]
    needles = ["".join(rnd.choice(alpha) for _ in range(rnd.randint(1, 5))) for _ in range(120)]
    kdf = spark.createDataFrame([(k, i, f"v{i}") for i, k in enumerate(keys)], "key string, key_ord int, value string")
    ndf = spark.createDataFrame(list(enumerate(needles)), "needle_id int, needle string")
    got = {r.needle_id: r.value for r in first_containing(ndf, kdf).collect()}
    for i, n in enumerate(needles):
        exp = next((f"v{j}" for j, k in enumerate(keys) if n in k), None)
        assert got.get(i) == exp, (n, exp, got.get(i))


def test_containment_of_long_needles(spark):
    rnd = random.Random(11)
    part = lambda: rnd.choice(["/api", "/v1", "/user", "/ü😀", "/list", ":id", "/a"])
    keys = ["".join(part() for _ in range(rnd.randint(1, 15))) for _ in range(80)] + ["/api" * 500, "", None]
    needles = [k[rnd.randrange(len(k)):][:rnd.randint(1, 40)] for k in keys[:81] for _ in range(2)]
    needles += ["/api" * 499 + "/v", "nowhere", "/api/v1/nothing/of/the/kind", "", None, "api" * 600]
    kdf = spark.createDataFrame([(k, i, f"v{i}") for i, k in enumerate(keys)], "key string, key_ord int, value string")
    ndf = spark.createDataFrame(list(enumerate(needles)), "needle_id int, needle string")
    got = {r.needle_id: (r.value, r.key_ord) for r in first_containing(ndf, kdf).collect()}
    want = {i: next(((f"v{j}", j) for j, k in enumerate(keys) if k and n in k), None) for i, n in enumerate(needles) if n}
    assert got == {i: w for i, w in want.items() if w}
    assert first_containing(ndf.where("needle is null"), kdf).collect() == []
    assert first_containing(ndf, kdf.where("key is null")).collect() == []


def test_reachability_matches_brute_force(spark):
    rnd = random.Random(3)
    edges = {(f"n{rnd.randint(0, 30)}", f"n{rnd.randint(0, 30)}") for _ in range(70)}
    e = spark.createDataFrame(sorted(edges), "src string, dst string")
    srcs = ["n0", "n5", "n9"]
    got = {(r.source, r.function_name): r.depth
           for r in A.reachable(e, spark.createDataFrame([(s,) for s in srcs], "source string")).collect()}
    adj = {}
    for a, b in edges:
        adj.setdefault(a, set()).add(b)
    exp = {}
    for s in srcs:
        dist, frontier = {s: 0}, [s]
        while frontier:
            nxt = []
            for u in frontier:
                for v in adj.get(u, ()):
                    if v not in dist:
                        dist[v] = dist[u] + 1
                        nxt.append(v)
            frontier = nxt
        exp.update({(s, v): d for v, d in dist.items()})
    assert got == exp


def test_numbering_is_consecutive(spark):
    rows = [(b, f"s{rnd}", o) for b in range(3) for rnd in range(7) for o in range(5)]
    df = spark.createDataFrame(rows, "_b int, _s string, _o int").repartition(5)
    got = sorted((r.req_id, r._b, r._s, r._o) for r in L.number_rows(df, ["_b", "_s", "_o"]).collect())
    exp = sorted(rows)
    assert [g[1:] for g in got] == exp
    assert [g[0] for g in got] == [f"CL-{i:03d}" for i in range(1, len(rows) + 1)]


LONG = "x" * 200_000
LONG_GO = ('package x\n\nfunc Big(a int) (' + ", ".join("r%d int" % i for i in range(3000)) + ') {\n\tuse("' + LONG
           + '")\n\terrors.New("' + "y\\n" * 3000 + '")\n}\n\nconst (\n'
           + "".join("\tK%d = %d\n" % (i, i) for i in range(10_000)) + ')\n\nimport (\n'
           + "".join('\t"p/%d"\n' % i for i in range(2000)) + ')\n\ntype One struct { A int; B string }\n')


def test_long_go_texts_are_read_whole(spark):
    mf = G.masked_files(files(spark, [("big.go", LONG_GO)]))
    fn = G.functions(mf).collect()
    assert [f.function_name for f in fn] == ["Big"] and len(fn[0].body) > 200_000
    calls = G.calls(G.functions(mf))
    assert sorted(r.callee for r in calls.collect()) == ["errors.New", "use"]
    assert max(len(r.message) for r in G.error_messages(calls).collect()) == 9000
    ords = [r.ord for r in G.consts(mf).collect()]
    assert len(ords) == len(set(ords)) == 10_000
    ords = [r.ord for r in G.imports(mf).collect()]
    assert len(ords) == len(set(ords)) == 2000
    fields = {(r.name, r.type) for r in G.struct_fields(G.structs(mf)).collect()}
    assert fields == {("A", "int"), ("B", "string")}


def test_long_attributes_messages_and_conditions(spark):
    vue = ('<template><button :disabled="status === ' + LONG + '"></button></template>\n<script>\nif (' + "c" * 300
           + ") { this.$swal('" + "m" * 500 + "') }\n</script>")
    comp = C.split_sfc(files(spark, [("v.vue", vue)]))
    assert len(C.disabled_guards(comp).first().condition) > 200_000
    m = C.validation_messages(comp).first()
    assert len(m.message) == 500
