"""Sources, sinks and the file stream (S1-S9, C9) on small folders of our own."""

import os
import tempfile

from pyspark.sql import functions as F

from codefacts.operators import callgraph as cg
from codefacts.operators import gofacts as G
from codefacts.operators import schemas as S
from codefacts.sources import files as SF
from codefacts.streaming import read_source_stream


def _tree(root, files):
    for rel, text in files.items():
        p = os.path.join(root, rel)
        os.makedirs(os.path.dirname(p), exist_ok=True)
        with open(p, "w", encoding="utf-8") as f:
            f.write(text)


def test_source_tree_scan(spark):
    root = tempfile.mkdtemp(prefix="codefacts-src-")
    _tree(root, {"a/x.go": "package a\nfunc F() {}\n", "b/c/y.go": "package c\n", "b/z.vue": "<template/>",
                 "README": "no"})
    go = {r.path: r.content for r in SF.read_source_tree(spark, root, ".go").collect()}
    assert go == {"a/x.go": "package a\nfunc F() {}\n", "b/c/y.go": "package c\n"}   # whole files, relative
    vue = [r.path for r in SF.read_source_tree(spark, root, ".vue").collect()]
    assert vue == ["b/z.vue"]
    fns = G.functions(G.masked_files(SF.read_source_tree(spark, root, ".go"))).collect()
    assert [(r.path, r.function_name) for r in fns] == [("a/x.go", "F")]


def test_json_docs_optional_and_versioned(spark):
    root = tempfile.mkdtemp(prefix="codefacts-json-")
    _tree(root, {"d/1.json": '{"entry_points": [{"ep_id": "EP-1", "route": "GET /a"},\n'
                             ' {"ep_id": "EP-2", "route": "/b"}]}'})
    schema = "entry_points array<struct<ep_id:string,route:string>>"
    docs = SF.read_json_docs(spark, root, schema)
    eps = SF.with_position(docs, "entry_points", "ord", "ep").select("ord", "ep.ep_id").collect()
    assert [(r.ord, r.ep_id) for r in eps] == [(0, "EP-1"), (1, "EP-2")]
    missing = SF.optional_table(spark, lambda: spark.read.schema(schema).json(root + "/nope"), schema)
    assert missing.count() == 0 and missing.columns == ["entry_points"]
    p1 = SF.versioned_path(root + "/out", "rules")
    p2 = SF.versioned_path(root + "/out", "rules")
    assert p1 != p2
    SF.write_table(docs.select(F.explode("entry_points").alias("e")).select("e.*"), p1, "json")
    assert spark.read.json(p1).count() == 2


def test_call_graph_sink(spark):
    fns = spark.createDataFrame([("a.go", 0, "F"), ("a.go", 1, "G")], "path string, ord int, function_name string")
    calls = spark.createDataFrame([("a.go", 0, "F", "G")], "path string, function_ord int, function_name string, "
                                                            "callee string")
    base = tempfile.mkdtemp(prefix="codefacts-graph-") + "/g"
    edges = cg.call_edges(fns, calls)
    out = SF.write_call_graph(cg.registry(fns), edges, cg.callers(fns, edges), cg.graph_stats(fns, calls), base)
    assert spark.read.parquet(out["graph"]).collect()[0].asDict() == {"caller": "F", "callee": "G"}
    assert spark.read.parquet(out["stats"]).first().internal_calls == 1


def test_types_folder_priority(spark):
    structs = spark.createDataFrame(
        [("api/a.go", 0, "User", "struct {\n\tA int\n}"), ("api/b.go", 0, "User", "struct {\n\tB int\n}"),
         ("types/u.go", 0, "User", "struct {\n\tT int\n}"), ("types/v.go", 0, "User", "struct {\n\tV int\n}"),
         ("api/a.go", 1, "Only", "struct {\n}"), ("api/b.go", 0, "Only", "struct {\n}")],
        "path string, ord int, name string, body string")
    reg = {r.name: r.path for r in S.struct_registry(structs).collect()}
    assert reg == {"User": "types/v.go", "Only": "api/a.go"}


def test_source_stream(spark):
    root = tempfile.mkdtemp(prefix="codefacts-stream-")
    _tree(root, {"x/a.go": "package a\nfunc A() {\n\tB()\n}\n", "x/b.go": "package b\nfunc B() {}\n"})
    stream = read_source_stream(spark, root, ".go")
    fns = G.functions(G.masked_files(stream)).select("function_name")
    q = (fns.writeStream.format("memory").queryName("cf_stream_fns").trigger(availableNow=True).start())
    q.awaitTermination(120)
    got = sorted(r.function_name for r in spark.sql("SELECT * FROM cf_stream_fns").collect())
    assert got == ["A", "B"]


def test_no_machine_local_folder_on_a_cluster():
    from types import SimpleNamespace as N

    import pytest

    from codefacts.session import checkpoint_dir
    conf = N(get=lambda *a: None)
    context = N(getConf=lambda: conf, getCheckpointDir=lambda: None, master="spark://host:7077")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_dir(N(sparkContext=context, conf=conf))


def test_versions(spark):
    import pytest
    from pyspark.errors import PySparkException

    from codefacts.sources import versions as V
    base = tempfile.mkdtemp(prefix="codefacts-versions-")
    assert V.current_version(spark, base, "rules") is None
    with pytest.raises(FileNotFoundError):
        V.read_current(spark, base, "rules")
    one = spark.createDataFrame([("r1", 1), ("r2", 2), (None, 3)], "rule_id string, n int")
    assert V.publish(one, base, "rules") == 1
    old = V.read_current(spark, base, "rules")
    # a write that fails leaves the version that was current
    with pytest.raises(PySparkException):
        V.publish(old.select(F.raise_error(F.lit("broken")).alias("x")), base, "rules")
    assert V.current_version(spark, base, "rules")[0] == 1
    # a reader in the middle of the next write (rows written, not published) sees the old version
    V.upsert(old, one, "rule_id").write.parquet(base + "/rules/data/v-unpublished")
    assert V.read_current(spark, base, "rules").count() == 3
    changes = spark.createDataFrame([("r2", "x"), ("r9", "y"), (None, "z")], "rule_id string, extra string")
    new = V.upsert(old, changes, "rule_id")
    assert V.publish(new, base, "rules", after=1) == 2
    rows = {tuple(r) for r in V.read_current(spark, base, "rules").select("rule_id", "n", "extra").collect()}
    assert rows == {("r1", 1, None), ("r2", None, "x"), ("r9", None, "y"), (None, 3, None), (None, None, "z")}
    assert old.count() == 3                                     # a reader stays on the version it opened
    with pytest.raises(V.VersionConflict):                      # made from version 1, but 2 is there
        V.publish(one, base, "rules", after=1)
    assert V.current_version(spark, base, "rules")[0] == 2
    assert V.publish(one.limit(0), base, "rules") == 3 and V.read_current(spark, base, "rules").count() == 0


def _files(root):
    return sorted(os.path.relpath(os.path.join(d, f), root) for d, _, fs in os.walk(root) for f in fs)


def test_mirrored_documents(spark):
    import pytest
    from pyspark.errors import PySparkException
    from pyspark.sql import Row

    from codefacts.sources import mirror as M
    root = tempfile.mkdtemp(prefix="codefacts-mirror-") + "/out"
    docs = [("a/x.go", '{"file_path": "a/x.go", "n": 1}'), ("/b/c/y.go", '{"file_path": "é", "n": 2}'), ("z.go", "{}"),
            (None, "{}"), ("q.go", None)]
    df = spark.createDataFrame(docs, "file_path string, document string").repartition(3)
    M.write_mirrored(df, root)
    want = ["_SUCCESS", "a/x.go.json", "b/c/y.go.json", "z.go.json"]
    assert _files(root) == want and os.listdir(root).count("_staging") == 0
    assert open(root + "/_SUCCESS").read() == "3"
    back = SF.read_json_docs(spark, root, "file_path string, n int")
    assert sorted((r.file_path or "", r.n or 0) for r in back.collect()) == [("", 0), ("a/x.go", 1), ("é", 2)]
    M.write_mirrored(df, "file://" + root)                      # again, by URI: the same tree
    assert _files(root) == want
    with pytest.raises(PySparkException):
        M.write_mirrored(spark.createDataFrame([("../up.go", "{}")], "file_path string, document string"), root)
    assert _files(root) == want and not os.path.exists(os.path.dirname(root) + "/up.go.json")

    # a task that dies in the middle leaves whole documents and no visible half; its next try ends the work
    other = tempfile.mkdtemp(prefix="codefacts-mirror-")
    w = M.MirrorWriter(other)

    def dying():
        yield Row(path="a.go", document="{}")
        raise OSError("lost")
    with pytest.raises(OSError):
        w.write(dying())
    assert [f for f in _files(other) if not f.startswith("_")] == ["a.go.json"]
    done = w.write(iter([Row(path="a.go", document="{}"), Row(path="b.go", document="{}")]))
    w.commit([done, None])
    assert _files(other) == ["_SUCCESS", "a.go.json", "b.go.json"] and open(other + "/_SUCCESS").read() == "2"
    w.abort([])


def test_mirror_tasks_keep_drafts_apart():
    """Drafts of all tasks in one folder made the tasks wait for each other at every file."""
    from pyspark.sql import Row

    from codefacts.sources import mirror as M
    root = tempfile.mkdtemp(prefix="codefacts-mirror-")
    w, seen = M.MirrorWriter(root), []

    def rows(name):
        yield Row(path=name + "/a.go", document="{}")
        staging = next(os.path.join(root, x) for x in os.listdir(root) if x.startswith("_staging"))
        seen.append(sorted(os.listdir(staging)))
        assert all(os.path.isdir(os.path.join(staging, x)) for x in seen[-1])
        if name == "one":
            seen.append(w.write(rows("two")))          # another task at the same time
        yield Row(path=name + "/b.go", document="{}")
    first = w.write(rows("one"))
    w.commit([first, seen[2]])
    assert len(seen[0]) == 1 and len(seen[1]) == 2 and set(seen[0]) < set(seen[1])
    assert _files(root) == ["_SUCCESS", "one/a.go.json", "one/b.go.json", "two/a.go.json", "two/b.go.json"]


def test_phase_states(spark):
    from codefacts.operators import audit as A
    base = tempfile.mkdtemp(prefix="codefacts-phases-")
    words = spark.createDataFrame([("1",), ("x",)], "w string")
    rows = A.run_phases(spark, {
        "words": (lambda: words, ()),
        "none": (lambda: words.where("w = 'q'"), ()),
        "absent": (lambda: SF.read_source_tree(spark, base + "/nowhere", ".go"), ()),
        "broken": (lambda: words.select(F.expr("CAST(w AS int)").alias("n")), ("words",)),     # fails while writing
        "after": (lambda: words, ("broken",)),
        "early": (lambda: words, ("later",)),
        "later": (lambda: spark.read.parquet(base + "/words"), ("words", "none")),
    }, base).collect()
    assert [tuple(r) for r in rows] == [
        ("words", "done", 2, None), ("none", "done", 0, None), ("absent", "skipped", None, "PATH_NOT_FOUND"),
        ("broken", "failed", None, "CAST_INVALID_INPUT"), ("after", "failed", None, "NEEDS broken"),
        ("early", "failed", None, "NEEDS later"), ("later", "done", 2, None)]
    assert A.run_phases(spark, {}, base).count() == 0


def test_documents_of_unknown_shape(spark):
    from codefacts.operators import spec as SP
    from codefacts.sources import documents as D
    root = tempfile.mkdtemp(prefix="codefacts-docs-")
    _tree(root, {
        "a.json": '{"structured_spec": {"domains": [{"name": "d", "features": [{"fr_id": "FR-1", "evidence_refs": ["x", 7, null, "EP-1"]},'
                  '{"fr_id": "FR-2"}, {"fr_id": 3, "evidence_refs": {"0": "EP-1"}}, "odd"]}, {"name": "e", "features": null}],'
                  '"cross_cutting": [{"xc_id": "XC-1"}, {}]}}',
        "deep/b.json": '{"structured_spec": {"domains": "none"}}', "c.json": " ", "d.json": '{"structured_spec": ', "e.json": "null",
        "f.json": "[1, 2]", "g.txt": "{}"})
    docs = D.read_documents(spark, root)
    assert {r.source_file: r.broken for r in docs.select("source_file", "broken").collect() if r.broken is not None} == {
        "c.json": " ", "d.json": '{"structured_spec": '}
    assert docs.count() == 6
    features = SP.spec_features(docs)
    assert sorted((r.source_file, r.domain, tuple(r.ord), r.fr_id) for r in features.drop("feature").collect() if r.fr_id) == [
        ("a.json", "d", (0, 0), "FR-1"), ("a.json", "d", (0, 1), "FR-2"), ("a.json", "d", (0, 2), "3")]
    refs = SP.spec_evidence(features).collect()
    assert sorted((r.fr_id, r.ref_ord, r.ref) for r in refs) == [("FR-1", 0, "x"), ("FR-1", 1, "7"), ("FR-1", 3, "EP-1")]
    crossing = SP.cross_cutting(SP.spec_cross_cutting(docs)).collect()
    assert [(r.ord, r.xc_id, r.request_struct, r.response_struct) for r in sorted(crossing, key=lambda r: r.ord)] == [
        (0, "XC-1", None, None), (1, None, None, None)]
    whole = D.list_items(docs.select("source_file", "document"), "document", "$")
    assert sorted((r.source_file, r.ord, r.v) for r in whole.select(
        "source_file", "ord", D.value_at("item", "$", "int").alias("v")).collect()) == [("f.json", 0, 1), ("f.json", 1, 2)]
