"""Declarations inside declarations, values in brackets and postfix chains, on a
file written by hand."""

import pytest

from codefacts.functions import text as T
from codefacts.operators import gofacts as G
from pyspark.sql import functions as F

SRC = '''package x

type (
	A struct {
		X, Y int `json:"x"`
		In struct {
			P string // "no tag"
			Q, R struct { Z []byte `k:"z"` }
		} `json:"in"`
		F func(a int,
			b string) (int, error)
		Base
		*Ptr
		M map[string]struct{ V int }
	}
	B[T any] struct { L []T }
	I interface {
		Do(f func(int) error, n int) (string, error)
		Base
	}
)

type C struct{}

const K, L = f(1, 2), 3
const (
	S1 time.Duration = 5
	E1, E2 = "", "a,b"
	T1 Status = iota
	Sp
)

func (a *A) Run(m map[int]func(int) int) error {
	a.b().c(1).d()
	m[0](2)
	m["k"](3)
	h[int](x)
	h[K, V](x, y)
	func() { inner(1) }()
	func(z int) (int, error) { return z, nil }(4)
	x := []byte("s")
	y := map[string]int{"a": f(1)}
	v := i.(T).m(2)
	(f)(5)
	go func() error {
		return errors.New("boom (")
	}()
	if ok := check(a, g(1)); !ok {
		return nil
	}
	type loc struct { W int }
	q := struct{ N int }{N: 1}
	T{1}.go2()
	a.
		next(1).
		last(2)
	p := []func(){f}[0]; p()
	return interface{}(a)
}
'''


@pytest.fixture(scope="module")
def mf(spark):
    return G.masked_files(spark.createDataFrame([("a.go", SRC), ("empty.go", ""), ("null.go", None)],
                                                "path string, content string")).cache()


def test_structs_of_groups_and_functions(mf):
    assert [r.name for r in G.structs(mf).orderBy("ord").collect()] == ["A", "B", "C", "loc"]


def test_fields_and_their_owners(mf):
    got = [(r.struct, r.owner, r.name, r.type, r.tag) for r in G.all_fields(G.structs(mf)).orderBy("struct_ord", "ord").collect()]
    assert sorted(got, key=str) == sorted([
        ("A", None, "X", "int", 'json:"x'), ("A", None, "Y", "int", 'json:"x'),
        ("A", None, "In", SRC[SRC.index("struct {\n\t\t\tP"):SRC.index(' `json:"in"`')], 'json:"in'),
        ("A", "In", "P", "string", None), ("A", "In", "Q", 'struct { Z []byte `k:"z"` }', None),
        ("A", "In", "R", 'struct { Z []byte `k:"z"` }', None), ("A", "In.Q", "Z", "[]byte", 'k:"z'),
        ("A", "In.R", "Z", "[]byte", 'k:"z'), ("A", None, "F", "func(a int,\n\t\t\tb string) (int, error)", None),
        ("A", None, "M", "map[string]struct{ V int }", None), ("A", "M", "V", "int", None), ("B", None, "L", "[]T", None),
        ("loc", None, "W", "int", None)], key=str)
    own = G.struct_fields(G.structs(mf))
    assert own.columns == ["path", "struct", "struct_ord", "ord", "name", "type", "tag"]
    assert own.where("struct = 'A'").count() == 5


def test_consts_are_split_outside_brackets(mf):
    got = [(r.name, r.type, r.value) for r in G.consts(mf).orderBy("ord").collect()]
    assert got == [("K", None, "f(1, 2)"), ("L", None, "3"), ("S1", None, "5"), ("E1", None, ""), ("E2", None, "a,b"),
                   ("T1", "Status", "iota"), ("Sp", None, None)]


def test_interface_in_a_group(mf):
    got = [(r.interface, r.method, r.signature) for r in G.interfaces(mf).collect()]
    assert got == [("I", "Do", "Do(f func(int) error, n int) (string, error)")]


def test_postfix_chains(mf):
    got = [(r.kind, r.callee, r.full_call) for r in G.calls(G.functions(mf)).orderBy("ord").collect()]
    go = 'func() error {\n\t\treturn errors.New("boom (")\n\t}'
    want = [("a.b().c(1).d", "()"), ("a.b().c", "(1)"), ("a.b", "()"), ("m[0]", "(2)"), ('m["k"]', "(3)"), ("h", "[int](x)"),
            ("h", "[K, V](x, y)"), ("func() { inner(1) }", "()"), ("inner", "(1)"),
            ("func(z int) (int, error) { return z, nil }", "(4)"), ("f", "(1)"), ("i.(T).m", "(2)"), ("(f)", "(5)"), (go, "()"),
            ("errors.New", '("boom (")'), ("check", "(a, g(1))"), ("g", "(1)"), ("T{1}.go2", "()"),
            ("a.\n\t\tnext(1).\n\t\tlast", "(2)"), ("a.\n\t\tnext", "(1)"), ("p", "()")]
    assert [(c, f) for _, c, f in got] == [(c, c + a) for c, a in want]
    assert [k for k, c, _ in got if k != "call"] == ["error", "error"]


def test_deep_and_long_bodies(spark):
    deep = "func f() {\n" + "a(" * 3000 + ")" * 3000 + "\n}\n"
    wide = "func g() {\n" + "b(1).c(2)\n" * 3000 + "}\n"
    mf = G.masked_files(spark.createDataFrame([("d.go", deep + wide)], "path string, content string"))
    calls = G.calls(G.functions(mf)).groupBy("function_name").count().collect()
    assert {r.function_name: r["count"] for r in calls} == {"f": 3000, "g": 6000}


def test_top_pieces(spark):
    texts = ["a, f(b, [c, d]), {e, f}", "", ",", "x", "a), b, (c, d"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    cut = F.transform(T.top_pieces("t", ","), lambda p: F.substring(F.col("t"), p["pos"], p["n"]))
    assert [r[0] for r in df.select(cut).collect()] == [["a", " f(b, [c, d])", " {e, f}"], [""], ["", ""], ["x"],
                                                       ["a)", " b", " (c, d"]]
