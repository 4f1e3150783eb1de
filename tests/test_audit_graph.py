"""K1 / K2 on small graphs against plain walks in Python: least depths, cycles,
strong components and the slice to effects."""

import random
from collections import deque

import pytest

from codefacts.operators import audit as A

EDGE = "src string, dst string"


def walk(edges, start):
    seen, queue = {start: 0}, deque([start])
    while queue:
        n = queue.popleft()
        for a, b in edges:
            if a == n and b not in seen:
                seen[b] = seen[n] + 1
                queue.append(b)
    return seen


def graph(seed, nodes, edges):
    rnd = random.Random(seed)
    return sorted({(f"f{rnd.randrange(nodes)}", f"f{rnd.randrange(nodes)}") for _ in range(edges)})


GRAPHS = [graph(2, 25, 30), [(f"c{i}", f"c{i + 1}") for i in range(6)] + [("c5", "c0")],
          # two cycles, the later one led to from the earlier one, a loop on itself and a bridge
          [("a", "b"), ("b", "a"), ("b", "m"), ("m", "c"), ("c", "d"), ("d", "e"), ("e", "c"), ("e", "z"), ("z", "z")]]


@pytest.mark.parametrize("edges", GRAPHS)
def test_components_and_depths(spark, edges):
    df = spark.createDataFrame(edges + edges[:2], EDGE)
    nodes = sorted({n for e in edges for n in e})
    reach = {n: walk(edges, n) for n in nodes}
    together = {n: [m for m in nodes if m in reach[n] and n in reach[m]] for n in nodes}
    want = {(n, min(together[n])) for n in nodes if len(together[n]) > 1}
    got = A.strong_components(df).collect()
    assert len(got) == len(want) and {tuple(r) for r in got} == want
    src = spark.createDataFrame([(n,) for n in nodes[::3] + ["alone"]], "source string")
    rows = A.reachable(df, src).collect()
    depths = {(n, m, d) for n in nodes[::3] for m, d in reach[n].items()} | {("alone", "alone", 0)}
    assert len(rows) == len(depths) and {tuple(r) for r in rows} == depths


@pytest.mark.parametrize("edges", GRAPHS)
def test_effect_slice(spark, edges):
    nodes = sorted({n for e in edges for n in e})
    effects = [(n, "db", f"select {n}") for n in nodes[1::4]] + [(n, "error", "same text") for n in nodes[::5]]
    effects += [("alone", "db", "own"), ("nobody", "db", "unreached")]
    starts = nodes[::2] + ["alone", "none"]
    got = A.effect_slice(spark.createDataFrame(edges + [(None, "x"), ("x", None)], EDGE),
                         spark.createDataFrame([(s,) for s in [*starts, starts[0], None]], "source string"),
                         spark.createDataFrame(effects + effects[:1] + [(None, "db", "q")],
                                               "function_name string, kind string, effect string")).collect()
    want = {(s, *e) for s in starts for e in effects if e[0] in walk(edges, s)}
    assert len(got) == len(want) and {tuple(r) for r in got} == want


def slices(spark, edges, starts, effects, **kw):
    got = A.effect_slice(spark.createDataFrame(edges, EDGE), spark.createDataFrame([(s,) for s in starts], "source string"),
                         spark.createDataFrame([(n, "db", "q " + n) for n in effects],
                                               "function_name string, kind string, effect string"), **kw).collect()
    assert len(got) == len(set(got))
    return {(r.source, r.function_name) for r in got}


@pytest.mark.parametrize("seed, bound", [(5, 0), (6, 4)])
def test_effect_slice_in_rounds(spark, seed, bound):
    """Above the bound of one task components and turns come from rounds of joins, with the same
    rows; few sources walk down, few effects walk back."""
    edges = graph(seed, 30, 36)
    nodes = sorted({n for e in edges for n in e})
    few, many = nodes[:2], nodes[::2]
    for starts, effects in ((few, many), (many, few)):
        want = {(a, b) for a in starts for b in effects if b in walk(edges, a)}
        assert slices(spark, edges, starts, effects, in_one_task=bound) == want


@pytest.mark.parametrize("bound", [0, 5, 1000])
def test_turns(spark, bound):
    edges = [e for e in graph(9, 40, 45) if int(e[0][1:]) < int(e[1][1:])]
    turns, last = A._turns(spark.createDataFrame(edges, EDGE), bound)
    turn = {r.node: r.turn for r in turns.collect()}
    assert turns.count() == len(turn) and set(turn) == {n for e in edges for n in e}
    assert all(turn[a] < turn[b] for a, b in edges) and all((t == last) <= (n not in {a for a, _ in edges}) for n, t in turn.items())
    assert min(turn.values()) >= 0 and max(turn.values()) <= last


def test_slice_reads_no_pair_again(spark, monkeypatch):
    """The walk from the sources found each pair by comparing every step with all pairs before, and components
    came from rounds of colours even for a handful of edges."""
    calls = [(f"c{i}", f"c{i + 1}") for i in range(30)] + [("c20", "c10")]
    rounds, closure = [], A._closure
    monkeypatch.setattr(A, "_smallest_before", None)                       # few edges: no colouring
    monkeypatch.setattr(A, "_closure", lambda start, edges: rounds.append(
        {r.source for r in start.select("source").collect()}) or closure(start, edges))
    nodes = [f"c{i}" for i in range(31)]
    assert slices(spark, calls, nodes, nodes[25:]) == {(a, b) for a in nodes for b in nodes[25:] if b in walk(calls, a)}
    assert rounds == [{0}]                                                  # one closure, of nodes and not of pairs


def test_empty_tables(spark):
    none = spark.createDataFrame([], EDGE)
    src = spark.createDataFrame([("a",)], "source string")
    eff = spark.createDataFrame([("a", "db", "q")], "function_name string, kind string, effect string")
    assert A.strong_components(none).count() == 0
    assert [tuple(r) for r in A.effect_slice(none, src, eff).collect()] == [("a", "a", "db", "q")]
    assert A.effect_slice(none, src.limit(0), eff).count() == 0
    assert A.effect_slice(none, src, eff.limit(0)).count() == 0


def test_steps_are_read_from_files(spark):
    """A checkpoint would carry the constraints of all steps before into the next plan."""
    found = A.reachable(spark.createDataFrame(GRAPHS[1], EDGE), spark.createDataFrame([("c0",)], "source string"))
    assert "ExistingRDD" not in found._jdf.queryExecution().executedPlan().toString()
    assert found.count() == 7
