"""The call graph reads its calls once, and texts keep their partitions."""

import pytest

from codefacts.operators import callgraph as cg
from codefacts.plans import audit_checks, go_checks, graph_checks, trace_checks
from conftest import SMOKE


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("query", [graph_checks.q_callers, graph_checks.q_callers_base])
def test_callers_do_not_find_the_edges_anew(spark, query):
    text = plan(query(spark, SMOKE))
    assert "lineitem.parquet" not in text and "orders.parquet" in text


def test_edges_read_the_calls_once(spark):
    assert plan(graph_checks.q_edges(spark, SMOKE)).count("lineitem.parquet") == 1


def test_a_call_known_by_base_and_by_text_comes_once(spark):
    calls = spark.createDataFrame([("a", "p.F"), ("a", "q.F"), ("a", "G"), ("a", "x.y"), ("a", None)], "f string, callee string")
    names = spark.createDataFrame([("F",), ("p.F",), ("x.y",)], "function_name string")
    assert sorted(r.callee for r in cg.internal_calls(calls, names).collect()) == ["p.F", "q.F", "x.y"]


def test_texts_keep_their_partitions(spark):
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    fns, _ = go_checks.go_graph_inputs(spark, SMOKE)
    assert fns.rdd.getNumPartitions() == n
    assert [t.rdd.getNumPartitions() for t in audit_checks.go_facts(spark, SMOKE)] == [n, n]
    assert trace_checks.struct_tables(spark, SMOKE)[1].rdd.getNumPartitions() == n
