"""Every registered query against its DuckDB statement on sf0.001, plus
plan-shape checks (no Python UDF, no Cartesian product, no nested-loop join)."""

import pytest

import __spark_entry__ as E
from codefacts.plans import registry
from compare import compare, duck

from conftest import SMOKE

E.queries()
QUERIES, ORACLE = registry.QUERIES, registry.ORACLE      # the corpus operators have their own tests


@pytest.fixture(scope="module")
def con():
    return duck(SMOKE)


def test_every_query_has_ids_and_sql():
    assert set(registry.IDS) == set(QUERIES) <= set(E.queries())
    assert set(ORACLE) <= set(E.oracle_sql())
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SMOKE)
    r = compare(df, con, ORACLE[name])
    assert r["schema_match"], r
    assert r["value_match"], r


PLAN_CHECKED = ["callgraph_edges", "client_api_methods", "client_form_fields", "go_calls", "spec_resolution",
                "component_call_requirements", "component_routes", "schema_registry"]


@pytest.mark.parametrize("name", PLAN_CHECKED)
def test_plan_shape(spark, name):
    plan = QUERIES[name](spark, SMOKE)._jdf.queryExecution().executedPlan().toString()
    for bad in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "CartesianProduct",
                "BroadcastNestedLoopJoin"):
        assert bad not in plan, (name, bad)


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["function_name", "caller"]
