"""Contract queries for the call graph (C1-C8) over order-derived call facts."""

from __future__ import annotations

from pyspark.sql import functions as F

from codefacts.operators import callgraph as cg
from codefacts.plans.corpus_graph import ORACLE_CTE, order_call_facts
from codefacts.plans.registry import register


@register("callgraph_registry", "C1", f"""
WITH {ORACLE_CTE}
SELECT function_name, max(path) AS path FROM fns GROUP BY function_name""")
def q_registry(spark, sf_dir):
    functions, _ = order_call_facts(spark, sf_dir)
    return cg.registry(functions).select("function_name", "path")


@register("callgraph_full_registry", "C2", f"""
WITH {ORACLE_CTE}
SELECT DISTINCT path || '::' || function_name AS key, path FROM fns""")
def q_full_registry(spark, sf_dir):
    functions, _ = order_call_facts(spark, sf_dir)
    return cg.full_registry(functions)


@register("callgraph_edges", "C3,C4,C6", f"""
WITH {ORACLE_CTE}
SELECT DISTINCT function_name AS caller, callee FROM raw
WHERE side = 'svc' AND (base IN (SELECT name FROM names) OR callee IN (SELECT name FROM names))""")
def q_edges(spark, sf_dir):
    functions, calls = order_call_facts(spark, sf_dir)
    return cg.call_edges(functions, calls)


@register("callgraph_external", "C3,C5", f"""
WITH {ORACLE_CTE}
SELECT function_name, callee FROM raw
WHERE base NOT IN (SELECT name FROM names) AND callee NOT IN (SELECT name FROM names)""")
def q_external(spark, sf_dir):
    functions, calls = order_call_facts(spark, sf_dir)
    return cg.external_calls(calls, functions.select("function_name")).select("function_name", "callee")


@register("callgraph_callers", "C7", f"""
WITH {ORACLE_CTE},
edges AS (SELECT DISTINCT function_name AS caller, callee FROM raw
          WHERE side = 'svc' AND base IN (SELECT name FROM names))
SELECT n.name AS function_name, e.caller FROM names n LEFT JOIN edges e ON e.callee = n.name""")
def q_callers(spark, sf_dir):
    functions, calls = order_call_facts(spark, sf_dir)
    return cg.callers(functions, cg.call_edges(functions, calls), match="text")


@register("callgraph_callers_base", "C7,Q2", f"""
WITH {ORACLE_CTE},
edges AS (SELECT DISTINCT function_name AS caller, base FROM raw
          WHERE side = 'svc' AND base IN (SELECT name FROM names))
SELECT n.name AS function_name, e.caller FROM names n LEFT JOIN edges e ON e.base = n.name""")
def q_callers_base(spark, sf_dir):
    functions, calls = order_call_facts(spark, sf_dir)
    return cg.callers(functions, cg.call_edges(functions, calls), match="base")


@register("callgraph_stats", "C8", f"""
WITH {ORACLE_CTE}
SELECT (SELECT count(*) FROM names) AS total_functions,
       (SELECT count(*) FROM raw) AS total_raw_calls,
       (SELECT count(*) FROM raw WHERE base NOT IN (SELECT name FROM names)
                                   AND callee NOT IN (SELECT name FROM names)) AS filtered_external_calls,
       (SELECT count(*) FROM raw WHERE base IN (SELECT name FROM names)
                                    OR callee IN (SELECT name FROM names)) AS internal_calls""")
def q_stats(spark, sf_dir):
    functions, calls = order_call_facts(spark, sf_dir)
    return cg.graph_stats(functions, calls)
