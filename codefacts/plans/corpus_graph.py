"""Call facts derived from the given tables (no text), SURVEY §4 "call edges".

Each customer with orders defines a function ``F<o_custkey>`` in
``svc/f<o_custkey div 64>.go``; every distinct ``(o_custkey, l_suppkey)`` pair
of ``orders ⋈ lineitem`` is a raw call from it:

* ``G<s>`` when ``s % 5 = 0``  - an unknown name, dropped as external;
* ``store.F<s>`` when ``s`` is even - qualified text, internal by base name;
* ``F<s>`` otherwise.

Customers with ``o_custkey % 13 = 0`` also have an older definition in
``legacy/...`` that calls only ``log.Printf``; the ``svc`` path sorts later, so
that definition loses (SURVEY Q1) yet still counts in the statistics.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codefacts.session import shuffled
from codefacts.sources.tables import table


def _name(prefix: str, key) -> "F.Column":
    return F.concat(F.lit(prefix), key.cast("string"))


def _file(folder: str, key) -> "F.Column":
    return F.concat(F.lit(folder + "/f"), F.floor(key / 64).cast("string"), F.lit(".go"))


def order_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct ``(c, s)`` = ``(o_custkey, l_suppkey)``; de-duplicated behind the join
    only, since few rows of an order share a supplier."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey")
    return (li.join(shuffled(o), li["l_orderkey"] == o["o_orderkey"])
            .select(F.col("o_custkey").alias("c"), F.col("l_suppkey").alias("s"))
            .distinct())


def order_call_facts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """``(functions, calls)`` in the fact-table shapes of ``operators.callgraph``."""
    custs = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c")).distinct()
    c = F.col("c")
    svc = custs.select(_file("svc", c).alias("path"), (c % 64).cast("int").alias("ord"),
                       _name("F", c).alias("function_name"))
    legacy = custs.where(c % 13 == 0).select(
        _file("legacy", c).alias("path"), (c % 64).cast("int").alias("ord"),
        _name("F", c).alias("function_name"))
    functions = svc.unionByName(legacy)

    s = F.col("s")
    pairs = order_pairs(spark, sf_dir)
    svc_calls = pairs.select(
        _file("svc", c).alias("path"), (c % 64).cast("int").alias("function_ord"),
        _name("F", c).alias("function_name"),
        F.when(s % 5 == 0, _name("G", s))
        .when(s % 2 == 0, _name("store.F", s))
        .otherwise(_name("F", s)).alias("callee"))
    # the callee depends on the row (not a literal), as real call texts do; a
    # literal would be constant-folded into a join without an equality key
    legacy_calls = legacy.select("path", F.col("ord").alias("function_ord"), "function_name",
                                 F.when(F.col("ord") >= 0, F.lit("log.Printf"))
                                 .otherwise(F.lit("log.Print")).alias("callee"))
    return functions, svc_calls.unionByName(legacy_calls)


# DuckDB views with the same content, shared by the oracle statements.
ORACLE_CTE = """
pairs AS (SELECT DISTINCT o_custkey AS c, l_suppkey AS s
          FROM orders JOIN lineitem ON o_orderkey = l_orderkey),
custs AS (SELECT DISTINCT o_custkey AS c FROM orders),
fns AS (SELECT 'svc/f' || (c // 64) || '.go' AS path, CAST(c % 64 AS INTEGER) AS ord,
               'F' || c AS function_name FROM custs
        UNION ALL
        SELECT 'legacy/f' || (c // 64) || '.go', CAST(c % 64 AS INTEGER), 'F' || c
        FROM custs WHERE c % 13 = 0),
raw AS (SELECT 'F' || c AS function_name, 'svc' AS side,
               CASE WHEN s % 5 = 0 THEN 'G' || s WHEN s % 2 = 0 THEN 'store.F' || s
                    ELSE 'F' || s END AS callee,
               CASE WHEN s % 5 = 0 THEN 'G' || s ELSE 'F' || s END AS base
        FROM pairs
        UNION ALL
        SELECT 'F' || c, 'legacy', 'log.Printf', 'Printf' FROM custs WHERE c % 13 = 0),
names AS (SELECT DISTINCT function_name AS name FROM fns)
"""
