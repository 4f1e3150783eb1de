"""Call graph over backend facts.

Inputs are flat fact tables:

* ``functions(path, ord, function_name)`` - one row per definition;
* ``calls(path, function_ord, function_name, callee)`` - raw call texts of kind
  ``call``, distinct per definition (G8).

Everything stays a flat edge table. Adjacency and caller lists are never
collected into one array per function: a popular callee can carry a large
share of all edges, and a flat table spreads it over tasks. C9 (the combined
graph document) is ``codefacts.sources.files.write_call_graph``: the four
tables written side by side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codefacts.session import shuffled, written


def call_base(call) -> "F.Column":
    """The text after the last dot (the whole text when there is none)."""
    c = F.col(call) if isinstance(call, str) else call
    return F.element_at(F.split(c, r"\.", -1), -1)


def registry(functions: DataFrame) -> DataFrame:
    """``function_name -> path``; on duplicate names the last definition wins.

    "Last" is defined (SURVEY Q1) as the greatest ``(path, ord)``. Partial
    aggregation runs before the shuffle, so a name defined in many files costs
    one row per task, not one per definition.
    """
    return (functions.groupBy("function_name")
            .agg(F.max(F.struct("path", "ord")).alias("w"))
            .select("function_name", F.col("w.path").alias("path"), F.col("w.ord").alias("ord")))


def full_registry(functions: DataFrame) -> DataFrame:
    """Collision-proof keys ``path::function_name``."""
    return (functions.select(F.concat_ws("::", "path", "function_name").alias("key"), "path")
            .distinct())


def internal_calls(calls: DataFrame, names: DataFrame) -> DataFrame:
    """C4: calls whose base name **or** whole text is a registered function.

    An OR of two equality conditions would plan as a nested-loop join, and one
    join for each would shuffle the calls four times, so each call asks with its
    one or two different keys in one semi join. Calls are distinct per
    definition; repeated rows, also those of both keys, come once. ``names`` has
    one column ``function_name``.
    """
    n = names.select(F.col("function_name").alias("_n")).distinct()
    keyed = calls.withColumn("_key", F.explode(F.array_distinct(F.array(call_base("callee"), F.col("callee")))))
    return keyed.join(shuffled(n), keyed["_key"] == n["_n"], "left_semi").drop("_key").distinct()


def external_calls(calls: DataFrame, names: DataFrame) -> DataFrame:
    """Calls dropped as external (neither base nor text registered)."""
    n1 = names.select(F.col("function_name").alias("_n1")).distinct()
    n2 = names.select(F.col("function_name").alias("_n2")).distinct()
    based = calls.withColumn("_base", call_base("callee"))
    return (based.join(shuffled(n1), based["_base"] == n1["_n1"], "left_anti")
            .join(shuffled(n2), F.col("callee") == n2["_n2"], "left_anti").drop("_base"))


def call_edges(functions: DataFrame, calls: DataFrame) -> DataFrame:
    """Adjacency as distinct ``(caller, callee)`` edges.

    Only the winning definition of a name contributes (a later duplicate
    replaces the earlier list, it is not merged).
    """
    reg = registry(functions)
    win = reg.select(F.col("path").alias("_p"), F.col("ord").alias("_o"))
    mine = calls.join(shuffled(win), (calls["path"] == win["_p"]) & (calls["function_ord"] == win["_o"]),
                      "left_semi")
    return internal_calls(mine.select(F.col("function_name").alias("caller"), "callee"), reg.select("function_name"))


def callers(functions: DataFrame, edges: DataFrame, match: str = "text") -> DataFrame:
    """Reverse graph as ``(function_name, caller)``; caller NULL when none.

    ``match='text'`` keeps the reference rule (the whole call text must equal
    the name, so ``pkg.F`` never counts, SURVEY Q2); ``match='base'`` compares
    the base name instead.
    """
    names = functions.select("function_name").distinct()
    key = F.col("callee") if match == "text" else call_base("callee")
    # written once: both joins below would find the edges anew
    e = written(edges.select(key.alias("_k"), "caller").distinct())
    # an inner join can be split at a popular callee, an outer join cannot
    called = e.join(shuffled(names), names["function_name"] == e["_k"])
    # distinct keys: a popular callee is one row on the right, not one per caller
    keys = e.select("_k").distinct()
    alone = names.join(shuffled(keys), names["function_name"] == keys["_k"], "left_anti")
    return called.select("function_name", "caller").unionByName(
        alone.select("function_name", F.lit(None).cast("string").alias("caller")))


def graph_stats(functions: DataFrame, calls: DataFrame) -> DataFrame:
    """One row of counters over all definitions.

    ``total_raw_calls`` counts call rows of every definition, duplicates
    included, as the reference does; ``internal_calls`` = raw - external.
    """
    names = functions.select("function_name").distinct()
    flagged = flag_internal(calls, names)
    fn_part = names.agg(F.count("*").cast("bigint").alias("total_functions"),
                        F.lit(None).cast("bigint").alias("total_raw_calls"),
                        F.lit(None).cast("bigint").alias("filtered_external_calls"))
    call_part = flagged.agg(F.lit(None).cast("bigint").alias("total_functions"),
                            F.count("*").cast("bigint").alias("total_raw_calls"),
                            F.count_if(~F.col("is_internal")).cast("bigint")
                            .alias("filtered_external_calls"))
    return (fn_part.unionByName(call_part)
            .agg(*[F.coalesce(F.max(c), F.lit(0)).cast("bigint").alias(c)
                   for c in ("total_functions", "total_raw_calls", "filtered_external_calls")])
            .withColumn("internal_calls", F.col("total_raw_calls") - F.col("filtered_external_calls")))


def flag_internal(calls: DataFrame, names: DataFrame) -> DataFrame:
    """``calls`` plus ``is_internal``: base name or whole text is registered.

    Two left joins against the distinct name table (one row per key, so no
    row is duplicated), instead of one OR join.
    """
    n1 = names.select(F.col("function_name").alias("_n1")).distinct().withColumn("_h1", F.lit(True))
    n2 = names.select(F.col("function_name").alias("_n2")).distinct().withColumn("_h2", F.lit(True))
    based = calls.withColumn("_base", call_base("callee"))
    return (based.join(shuffled(n1), based["_base"] == n1["_n1"], "left")
            .join(shuffled(n2), F.col("callee") == n2["_n2"], "left")
            .withColumn("is_internal", F.coalesce(F.col("_h1"), F.col("_h2"), F.lit(False)))
            .drop("_base", "_n1", "_h1", "_n2", "_h2"))
