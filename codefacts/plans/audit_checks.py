"""Contract queries for audit analytics (K1-K6) and the phase inventory."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from codefacts.operators import audit as A
from codefacts.operators import callgraph as cg
from codefacts.operators import client as C
from codefacts.operators import gofacts as G
from codefacts.operators import linking as L
from codefacts.plans.corpus_client import component_files, store_files, translator_files
from codefacts.plans.corpus_go import go_files
from codefacts.plans.corpus_trace import entry_points, rule_records, spec_evidence, spec_features
from codefacts.plans.go_checks import masked
from codefacts.plans.link_checks import CLIENT_REQ_CTE, api, components, routes
from codefacts.plans.registry import register
from codefacts.session import checkpoint_dir, cut
from codefacts.sources.files import read_source_tree
from codefacts.sources.tables import table

GO_EDGES = """
p AS (SELECT p_partkey AS k FROM part),
names AS (SELECT 'F' || k AS n FROM p UNION ALL SELECT 'Get' || k FROM p),
e0 AS (SELECT 'Get' || k AS src, 'F' || (k // 2) AS dst FROM p
       UNION SELECT 'Get' || k, 'F' || (k // 3) FROM p
       UNION SELECT 'F' || k, 'F' || (k // 2) FROM p),
e AS (SELECT * FROM e0 WHERE dst IN (SELECT n FROM names))"""


def name(prefix, key):
    return F.concat(F.lit(prefix), key.cast("string"))


def go_facts(spark, sf_dir):
    """Go functions and calls extracted once and checkpointed: the audit
    queries read them several times (edges, entry handlers, definitions)."""
    fns = cut(G.functions(masked(spark, sf_dir)), rebalance=False)
    calls = cut(G.calls(fns).select("path", "function_ord", "function_name", "kind", "callee", "full_call"),
                rebalance=False)
    return fns.select("path", "ord", "function_name"), calls


def go_edges(spark, sf_dir, facts=None):
    fns, calls = facts or go_facts(spark, sf_dir)
    cl = calls.where(F.col("kind") == "call").select("path", "function_ord", "function_name", "callee").distinct()
    return A.base_edges(cg.call_edges(fns, cl), "base"), fns


def router_functions(spark, sf_dir, facts=None):
    _, calls = facts or go_facts(spark, sf_dir)
    return calls.where(F.col("kind") == "router").select("function_name").distinct()


@register("reachability", "K1,C3", f"""
WITH RECURSIVE {GO_EDGES},
r(source, node, depth) USING KEY (source, node) AS (
  SELECT 'Get' || k, 'Get' || k, 0 FROM p
  UNION SELECT r.source, e.dst, r.depth + 1 FROM r JOIN e ON e.src = r.node
  LEFT JOIN recurring.r x ON x.source = r.source AND x.node = e.dst WHERE x.node IS NULL)
SELECT source, node AS function_name, depth FROM r""")
def q_reachability(spark, sf_dir):
    facts = go_facts(spark, sf_dir)
    edges, _ = go_edges(spark, sf_dir, facts)
    src = router_functions(spark, sf_dir, facts).select(F.col("function_name").alias("source"))
    return A.reachable(edges, src)


@register("effect_slice", "K1,G7", f"""
WITH RECURSIVE {GO_EDGES},
up AS (SELECT 'F' || (k // 2) AS src, 'F' || k AS dst FROM p WHERE k % 40 = 0
       UNION SELECT 'F' || (k // 8), 'F' || k FROM p WHERE k % 56 = 0
       UNION SELECT 'F' || k, 'Get' || (k // 2) FROM p WHERE k % 64 = 0 AND k > 0),
g AS (SELECT * FROM e UNION SELECT * FROM up),
r(source, node) AS (
  SELECT 'Get' || k, 'Get' || k FROM p
  UNION SELECT r.source, g.dst FROM r JOIN g ON g.src = r.node)
SELECT source, node AS function_name, kind,
       CASE kind WHEN 'db' THEN 'db.Query("SELECT * FROM t WHERE id = ?", ' || substr(node, 4) || ')'
                 ELSE 'part ' || substr(node, 4) || ' not found' END AS effect
FROM r, (VALUES ('db'), ('error')) v(kind) WHERE node LIKE 'Get%'""")
def q_effect_slice(spark, sf_dir):
    facts = go_facts(spark, sf_dir)
    edges, _ = go_edges(spark, sf_dir, facts)
    # calls from small functions to large ones: cycles of two and of four, and ways to effects
    k = F.col("p_partkey")
    part = table(spark, sf_dir, "part").select("p_partkey")
    up = [part.where(cond).select(name("F", a).alias("src"), name(to, b).alias("dst"))
          for cond, a, to, b in ((k % 40 == 0, F.floor(k / 2), "F", k), (k % 56 == 0, F.floor(k / 8), "F", k),
                                 ((k % 64 == 0) & (k > 0), k, "Get", F.floor(k / 2)))]
    for more in up:
        edges = edges.unionByName(more)
    sets = G.function_sets(facts[1]).where(F.col("kind").isin("db", "error"))
    return A.effect_slice(edges, router_functions(spark, sf_dir, facts).withColumnRenamed("function_name", "source"),
                          sets.select("function_name", "kind", F.col("value").alias("effect")))


@register("backward_slice", "K2", f"""
WITH RECURSIVE {GO_EDGES},
f0 AS (SELECT 'F' || k AS src, 'Get' || (k // 2) AS dst FROM p WHERE k % 64 = 0 AND k > 0),
r(source, node, depth) USING KEY (source, node) AS (
  SELECT 'Get' || k, 'Get' || k, 0 FROM p
  UNION SELECT r.source, e.src, r.depth + 1 FROM r JOIN (SELECT * FROM e UNION SELECT * FROM f0) e ON e.dst = r.node
  LEFT JOIN recurring.r x ON x.source = r.source AND x.node = e.src WHERE x.node IS NULL)
SELECT source, node AS function_name, depth FROM r""")
def q_backward(spark, sf_dir):
    facts = go_facts(spark, sf_dir)
    edges, _ = go_edges(spark, sf_dir, facts)
    # a few functions that call handlers, which are the ones with database and error effects
    k = F.col("p_partkey")
    more = table(spark, sf_dir, "part").where((k % 64 == 0) & (k > 0)).select(
        F.concat(F.lit("F"), k.cast("string")).alias("src"),
        F.concat(F.lit("Get"), F.floor(k / 2).cast("string")).alias("dst"))
    return A.backward_slice(edges.unionByName(more).distinct(), A.effects(facts[1]))


@register("orphan_functions", "K3", f"""
WITH {GO_EDGES}
SELECT n AS function_name FROM names
WHERE n NOT IN (SELECT dst FROM e) AND n NOT LIKE 'Get%'""")
def q_orphans(spark, sf_dir):
    facts = go_facts(spark, sf_dir)
    edges, fns = go_edges(spark, sf_dir, facts)
    handlers = router_functions(spark, sf_dir, facts).select(F.col("function_name").alias("handler_symbol"))
    return A.orphan_functions(fns, edges, handlers)


EPFR = """
rr AS (SELECT l_orderkey AS o, l_linenumber AS ln, min(l_partkey) AS pk FROM lineitem GROUP BY 1, 2),
fo AS (SELECT o, arg_min(pk, ln) AS pk FROM rr GROUP BY o),
epfr AS (SELECT DISTINCT 'EP-' || fo.pk AS ep_id, 'FR-' || o_custkey AS fr_id
         FROM orders JOIN fo ON fo.o = o_orderkey WHERE o_orderkey % 7 <= 3)"""


@register("endpoint_coverage", "K4", f"""
WITH {EPFR}
SELECT count(*) FILTER (WHERE 'EP-' || p_partkey IN (SELECT ep_id FROM epfr)) AS mapped, count(*) AS total
FROM part""")
def q_coverage(spark, sf_dir):
    return A.endpoint_coverage(entry_points(spark, sf_dir), L.endpoint_requirements(spec_evidence(spark, sf_dir)))


@register("uncovered_endpoints", "K4", f"""
WITH {EPFR}
SELECT 'EP-' || p_partkey AS ep_id FROM part WHERE 'EP-' || p_partkey NOT IN (SELECT ep_id FROM epfr)""")
def q_uncovered(spark, sf_dir):
    return A.uncovered_endpoints(entry_points(spark, sf_dir), L.endpoint_requirements(spec_evidence(spark, sf_dir)))


@register("enum_consistency", "K5", """
WITH c AS (SELECT p_type AS value FROM part UNION SELECT CAST(p_size AS VARCHAR) FROM part
           UNION SELECT p_name FROM part UNION SELECT CAST(p_partkey AS VARCHAR) FROM part),
l AS (SELECT c_mktsegment AS value FROM customer UNION SELECT 'N' || c_nationkey FROM customer),
o AS (SELECT p_brand AS value FROM part UNION SELECT 'K' || p_partkey FROM part UNION SELECT p_type FROM part),
v AS (SELECT value FROM c UNION SELECT value FROM l UNION SELECT value FROM o)
SELECT value, value IN (SELECT value FROM c) AS in_consts, value IN (SELECT value FROM l) AS in_labels,
       value IN (SELECT value FROM o) AS in_options FROM v""")
def q_enum(spark, sf_dir):
    consts = G.consts(masked(spark, sf_dir))
    labels = C.translator_labels(translator_files(spark, sf_dir))
    options = C.select_options(C.split_sfc(component_files(spark, sf_dir)))
    return A.enum_consistency(consts, labels, options)


@register("requirement_counts", "K6", CLIENT_REQ_CTE + """,
req AS (SELECT c_mktsegment AS domain, 'backend' AS side FROM customer
        UNION ALL SELECT type, 'client' FROM u)
SELECT domain, side, GROUPING_ID(domain, side) AS level, count(*) AS n FROM req GROUP BY ROLLUP (domain, side)""")
def q_req_counts(spark, sf_dir):
    feats = spec_features(spark, sf_dir).select("domain", F.lit("backend").alias("side"))
    client = L.client_requirement_rows(routes(spark, sf_dir), components(spark, sf_dir),
                                       C.store_getters(store_files(spark, sf_dir)), api(spark, sf_dir),
                                       entry_points(spark, sf_dir), spec_evidence(spark, sf_dir))
    reqs = feats.unionByName(client.select(F.col("type").alias("domain"), F.lit("client").alias("side")))
    return A.requirement_counts(reqs)


@register("phase_inventory", "P1", """
SELECT 'go_files' AS artifact, count(*) AS n_rows, CASE WHEN count(*) > 0 THEN 'done' ELSE 'empty' END AS status
FROM part
UNION ALL SELECT 'go_functions', 2 * count(*), CASE WHEN count(*) > 0 THEN 'done' ELSE 'empty' END FROM part
UNION ALL SELECT 'components', count(*), CASE WHEN count(*) > 0 THEN 'done' ELSE 'empty' END FROM part
UNION ALL SELECT 'routes', count(*) + count(*) FILTER (WHERE s_suppkey % 5 = 0),
       CASE WHEN count(*) > 0 THEN 'done' ELSE 'empty' END FROM supplier""")
def q_inventory(spark, sf_dir):
    gf = go_files(spark, sf_dir)
    return A.phase_inventory({
        "go_files": gf,
        "go_functions": G.functions(G.masked_files(gf)),
        "components": components(spark, sf_dir),
        "routes": routes(spark, sf_dir),
    })


@register("phase_states", "P1", """
WITH rules AS (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)
SELECT 'rules' AS phase, 'done' AS state, (SELECT count(*) FROM rules) AS n_rows, NULL AS error
UNION ALL SELECT 'client', 'skipped', NULL, 'PATH_NOT_FOUND'
UNION ALL SELECT 'sizes', 'failed', NULL, 'UNRESOLVED_COLUMN.WITH_SUGGESTION'
UNION ALL SELECT 'labels', 'failed', NULL, 'NEEDS client, sizes'
UNION ALL SELECT 'endpoints', 'done', count(DISTINCT l_partkey), NULL FROM (
  SELECT min(l_partkey) AS l_partkey FROM lineitem GROUP BY l_orderkey, l_linenumber)""")
def q_phase_states(spark, sf_dir):
    base = f"{checkpoint_dir(spark).rstrip('/')}/phases-{uuid.uuid4().hex}"
    part = table(spark, sf_dir, "part")
    return A.run_phases(spark, {
        "rules": (lambda: rule_records(spark, sf_dir), ()),
        "client": (lambda: read_source_tree(spark, f"{sf_dir}/no_client", ".vue"), ()),
        "sizes": (lambda: part.select("p_width"), ()),
        "labels": (lambda: part, ("rules", "client", "sizes")),
        "endpoints": (lambda: spark.read.parquet(f"{base}/rules").select("partkey").distinct(), ("rules",)),
    }, base)
