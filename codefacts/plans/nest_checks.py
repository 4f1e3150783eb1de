"""Contract queries for Go declarations inside declarations and for calls on
results (G1, G3, G9, G11, G12), on the nested Go corpus."""

from __future__ import annotations

from codefacts.operators import gofacts as G
from codefacts.plans.corpus_go import nest_files
from codefacts.plans.registry import register

PART = """WITH p AS (SELECT 'nest/p' || p_partkey || '.go' AS path, p_partkey AS k, p_size AS z, p_name AS name FROM part)
"""
DEEP = "CASE WHEN z % 2 = 0 THEN '\t\t\tPos, End struct { Line' || z || ' []int }\n' ELSE '' END"


def masked(spark, sf_dir):
    return G.masked_files(nest_files(spark, sf_dir))


@register("go_grouped_structs", "G1,G9", PART + f"""
SELECT path, 'Outer' || k AS name, 'struct {{
		A' || k || ', B int `json:"a"`
		Meta struct {{
			Name string `json:"n' || z || '"` // "no tag"
' || {DEEP} || '		}} `json:"meta"`
		Call func(a int,
			b string) (int, error)
		Base
	}}' AS body FROM p
UNION ALL SELECT path, 'Side' || k, 'struct {{ Keys []K; Vals map[string]V }}' FROM p
UNION ALL SELECT path, 'loc' || k, 'struct {{ W' || z || ' int }}' FROM p""")
def q_grouped_structs(spark, sf_dir):
    return G.structs(masked(spark, sf_dir)).select("path", "name", "body")


@register("go_nested_fields", "G1,G9", PART + f"""
SELECT path, 'Outer' || k AS struct, NULL AS owner, 'A' || k AS name, 'int' AS type, 'json:"a' AS tag FROM p
UNION ALL SELECT path, 'Outer' || k, NULL, 'B', 'int', 'json:"a' FROM p
UNION ALL SELECT path, 'Outer' || k, NULL, 'Meta', 'struct {{
			Name string `json:"n' || z || '"` // "no tag"
' || {DEEP} || '		}}', 'json:"meta' FROM p
UNION ALL SELECT path, 'Outer' || k, 'Meta', 'Name', 'string', 'json:"n' || z FROM p
UNION ALL SELECT path, 'Outer' || k, 'Meta', n, 'struct {{ Line' || z || ' []int }}', NULL
FROM p, (VALUES ('Pos'), ('End')) v(n) WHERE z % 2 = 0
UNION ALL SELECT path, 'Outer' || k, 'Meta.' || n, 'Line' || z, '[]int', NULL
FROM p, (VALUES ('Pos'), ('End')) v(n) WHERE z % 2 = 0
UNION ALL SELECT path, 'Outer' || k, NULL, 'Call', 'func(a int,
			b string) (int, error)', NULL FROM p
UNION ALL SELECT path, 'Side' || k, NULL, 'Keys', '[]K', NULL FROM p
UNION ALL SELECT path, 'Side' || k, NULL, 'Vals', 'map[string]V', NULL FROM p
UNION ALL SELECT path, 'loc' || k, NULL, 'W' || z, 'int', NULL FROM p""")
def q_nested_fields(spark, sf_dir):
    return G.all_fields(G.structs(masked(spark, sf_dir))).select("path", "struct", "owner", "name", "type", "tag")


@register("go_const_lists", "G11", PART + """
SELECT path, 'A' || k AS name, NULL AS type, 'f(' || z || ', 2)' AS value FROM p
UNION ALL SELECT path, 'B' || k, NULL, 'x, ' || name FROM p
UNION ALL SELECT path, 'C' || k, NULL, 'g(1,
		' || k || ')' FROM p
UNION ALL SELECT path, 'D' || k, NULL, '' FROM p
UNION ALL SELECT path, 'E' || k, NULL, '[]int{1, ' || z || '}[0]' FROM p""")
def q_const_lists(spark, sf_dir):
    return G.consts(masked(spark, sf_dir)).select("path", "name", "type", "value")


@register("go_grouped_interfaces", "G1,G12", PART + """
SELECT path, 'Port' || k AS interface, 'Do' AS method, 'Do(f func(int) (string, error), n int) error' AS signature FROM p
UNION ALL SELECT path, 'Port' || k, 'Close', 'Close()' FROM p""")
def q_grouped_interfaces(spark, sf_dir):
    return G.interfaces(masked(spark, sf_dir)).select("path", "interface", "method", "signature")


@register("go_call_chains", "G3,G4", PART + """,
c AS (
SELECT path, k, 0 AS ord, 'open' || k || '(' || z || ').where("a, (b").
		done' AS callee, '(x.(T).get(' || k || '))' AS args FROM p
UNION ALL SELECT path, k, 1, 'open' || k || '(' || z || ').where', '("a, (b")' FROM p
UNION ALL SELECT path, k, 2, 'open' || k, '(' || z || ')' FROM p
UNION ALL SELECT path, k, 3, 'x.(T).get', '(' || k || ')' FROM p
UNION ALL SELECT path, k, 4, 'm[' || z || ']', '(2)' FROM p
UNION ALL SELECT path, k, 5, 'h', '[int, T' || k || '](x)' FROM p
UNION ALL SELECT path, k, 6, 'string', '(v.Hidden)' FROM p
UNION ALL SELECT path, k, 7, 'func(n int) (int, error) { return in' || k || '(n), nil }', '(' || z || ')' FROM p
UNION ALL SELECT path, k, 8, 'in' || k, '(n)' FROM p
UNION ALL SELECT path, k, 9, '(wrap)', '(b)' FROM p)
SELECT path, 'Chain' || k AS function_name, ord, 'call' AS kind, callee, callee || args AS full_call FROM c""")
def q_call_chains(spark, sf_dir):
    return G.calls(G.functions(masked(spark, sf_dir))).select("path", "function_name", "ord", "kind", "callee", "full_call")
