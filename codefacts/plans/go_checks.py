"""Contract queries for Go fact extraction (G-rows) and the call graph built
from it, on the generated Go corpus."""

from __future__ import annotations

from pyspark.sql import functions as F

from codefacts.operators import callgraph as cg
from codefacts.operators import gofacts as G
from codefacts.plans.corpus_go import go_files
from codefacts.plans.registry import register
from codefacts.session import cut

GOFILE = "'go/p' || p_partkey || '.go'"
PNAME = ("CASE p_partkey % 3 WHEN 0 THEN 'get' || p_partkey || 'Param' "
         "WHEN 1 THEN 'Get' || p_partkey || 'Param' END")
NEXT = ("CASE (p_partkey // 2) % 3 WHEN 0 THEN 'get' || (p_partkey // 2) || 'Param' "
        "WHEN 1 THEN 'Get' || (p_partkey // 2) || 'Param' ELSE 'Missing' || (p_partkey // 2) END")


def masked(spark, sf_dir):
    return G.masked_files(go_files(spark, sf_dir))


def go_calls_df(spark, sf_dir):
    return G.calls(G.functions(masked(spark, sf_dir)))


@register("go_functions", "G1,G2,S1", f"""
SELECT {GOFILE} AS path, 'Get' || p_partkey AS function_name, '(h *Handler)' AS receiver,
       'func (h *Handler) Get' || p_partkey ||
       '(w http.ResponseWriter, r *http.Request) (map[string]interface{{}}, error)' AS signature
FROM part
UNION ALL
SELECT {GOFILE}, 'F' || p_partkey, NULL, 'func F' || p_partkey || '(x int) int' FROM part""")
def q_go_functions(spark, sf_dir):
    return G.functions(masked(spark, sf_dir)).select("path", "function_name", "receiver", "signature")


@register("go_calls", "G3,G4,G5,G6,Q3", f"""
WITH p AS (SELECT {GOFILE} AS path, p_partkey AS k, p_partkey // 2 AS h, p_partkey // 3 AS t FROM part)
SELECT path, 'Get' || k AS function_name, 0 AS ord, 'db' AS kind, 'db.Query' AS callee,
       'db.Query("SELECT * FROM t WHERE id = ?", ' || k || ')' AS full_call FROM p
UNION ALL SELECT path, 'Get' || k, 1, 'error', 'errors.New', 'errors.New("part ' || k || ' not found")' FROM p
UNION ALL SELECT path, 'Get' || k, 2, 'call', 'F' || h, 'F' || h || '(len(s))' FROM p
UNION ALL SELECT path, 'Get' || k, 3, 'call', 'len', 'len(s)' FROM p
UNION ALL SELECT path, 'Get' || k, 4, 'call', 'svc.F' || t, 'svc.F' || t || '(fmt.Sprintf("%d", v))' FROM p
UNION ALL SELECT path, 'Get' || k, 5, 'call', 'fmt.Sprintf', 'fmt.Sprintf("%d", v)' FROM p
UNION ALL SELECT path, 'Get' || k, 6, 'router', 'r.GET', 'r.GET("/p/' || k || '", h.Get' || k || ')' FROM p
UNION ALL SELECT path, 'Get' || k, 7, 'call', 'http.Get', 'http.Get("http://x/' || k || '")' FROM p
UNION ALL SELECT path, 'F' || k, 0, 'call', 'F' || h, 'F' || h || '(x - 1)' FROM p""")
def q_go_calls(spark, sf_dir):
    return go_calls_df(spark, sf_dir).select("path", "function_name", "ord", "kind", "callee", "full_call")


@register("go_error_messages", "G7", f"""
SELECT {GOFILE} AS path, 'Get' || p_partkey AS function_name,
       'part ' || p_partkey || ' not found' AS message FROM part""")
def q_go_errors(spark, sf_dir):
    return G.error_messages(go_calls_df(spark, sf_dir)).select("path", "function_name", "message")


@register("go_function_sets", "G8", f"""
WITH p AS (SELECT {GOFILE} AS path, p_partkey AS k, p_partkey // 2 AS h, p_partkey // 3 AS t FROM part)
SELECT DISTINCT * FROM (
SELECT path, 'Get' || k AS function_name, 'db' AS kind,
       'db.Query("SELECT * FROM t WHERE id = ?", ' || k || ')' AS value FROM p
UNION ALL SELECT path, 'Get' || k, 'error', 'part ' || k || ' not found' FROM p
UNION ALL SELECT path, 'Get' || k, 'router', 'r.GET("/p/' || k || '", h.Get' || k || ')' FROM p
UNION ALL SELECT path, 'Get' || k, 'call', c FROM p,
  (VALUES ('len'), ('fmt.Sprintf'), ('http.Get')) v(c)
UNION ALL SELECT path, 'Get' || k, 'call', 'F' || h FROM p
UNION ALL SELECT path, 'Get' || k, 'call', 'svc.F' || t FROM p
UNION ALL SELECT path, 'F' || k, 'call', 'F' || h FROM p)""")
def q_go_sets(spark, sf_dir):
    return G.function_sets(go_calls_df(spark, sf_dir)).select("path", "function_name", "kind", "value")


@register("go_structs", "G9", f"""
SELECT {GOFILE} AS path, {PNAME} AS name FROM part WHERE p_partkey % 3 <> 2
UNION ALL SELECT {GOFILE}, 'Get' || p_partkey || 'Resp' FROM part WHERE p_partkey % 2 = 0
UNION ALL SELECT {GOFILE}, 'Base' FROM part WHERE p_partkey = 0""")
def q_go_structs(spark, sf_dir):
    return G.structs(masked(spark, sf_dir)).select("path", "name")


@register("go_struct_fields", "G9", f"""
WITH p AS (SELECT {GOFILE} AS path, p_partkey AS k, p_size AS z, {PNAME} AS pname, {NEXT} AS nxt FROM part)
SELECT path, pname AS struct, 'ID' AS name, 'int64' AS type, 'json:"id' AS tag FROM p WHERE pname IS NOT NULL
UNION ALL SELECT path, pname, 'Alt', 'int64', 'json:"id' FROM p WHERE pname IS NOT NULL
UNION ALL SELECT path, pname, 'Name', 'string', 'json:"name,omitempty' FROM p WHERE pname IS NOT NULL
UNION ALL SELECT path, pname, 'Price', 'float64', NULL FROM p WHERE pname IS NOT NULL
UNION ALL SELECT path, pname, 'Next', '*' || nxt, NULL FROM p WHERE pname IS NOT NULL
UNION ALL SELECT path, pname, 'Session', 'sessionID', NULL FROM p WHERE pname IS NOT NULL AND z % 4 = 0
UNION ALL SELECT path, 'Get' || k || 'Resp', 'Total', 'int', 'json:"total' FROM p WHERE k % 2 = 0
UNION ALL SELECT path, 'Get' || k || 'Resp', 'Items', '[]*' || coalesce(pname, 'Base'), 'json:"items'
FROM p WHERE k % 2 = 0
UNION ALL SELECT path, 'Base', 'Version', 'int', NULL FROM p WHERE k = 0""")
def q_go_fields(spark, sf_dir):
    return G.struct_fields(G.structs(masked(spark, sf_dir))).select("path", "struct", "name", "type", "tag")


@register("go_imports", "G10", f"""
SELECT {GOFILE} AS path, 0::BIGINT AS ord, 'errors' AS import_path FROM part
UNION ALL SELECT {GOFILE}, 1, 'fmt' FROM part
UNION ALL SELECT {GOFILE}, 1000000000, 'net/http' FROM part""")
def q_go_imports(spark, sf_dir):
    return G.imports(masked(spark, sf_dir))


@register("go_consts", "G11", f"""
SELECT {GOFILE} AS path, 'Kind' || p_partkey AS name, 'Status' AS type, p_type AS value FROM part
UNION ALL SELECT {GOFILE}, 'Size' || p_partkey, NULL, CAST(p_size AS VARCHAR) FROM part
UNION ALL SELECT {GOFILE}, 'Spare' || p_partkey, NULL, NULL FROM part
UNION ALL SELECT {GOFILE}, 'Name' || p_partkey, NULL, p_name FROM part
UNION ALL SELECT {GOFILE}, 'Code' || p_partkey, NULL, CAST(p_partkey AS VARCHAR) FROM part""")
def q_go_consts(spark, sf_dir):
    return G.consts(masked(spark, sf_dir)).select("path", "name", "type", "value")


@register("go_interfaces", "G12,Q18", f"""
SELECT {GOFILE} AS path, 'Store' || p_partkey AS interface, 'Load' AS method,
       'Load(id int64) (string, error)' AS signature FROM part
UNION ALL SELECT {GOFILE}, 'Store' || p_partkey, 'Save', 'Save(p *Base) error' FROM part""")
def q_go_interfaces(spark, sf_dir):
    return G.interfaces(masked(spark, sf_dir)).select("path", "interface", "method", "signature")


@register("go_file_documents", "G13", f"""
SELECT {GOFILE} AS file_path, 'errors|fmt|net/http' AS imports,
  'Kind' || p_partkey || '|Size' || p_partkey || '|Spare' || p_partkey || '|Name' || p_partkey || '|Code' || p_partkey
    AS consts,
  'Store' || p_partkey || ':Load,Save' AS interfaces,
  concat_ws('|', CASE WHEN p_partkey = 0 THEN 'Base' END, {PNAME},
            CASE WHEN p_partkey % 2 = 0 THEN 'Get' || p_partkey || 'Resp' END) AS structs,
  'Get' || p_partkey || '|F' || p_partkey AS functions,
  'part ' || p_partkey || ' not found' AS error_messages,
  'r.GET("/p/' || p_partkey || '", h.Get' || p_partkey || ')' AS entry_points FROM part""")
def q_go_documents(spark, sf_dir):
    docs = G.file_documents(go_files(spark, sf_dir))
    d = F.from_json("document", "imports array<string>, consts array<struct<name:string>>, "
                    "interfaces array<struct<name:string, methods:array<struct<name:string>>>>, "
                    "structs array<struct<name:string>>, functions array<struct<function_name:string, "
                    "error_messages:array<string>, entry_points:array<string>>>")
    r = docs.select("file_path", d.alias("d")).select("file_path", "d.*")

    def joined(c, item):
        return F.array_join(F.transform(c, item), "|").alias(c)
    return r.select(
        "file_path", F.array_join("imports", "|").alias("imports"), joined("consts", lambda x: x["name"]),
        joined("interfaces", lambda x: F.concat(x["name"], F.lit(":"), F.array_join(
            F.transform(x["methods"], lambda m: m["name"]), ","))),
        F.coalesce(joined("structs", lambda x: x["name"]), F.lit("")).alias("structs"),
        joined("functions", lambda x: x["function_name"]),
        F.array_join(F.flatten("functions.error_messages"), "|").alias("error_messages"),
        F.array_join(F.flatten("functions.entry_points"), "|").alias("entry_points"))


def go_graph_inputs(spark, sf_dir):
    # functions and calls are extracted once; the graph reads both several times
    fns = cut(G.functions(masked(spark, sf_dir)), rebalance=False)
    cl = cut(G.calls(fns).where(F.col("kind") == "call")
             .select("path", "function_ord", "function_name", "callee").distinct(), rebalance=False)
    return fns.select("path", "ord", "function_name"), cl


@register("go_call_edges", "G8,C4,C6", f"""
WITH p AS (SELECT p_partkey AS k, p_partkey // 2 AS h, p_partkey // 3 AS t FROM part),
names AS (SELECT 'F' || k AS n FROM p UNION ALL SELECT 'Get' || k FROM p)
SELECT 'Get' || k AS caller, 'F' || h AS callee FROM p WHERE 'F' || h IN (SELECT n FROM names)
UNION SELECT 'Get' || k, 'svc.F' || t FROM p WHERE 'F' || t IN (SELECT n FROM names)
UNION SELECT 'F' || k, 'F' || h FROM p WHERE 'F' || h IN (SELECT n FROM names)""")
def q_go_edges(spark, sf_dir):
    fns, cl = go_graph_inputs(spark, sf_dir)
    return cg.call_edges(fns, cl)
