"""Contract queries for client extraction (H-rows) on the generated corpus."""

from __future__ import annotations

from pyspark.sql import functions as F

from codefacts.operators import client as C
from codefacts.plans.corpus_client import api_client_files, component_files, router_files
from codefacts.plans.registry import register
from codefacts.sources.tables import table

FILE = "'views/P' || p_partkey || '.vue'"


def components(spark, sf_dir):
    return C.split_sfc(component_files(spark, sf_dir))


@register("pages_script_split", "H9,S1", r"""
SELECT page_id, regexp_extract(html, '<script>([\s\S]*?)</script>', 1) AS script,
       regexp_extract(html, '<template>([\s\S]*?)</template>', 1) AS template
FROM pages""")
def q_pages_split(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select(F.col("page_id"), F.col("html").alias("content"))
    return (C.split_sfc(pages, "page_id").withColumnRenamed("file", "page_id")
            .select("page_id", "script", "template"))


@register("client_api_methods", "T1,T2,H4,H5,H6,Q17", r"""
SELECT 'api/p' || p_partkey || '.js' AS path, 'get' || p_partkey AS client_method,
       CASE WHEN p_partkey % 4 = 3 THEN 'GET'
            ELSE upper(['get', 'post', 'put'][p_partkey % 4 + 1]) END AS http_method,
       CASE WHEN p_partkey % 4 = 3 THEN ':param/api/v1/file/:param/' || p_partkey
            ELSE '/api/v1/' || lower(p_type) || '/' || p_partkey END AS url,
       'id,opts' AS params
FROM part
UNION ALL
SELECT 'api/p' || p_partkey || '.js', 'status' || p_partkey, 'POST',
       '/api/v1/status/${id}', 'id'
FROM part""")
def q_api_methods(spark, sf_dir):
    return (C.api_methods(api_client_files(spark, sf_dir))
            .select("path", "client_method", "http_method", "url",
                    F.array_join("params", ",").alias("params")))


CALLS_SQL = f"""
WITH c AS (SELECT {FILE} AS file, p_partkey AS k, p_size AS z,
                  CAST(p_size % 7 = 0 AS INTEGER) AS f7, CAST(p_size % 6 = 0 AS INTEGER) AS f6,
                  CAST(p_size % 2 = 0 AS INTEGER) AS f2 FROM part)
SELECT file, 'client' AS call_kind, 0 AS ord, 'finish' || k AS method FROM c WHERE f7 = 1
UNION ALL SELECT file, 'client', f7, 'get' || k FROM c
UNION ALL SELECT file, 'client', f7 + 1, 'legacy' || k FROM c
UNION ALL SELECT file, 'client', f7 + 2, 'fall' || k FROM c WHERE f6 = 1
UNION ALL SELECT file, 'client', f7 + 2 + f6, 'status' || k FROM c
UNION ALL SELECT file, 'dispatch', 0, 'fetchTerm' || z FROM c
UNION ALL SELECT file, 'this', 0, 'loadList' FROM c
UNION ALL SELECT file, 'this', 1, 'poll' FROM c WHERE f2 = 1
UNION ALL SELECT file, 'this', 1 + f2, 'refresh' FROM c
"""


@register("client_component_calls", "H10,H11,H12,T4", CALLS_SQL)
def q_component_calls(spark, sf_dir):
    return C.component_calls(components(spark, sf_dir))


@register("client_lifecycle_calls", "H13", f"""
SELECT {FILE} AS file, 'created' AS lifecycle_hook, 'dispatch' AS call_kind, 0 AS ord,
       'fetchTerm' || p_size AS method FROM part
UNION ALL SELECT {FILE}, 'created', 'indirect', 0, 'loadList' FROM part
UNION ALL SELECT {FILE}, 'mounted', 'indirect', 0, 'poll' FROM part WHERE p_size % 2 = 0""")
def q_lifecycle(spark, sf_dir):
    lc = C.lifecycle_calls(components(spark, sf_dir))
    parts = []
    for kind, col in (("direct", "direct_calls"), ("dispatch", "dispatch_calls"),
                      ("indirect", "indirect_calls")):
        parts.append(lc.select("file", "lifecycle_hook", F.lit(kind).alias("call_kind"),
                               F.posexplode(col).alias("ord", "method")))
    out = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return out.withColumn("ord", F.col("ord").cast("int"))


@register("client_polling", "H14", f"""
SELECT {FILE} AS file, p_size * 100 AS interval_ms, 'status' || p_partkey AS direct_calls,
       'refresh' AS indirect_calls, '' AS dispatch_calls,
       'res.data.isRegistrationDone == true' AS termination_condition,
       'isRegistrationDone == true' AS success_condition
FROM part""")
def q_polling(spark, sf_dir):
    p = C.polling(components(spark, sf_dir))
    return p.select("file", "interval_ms", *[F.array_join(c, ",").alias(c) for c in
                                             ("direct_calls", "indirect_calls", "dispatch_calls")],
                    "termination_condition", "success_condition")


@register("client_conditional_api", "H15,H16,H17", f"""
SELECT {FILE} AS file, 'template_ternary' AS pattern, 'semester === ''SPRING''' AS condition,
       'loadSpring' AS true_calls, 'loadFall' AS false_calls FROM part WHERE p_size % 4 = 0
UNION ALL SELECT {FILE}, 'script_ternary', 'const fn = this.type === ''A''', 'listA', 'listB'
FROM part WHERE p_size % 6 = 0
UNION ALL SELECT {FILE}, 'if_else', 'this.semester === ''FALL''', 'fall' || p_partkey, 'loadList'
FROM part WHERE p_size % 6 = 0""")
def q_conditional(spark, sf_dir):
    c = C.conditional_api(components(spark, sf_dir))
    return c.select("file", "pattern", "condition", F.array_join("true_calls", ",").alias("true_calls"),
                    F.array_join("false_calls", ",").alias("false_calls"))


@register("client_confirmation_guards", "H18,T3", f"""
SELECT {FILE} AS file, '종료합니다 ' || p_partkey AS required_text,
       'finish' || p_partkey AS nearby_api_calls FROM part WHERE p_size % 7 = 0""")
def q_confirm(spark, sf_dir):
    g = C.confirmation_guards(components(spark, sf_dir))
    return g.select("file", "required_text", F.array_join("nearby_api_calls", ",").alias("nearby_api_calls"))


@register("client_validation_messages", "H19,T3,T5", f"""
SELECT {FILE} AS file, 0 AS ord, '이름을 입력하세요 ' || p_partkey AS message,
       'this.form.name === ''''' AS condition, 'validation' AS type FROM part
UNION ALL
SELECT {FILE}, 1, ['저장되었습니다', '서버 오류입니다', '확인해 주세요'][p_size % 3 + 1],
       'this.form.name === ''''', ['success', 'error', 'info'][p_size % 3 + 1] FROM part""")
def q_messages(spark, sf_dir):
    return C.validation_messages(components(spark, sf_dir))


@register("client_disabled_guards", "H21", f"""
SELECT {FILE} AS file, 1 AS ord, 'status === ''FINISHED''' AS condition FROM part
WHERE p_size % 3 = 0""")
def q_disabled(spark, sf_dir):
    return C.disabled_guards(components(spark, sf_dir)).select("file", "ord", "condition")


@register("client_select_options", "H22", f"""
SELECT {FILE} AS file, 0 AS select_ord, 0 AS ord, p_brand AS value, p_type AS label FROM part
UNION ALL SELECT {FILE}, 0, 1, 'K' || p_partkey, p_name FROM part
UNION ALL SELECT {FILE}, 1, 0, p_type, p_type FROM part""")
def q_select_options(spark, sf_dir):
    return C.select_options(components(spark, sf_dir))


@register("client_page_title", "H23", f"SELECT {FILE} AS file, trim(p_name) AS page_title FROM part")
def q_title(spark, sf_dir):
    return components(spark, sf_dir).select("file", C.page_title("template").alias("page_title"))


@register("client_table_columns", "H24", f"""
SELECT {FILE} AS file, 0 AS ord, 'No' AS "column" FROM part
UNION ALL SELECT {FILE}, 1, p_type FROM part""")
def q_table_columns(spark, sf_dir):
    return C.table_columns(components(spark, sf_dir))


@register("client_form_fields", "H25,Q13", f"""
SELECT {FILE} AS file, 0 AS row_ord, 0 AS cell_ord, '*Name' AS label, 'form.name' AS v_model,
       'text' AS input_type, true AS required, false AS immutable FROM part
UNION ALL SELECT {FILE}, 1, 0, 'Size ' || p_size, 'form.size', 'text', false, true FROM part
UNION ALL SELECT {FILE}, 2, 0, 'Kind', 'form.kind', 'select', false, false FROM part""")
def q_form_fields(spark, sf_dir):
    return C.form_fields(components(spark, sf_dir))


@register("client_vfor_fields", "H26", f"""
SELECT {FILE} AS file, 'f' || p_size AS field FROM part
UNION ALL SELECT {FILE}, 'price' FROM part""")
def q_vfor(spark, sf_dir):
    c = components(spark, sf_dir)
    return c.select("file", F.explode(C.vfor_fields("template")).alias("field"))


@register("client_routes", "H1,H7,H8", r"""
WITH s AS (SELECT s_suppkey AS s, s_nationkey AS n FROM supplier)
SELECT '/s' || s AS path, 'S' || s AS name, 'src/views/P' || s || '.vue' AS component_file,
       s % 2 = 0 AS requires_auth, CAST(s % 16 AS INTEGER) AS permission_bitmask,
       concat_ws(',', CASE WHEN s % 16 & 1 <> 0 THEN 'Admin' END,
                 CASE WHEN s % 16 & 2 <> 0 THEN 'Employee' END,
                 CASE WHEN s % 16 & 4 <> 0 THEN 'Professor' END,
                 CASE WHEN s % 16 & 8 <> 0 THEN 'Student' END) AS required_roles,
       s % 3 = 0 AS needs_graduated, s % 3 = 1 AS needs_not_graduated
FROM s
UNION ALL
SELECT 'detail', NULL, 'src/views/D' || s || '.vue', false, NULL, '', false, false
FROM s WHERE s % 5 = 0""")
def q_routes(spark, sf_dir):
    r = C.routes(router_files(spark, sf_dir))
    return r.select("path", "name", "component_file", "requires_auth", "permission_bitmask",
                    F.array_join("required_roles", ",").alias("required_roles"),
                    "needs_graduated", "needs_not_graduated")
