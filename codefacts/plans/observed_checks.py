"""Contract queries for the earlier client extractor (J-rows) and the JS file
classification (S3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from codefacts.operators import observed as J
from codefacts.plans.corpus_client import (api_client_files, component_files, fill, router_files, spread,
                                           store_files, translator_files)
from codefacts.plans.registry import register
from codefacts.sources import files as S
from codefacts.sources.tables import table

FILE = "'views/P' || p_partkey || '.vue'"


def sections(spark, sf_dir):
    return J.sections(component_files(spark, sf_dir))


@register("j_api_calls", "J1", """
SELECT 'api/p' || p_partkey || '.js' AS file, 'axios' AS client, upper(['get', 'post', 'put'][p_partkey % 4 + 1])
       AS method, '/api/v1/' || lower(p_type) || '/' || p_partkey AS url,
       '/api/v1/' || lower(p_type) || '/' || p_partkey AS raw_url FROM part WHERE p_partkey % 4 <> 3
UNION ALL SELECT 'api/p' || p_partkey || '.js', 'axios', 'POST', '/api/v1/status/:param', '/api/v1/status/${id}'
FROM part
UNION ALL SELECT 'api/p' || p_partkey || '.js', 'axios', 'PUT', '/old/' || p_partkey, '/old/' || p_partkey
FROM part WHERE p_partkey % 11 = 0""")
def q_api_calls(spark, sf_dir):
    f = api_client_files(spark, sf_dir)
    return J.api_calls(f.select(F.col("path"), "content"), "content", "path").select(
        "file", "client", "method", "url", "raw_url")


@register("j_observable_facts", "J2,J3,J4,J5,J6,J8,J17,J19", f"""
SELECT {FILE} AS component, 'user_messages' AS fact_kind, 1000000000::BIGINT AS ord, '이름을 입력하세요 ' || p_partkey AS value
FROM part
UNION ALL SELECT {FILE}, 'user_messages', 1000000001, ['저장되었습니다', '서버 오류입니다', '확인해 주세요'][p_size % 3 + 1]
FROM part
UNION ALL SELECT {FILE}, 'conditional_renders', 0, 'role ===' FROM part WHERE p_size % 5 = 0
UNION ALL SELECT {FILE}, 'conditional_renders', CASE WHEN p_size % 5 = 0 THEN 1 ELSE 0 END, 'wide' FROM part
UNION ALL SELECT {FILE}, 'disabled_conditions', 0, 'true' FROM part
UNION ALL SELECT {FILE}, 'disabled_conditions', 1, 'status ===' FROM part WHERE p_size % 3 = 0
UNION ALL SELECT {FILE}, 'click_handlers', 0, 'semester ===' FROM part WHERE p_size % 4 = 0
UNION ALL SELECT {FILE}, 'click_handlers', CASE WHEN p_size % 4 = 0 THEN 1 ELSE 0 END, 'save()' FROM part
UNION ALL SELECT {FILE}, 'polling', 0, CAST(p_size * 100 AS VARCHAR) FROM part
UNION ALL SELECT {FILE}, 'lifecycle_calls', 0, 'loadList' FROM part
UNION ALL SELECT {FILE}, 'lifecycle_calls', 1, 'poll' FROM part WHERE p_size % 2 = 0""")
def q_facts(spark, sf_dir):
    return J.observable_facts(sections(spark, sf_dir)).select("component", "fact_kind", "ord", "value")


@register("j_fact_totals", "J18", """
SELECT 'user_messages' AS fact_kind, 2 * count(*) AS n FROM part
UNION ALL SELECT 'conditional_renders', count(*) + count(*) FILTER (WHERE p_size % 5 = 0) FROM part
UNION ALL SELECT 'disabled_conditions', count(*) + count(*) FILTER (WHERE p_size % 3 = 0) FROM part
UNION ALL SELECT 'click_handlers', count(*) + count(*) FILTER (WHERE p_size % 4 = 0) FROM part
UNION ALL SELECT 'polling', count(*) FROM part
UNION ALL SELECT 'lifecycle_calls', count(*) + count(*) FILTER (WHERE p_size % 2 = 0) FROM part""")
def q_fact_totals(spark, sf_dir):
    return J.fact_totals(J.observable_facts(sections(spark, sf_dir)))


@register("j_ui_strings", "J10,J9,J11,J20", f"""
WITH s AS (
  SELECT {FILE} AS file, 0 AS o, trim(p_name) AS v FROM part
  UNION ALL SELECT {FILE}, 1, 'Admin' FROM part WHERE p_size % 5 = 0
  UNION ALL SELECT {FILE}, 2, 'all' FROM part
  UNION ALL SELECT {FILE}, 3, p_type FROM part
  UNION ALL SELECT {FILE}, 4, 'Hidden' FROM part
  UNION ALL SELECT {FILE}, 5, 'Name' FROM part
  UNION ALL SELECT {FILE}, 6, 'Size ' || p_size FROM part
  UNION ALL SELECT {FILE}, 7, 'Kind' FROM part
  UNION ALL SELECT {FILE}, 8, 'Close' FROM part WHERE p_size % 3 = 0
  UNION ALL SELECT {FILE}, 9, 'Save' FROM part)
SELECT s.file, 'Part' || p_partkey AS component_name, string_agg(v, '|' ORDER BY o) AS ui_strings,
       CASE WHEN p_size % 5 = 0 THEN 'v-if="role === ''|role === ''admin''' ELSE '' END AS role_guards,
       'fetchTerm' || p_size AS vuex_dispatches
FROM s JOIN part ON s.file = {FILE} GROUP BY s.file, p_partkey, p_size""")
def q_ui_strings(spark, sf_dir):
    r = J.component_records(sections(spark, sf_dir))
    return r.select("file", "component_name", F.array_join("ui_strings", "|").alias("ui_strings"),
                    F.array_join("role_guards", "|").alias("role_guards"),
                    F.array_join("vuex_dispatches", "|").alias("vuex_dispatches"))


@register("j_store_api_map", "J12,J13", """
SELECT 'p' || p_partkey AS store_module,
       CASE WHEN p_partkey % 11 = 0 THEN 'get' || p_partkey || ',' ELSE '' END || 'status' || p_partkey
       AS action_names, 'POST' AS http_method, '/api/v1/status/:param' AS url FROM part
UNION ALL SELECT 'p' || p_partkey, CASE WHEN p_partkey % 11 = 0 THEN 'get' || p_partkey || ',' ELSE '' END
       || 'status' || p_partkey, upper(['get', 'post', 'put'][p_partkey % 4 + 1]),
       '/api/v1/' || lower(p_type) || '/' || p_partkey FROM part WHERE p_partkey % 4 <> 3
UNION ALL SELECT 'p' || p_partkey, 'get' || p_partkey || ',status' || p_partkey, 'PUT', '/old/' || p_partkey
FROM part WHERE p_partkey % 11 = 0""")
def q_store_api_map(spark, sf_dir):
    m = J.store_api_map(api_client_files(spark, sf_dir))
    return m.select("store_module", F.array_join("action_names", ",").alias("action_names"), "http_method", "url")


@register("j_route_segments", "J14", """
SELECT 'router/n' || s_nationkey || '_' || (s_suppkey // 64) || '.js' AS file, '/s' || s_suppkey AS route_path,
       'views/P' || s_suppkey || '.vue' AS component_path, NULL::BOOLEAN AS requires_auth FROM supplier
UNION ALL SELECT 'router/n' || s_nationkey || '_' || (s_suppkey // 64) || '.js', 'detail',
       'views/D' || s_suppkey || '.vue', NULL FROM supplier WHERE s_suppkey % 5 = 0""")
def q_route_segments(spark, sf_dir):
    return J.route_segments(router_files(spark, sf_dir)).select("file", "route_path", "component_path",
                                                                "requires_auth")


@register("j_component_map", "J15,J16", f"""
SELECT {FILE} AS component, 'Part' || p_partkey AS component_name, 0 AS n_api_calls, 1 AS n_dispatches,
       CASE WHEN p_partkey IN (SELECT s_suppkey FROM supplier) THEN 1 ELSE 0 END AS n_routes,
       CASE WHEN p_size % 5 = 0 THEN 2 ELSE 0 END AS n_role_guards FROM part""")
def q_component_map(spark, sf_dir):
    m = J.component_map_v1(sections(spark, sf_dir), J.route_segments(router_files(spark, sf_dir)))
    return m.select("component", "component_name", F.size("api_calls").cast("bigint").alias("n_api_calls"),
                    F.size("vuex_dispatches").cast("bigint").alias("n_dispatches"), "n_routes",
                    F.size("role_guards").cast("bigint").alias("n_role_guards"))


@register("js_classify", "S3", """
SELECT 'store/n' || c_nationkey || '_' || (c_custkey // 64) || '.js' AS path, 'store' AS kind FROM customer
UNION SELECT 'router/n' || s_nationkey || '_' || (s_suppkey // 64) || '.js', 'router' FROM supplier
UNION SELECT 'plugins/n' || c_nationkey || '_' || (c_custkey // 64) || '.js', 'other' FROM customer
UNION SELECT 'api/p' || p_partkey || '.js', 'other' FROM part""")
def q_classify(spark, sf_dir):
    fs = (store_files(spark, sf_dir).unionByName(router_files(spark, sf_dir))
          .unionByName(translator_files(spark, sf_dir)).unionByName(api_client_files(spark, sf_dir)))
    return fs.select("path", S.js_kind("path").alias("kind"))


STYLES_FILE = """<template><b v-if="open">x</b></template>
<script>
export default {
  methods: {
    load() {
      this.@@flag@@ = true
      this.$http.put(`/c/@@k@@/${id}`)
      fetch('/f/@@k@@', { body, method: 'delete' })
      fetch("/g/@@k@@")
      this.$toast.error('toast @@k@@')
      alert("alert @@k@@")
      if (confirm('confirm @@k@@')) { this.$message.warning('message @@k@@') }
      this.$notify({ title: 'x', message: 'notify @@k@@' })
      this.$swal({ icon: 'x', title: 'title @@k@@' })
      alert("toast @@k@@")
      this.@@flag@@ = @@end@@
    }
  }
}
</script>
"""
STYLE_ROUTES = """export default [
  { path: '/x@@k@@', component: () => import('@/views/X@@k@@.vue'), meta: { requiresAuth: @@auth@@, roles: ['R@@k@@', "Staff"] } },
  { path: '/y@@k@@', component: Y@@k@@,
    meta: {} },
  { path: '/z@@k@@' },
]
"""


def style_files(spark, sf_dir):
    """One component per ``supplier`` in the styles that the other corpora do not
    use; the loading flag is reset when the key is even, not named as one when
    it is a multiple of 5."""
    s = spread(table(spark, sf_dir, "supplier").select("s_suppkey"))
    k = F.col("s_suppkey")
    return s.select(F.concat(F.lit("styles/S"), k.cast("string"), F.lit(".vue")).alias("path"), fill(
        STYLES_FILE, k=k, flag=F.when(k % 5 == 0, F.lit("wanted")).otherwise(F.lit("isLoading")),
        end=F.when(k % 2 == 0, F.lit("false")).otherwise(F.lit("true"))).alias("content"))


@register("j_component_records", "J1,J2,J7,J21", """
SELECT 'styles/S' || s_suppkey || '.vue' AS file, 'S' || s_suppkey AS component_name,
  'vue-resource PUT /c/' || s_suppkey || '/:param|fetch DELETE /f/' || s_suppkey || '|fetch GET /g/' || s_suppkey AS api_calls,
  'title ' || s_suppkey || '|toast ' || s_suppkey || '|alert ' || s_suppkey || '|confirm ' || s_suppkey
    || '|message ' || s_suppkey || '|notify ' || s_suppkey AS user_messages,
  s_suppkey % 2 = 0 AND s_suppkey % 5 <> 0 AS has_loading_state, 'open' AS conditional_renders FROM supplier""")
def q_component_records(spark, sf_dir):
    r = J.component_records(J.sections(style_files(spark, sf_dir)))
    calls = F.transform("api_calls", lambda c: F.concat_ws(" ", c["client"], c["method"], c["url"]))
    return r.select("file", "component_name", F.array_join(calls, "|").alias("api_calls"),
                    F.array_join(F.transform("user_messages", lambda m: m["message"]), "|").alias("user_messages"),
                    "has_loading_state", F.array_join("conditional_renders", "|").alias("conditional_renders"))


@register("j_route_access", "J14", """
SELECT 'router/s' || s_suppkey || '.js' AS file, '/x' || s_suppkey AS route_path,
       'views/X' || s_suppkey || '.vue' AS component_path, s_suppkey % 3 = 0 AS requires_auth,
       'R' || s_suppkey || ',Staff' AS roles FROM supplier
UNION ALL SELECT 'router/s' || s_suppkey || '.js', '/y' || s_suppkey, 'Y' || s_suppkey, NULL, NULL FROM supplier
UNION ALL SELECT 'router/s' || s_suppkey || '.js', '/z' || s_suppkey, NULL, NULL, NULL FROM supplier""")
def q_route_access(spark, sf_dir):
    s = spread(table(spark, sf_dir, "supplier").select("s_suppkey"))
    k = F.col("s_suppkey")
    files = s.select(F.concat(F.lit("router/s"), k.cast("string"), F.lit(".js")).alias("path"), fill(
        STYLE_ROUTES, k=k, auth=F.when(k % 3 == 0, F.lit("true")).otherwise(F.lit("false"))).alias("content"))
    return J.route_segments(files).select("file", "route_path", "component_path", "requires_auth",
                                          F.array_join("roles", ",").alias("roles"))
