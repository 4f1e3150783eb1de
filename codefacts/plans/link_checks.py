"""Contract queries for store/translator extraction (H2, H3, H28-H30) and
client linking (L1-L15) on the generated client corpus."""

from __future__ import annotations

from pyspark.sql import functions as F

from codefacts.operators import client as C
from codefacts.operators import linking as L
from codefacts.plans.corpus_client import (api_client_files, component_files, router_files, store_files,
                                           translator_files)
from codefacts.plans.corpus_trace import entry_points, spec_evidence
from codefacts.plans import registry
from codefacts.plans.client_checks import CALLS_SQL
from codefacts.plans.registry import register
from codefacts.session import cut, shuffled
from codefacts.sources.tables import table

CHUNK = "'/n' || c_nationkey || '_' || (c_custkey // 64) || '.js'"
API_SQL = """
api AS (SELECT 'get' || p_partkey AS client_method,
               CASE WHEN p_partkey % 4 = 3 THEN 'GET'
                    ELSE upper(['get', 'post', 'put'][p_partkey % 4 + 1]) END AS http_method,
               CASE WHEN p_partkey % 4 = 3 THEN ':param/api/v1/file/:param/' || p_partkey
                    ELSE '/api/v1/' || lower(p_type) || '/' || p_partkey END AS url
        FROM part
        UNION ALL SELECT 'status' || p_partkey, 'POST', '/api/v1/status/${id}' FROM part)"""


def components(spark, sf_dir):
    return C.split_sfc(component_files(spark, sf_dir))


def api(spark, sf_dir):
    return C.api_methods(api_client_files(spark, sf_dir))


def routes(spark, sf_dir):
    return C.routes(router_files(spark, sf_dir))


@register("store_actions", "H28", f"""
WITH {API_SQL}
SELECT 'store' || {CHUNK} AS path, 'load' || c_custkey AS action, 'get' || c_custkey AS client_method, api.url
FROM customer LEFT JOIN api ON api.client_method = 'get' || c_custkey WHERE c_custkey % 4 <> 0""")
def q_store_actions(spark, sf_dir):
    a = C.store_actions(store_files(spark, sf_dir))
    return (a.join(shuffled(L.api_map(api(spark, sf_dir))), "client_method", "left")
            .select("path", "action", "client_method", "url"))


@register("store_getters", "H29", f"""
SELECT 'store' || {CHUNK} AS path, 'seg' || c_custkey AS getter,
       'state.segment === ''' || c_mktsegment || '''' AS filter_condition
FROM customer WHERE c_custkey % 3 <> 0""")
def q_store_getters(spark, sf_dir):
    return C.store_getters(store_files(spark, sf_dir)).select("path", "getter", "filter_condition")


@register("store_state", "H30", """
SELECT DISTINCT 'store/n' || c_nationkey || '_' || (c_custkey // 64) || '.js' AS path, 0 AS ord,
       'term' || c_nationkey AS field FROM customer
UNION ALL SELECT DISTINCT 'store/n' || c_nationkey || '_' || (c_custkey // 64) || '.js', 1,
       'segment' || c_nationkey FROM customer""")
def q_store_state(spark, sf_dir):
    return C.store_state(store_files(spark, sf_dir))


@register("translator_labels", "H2", f"""
SELECT 'plugins' || {CHUNK} AS path, 'seg' || c_custkey AS fn, c_mktsegment AS value, c_name AS label
FROM customer
UNION ALL SELECT 'plugins' || {CHUNK}, 'seg' || c_custkey, 'N' || c_nationkey, 'nation ' || c_nationkey
FROM customer""")
def q_translator(spark, sf_dir):
    return C.translator_labels(translator_files(spark, sf_dir)).select("path", "fn", "value", "label")


def segment_domains(spark, sf_dir):
    """Rename map for the display-label check: ``seg<c> -> c_mktsegment`` for
    customers with c % 10 = 0 (several functions share a domain)."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment").where(F.col("c_custkey") % 10 == 0)
    return c.select(F.concat(F.lit("seg"), F.col("c_custkey").cast("string")).alias("fn"),
                    F.col("c_mktsegment").alias("domain"))


@register("display_labels", "H3,L7", f"""
WITH f AS (SELECT 'plugins' || {CHUNK} AS path, c_custkey AS c,
                  CASE WHEN c_custkey % 10 = 0 THEN c_mktsegment ELSE 'seg' || c_custkey END AS domain,
                  c_mktsegment, c_name, c_nationkey FROM customer),
w AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY domain ORDER BY path DESC, c DESC) AS rn FROM f)
      WHERE rn = 1)
SELECT domain, c_mktsegment AS value, c_name AS label FROM w
UNION ALL SELECT domain, 'N' || c_nationkey, 'nation ' || c_nationkey FROM w""")
def q_display_labels(spark, sf_dir):
    labels = C.translator_labels(translator_files(spark, sf_dir))
    return L.display_labels(labels, segment_domains(spark, sf_dir))


ROUTE_OF = """CASE WHEN p_partkey IN (SELECT s_suppkey FROM supplier) THEN '/s' || p_partkey END"""
ROLES_OF = """CASE WHEN p_partkey IN (SELECT s_suppkey FROM supplier) THEN concat_ws(',',
    CASE WHEN p_partkey % 16 & 1 <> 0 THEN 'Admin' END, CASE WHEN p_partkey % 16 & 2 <> 0 THEN 'Employee' END,
    CASE WHEN p_partkey % 16 & 4 <> 0 THEN 'Professor' END, CASE WHEN p_partkey % 16 & 8 <> 0 THEN 'Student' END)
    ELSE '' END"""


@register("component_routes", "L5,Q20", f"""
SELECT 'views/P' || p_partkey || '.vue' AS file, {ROUTE_OF} AS route, {ROLES_OF} AS required_roles FROM part""")
def q_component_routes(spark, sf_dir):
    r = L.component_routes(components(spark, sf_dir), routes(spark, sf_dir))
    return r.select("file", "route", F.array_join("required_roles", ",").alias("required_roles"))


@register("component_routes_suffix", "L5", f"""
SELECT 'views/P' || p_partkey || '.vue' AS file, {ROUTE_OF} AS route FROM part""")
def q_component_routes_suffix(spark, sf_dir):
    return L.component_routes(components(spark, sf_dir), routes(spark, sf_dir), match="suffix").select("file", "route")


LINK_CTE = f"""
{API_SQL},
cc AS (SELECT 'views/P' || p_partkey || '.vue' AS file, p_partkey AS k, p_size AS z,
              CAST(p_size % 7 = 0 AS INTEGER) AS f7, CAST(p_size % 6 = 0 AS INTEGER) AS f6 FROM part),
calls AS (SELECT file, 0 AS ord, 'finish' || k AS client_method FROM cc WHERE f7 = 1
          UNION ALL SELECT file, f7, 'get' || k FROM cc
          UNION ALL SELECT file, f7 + 1, 'legacy' || k FROM cc
          UNION ALL SELECT file, f7 + 2, 'fall' || k FROM cc WHERE f6 = 1
          UNION ALL SELECT file, f7 + 2 + f6, 'status' || k FROM cc),
rc AS (SELECT calls.*, api.http_method, api.url FROM calls LEFT JOIN api USING (client_method)),
ep AS (SELECT p_partkey AS ord, 'EP-' || p_partkey AS ep_id,
              CASE WHEN p_partkey % 4 = 3 THEN ':param/api/v1/file/:param/' || p_partkey
                   ELSE '/api/v1/' || lower(p_type) || '/' || p_partkey END AS url,
              CASE WHEN p_partkey % 8 = 6 THEN 'DELETE' WHEN p_partkey % 4 = 1 THEN 'POST'
                   WHEN p_partkey % 4 = 2 THEN 'PUT' ELSE 'GET' END AS method FROM part),
keys AS (SELECT lower(CASE WHEN ord % 5 = 0 THEN url WHEN ord % 5 = 1 THEN 'GET ' || url || '/all'
                           ELSE method || ' ' || url END) AS key, ord AS key_ord, ep_id FROM ep),
t AS (SELECT rc.*, k1.ep_id AS e1, k2.ep_id AS e2 FROM rc
      LEFT JOIN keys k1 ON k1.key = lower(rc.http_method || ' ' || rc.url)
      LEFT JOIN keys k2 ON k2.key = lower(rc.url)
      WHERE rc.url IS NOT NULL AND rc.url <> ''),
t3 AS (SELECT t.file, t.ord, arg_min(keys.ep_id, keys.key_ord) AS e3 FROM t JOIN keys
       ON contains(keys.key, lower(t.url)) WHERE t.e1 IS NULL AND t.e2 IS NULL GROUP BY t.file, t.ord),
res AS (SELECT t.file, t.ord, coalesce(t.e1, t.e2, t3.e3) AS ep_id FROM t LEFT JOIN t3 USING (file, ord)),
rr AS (SELECT l_orderkey AS o, l_linenumber AS ln, min(l_partkey) AS pk FROM lineitem GROUP BY 1, 2),
fo AS (SELECT o, arg_min(pk, ln) AS pk FROM rr GROUP BY o),
epfr AS (SELECT DISTINCT 'EP-' || fo.pk AS ep_id, 'FR-' || o_custkey AS fr_id
         FROM orders JOIN fo ON fo.o = o_orderkey WHERE o_orderkey % 7 <= 3),
creq AS (SELECT rc.file, rc.ord, rc.client_method, rc.http_method, rc.url, res.ep_id, epfr.fr_id
         FROM rc LEFT JOIN res USING (file, ord) LEFT JOIN epfr USING (ep_id))"""


def call_reqs(spark, sf_dir):
    return L.call_requirements(components(spark, sf_dir), api(spark, sf_dir), entry_points(spark, sf_dir),
                               spec_evidence(spark, sf_dir))


@register("component_call_requirements", "L1,L2,L3,L4,Q8", f"""
WITH {LINK_CTE}
SELECT file, client_method, http_method, url, ep_id, fr_id FROM creq""")
def q_call_reqs(spark, sf_dir):
    return call_reqs(spark, sf_dir).select("file", "client_method", "http_method", "url", "ep_id", "fr_id")


@register("component_map", "L6", f"""
SELECT 'views/P' || p_partkey || '.vue' AS file, {ROUTE_OF} AS route, {ROLES_OF} AS required_roles,
       true AS has_polling, (p_size % 4 = 0 OR p_size % 6 = 0) AS has_conditional_api,
       true AS has_auto_load, p_size % 7 = 0 AS has_confirmation_guard, 1 AS validation_messages
FROM part""")
def q_component_map(spark, sf_dir):
    m = L.component_map(components(spark, sf_dir), routes(spark, sf_dir))
    return m.withColumn("required_roles", F.array_join("required_roles", ",")).drop("store_dispatches", "messages")


@register("option_groups", "L8", """
SELECT 'views/P' || p_partkey || '.vue' AS file, 0 AS select_ord, 2 AS n_options FROM part
UNION ALL
SELECT min('views/P' || p_partkey || '.vue'), 1, 1 FROM part GROUP BY p_type""")
def q_option_groups(spark, sf_dir):
    return L.option_groups(components(spark, sf_dir))


@register("label_summary", "L9", """
SELECT (SELECT count(*) FROM customer) AS translator_functions,
       (SELECT count(*) FROM part) AS components_with_select""")
def q_label_summary(spark, sf_dir):
    return L.label_summary(C.translator_labels(translator_files(spark, sf_dir)), components(spark, sf_dir))


@register("ui_structure", "L10", f"""
SELECT 'views/P' || p_partkey || '.vue' AS component, {ROUTE_OF} AS route, trim(p_name) AS breadcrumb,
       2 AS table_columns, 3 AS form_fields, 2 AS list_item_fields FROM part""")
def q_ui_structure(spark, sf_dir):
    u = L.ui_structure(components(spark, sf_dir), routes(spark, sf_dir))
    return u.select("component", "route", "breadcrumb", "table_columns", "form_fields", "list_item_fields")


@register("behavior_counts", "L11,L15", """
SELECT 'polling' AS type, count(*) AS n FROM part
UNION ALL SELECT 'conditional_api', count(*) FILTER (WHERE p_size % 4 = 0) + 2 * count(*) FILTER (WHERE p_size % 6 = 0) FROM part
UNION ALL SELECT 'auto_load', count(*) + count(*) FILTER (WHERE p_size % 2 = 0) FROM part
UNION ALL SELECT 'confirmation_guard', count(*) FILTER (WHERE p_size % 7 = 0) FROM part
UNION ALL SELECT 'disabled_guard', count(*) FILTER (WHERE p_size % 3 = 0) FROM part""")
def q_behavior_counts(spark, sf_dir):
    return L.behavior_counts(L.behaviors(components(spark, sf_dir)))


CLIENT_REQ_CTE = """
WITH sp AS (SELECT s_suppkey AS s, 'router/n' || s_nationkey || '_' || (s_suppkey // 64) || '.js' AS src FROM supplier),
spo AS (SELECT *, CAST(row_number() OVER (PARTITION BY src ORDER BY s) - 1
                  + coalesce(sum(CASE WHEN s % 5 = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY src ORDER BY s
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS o FROM sp),
b1 AS (SELECT 1 AS b, src AS s_, o, CASE WHEN s % 3 = 0 THEN 0 ELSE 1 END AS i, 'access_guard' AS type,
              'router/index.js' AS source, '/s' || s AS route,
              CASE WHEN s % 3 = 0 THEN 'needs_graduated' ELSE 'needs_not_graduated' END AS condition,
              '/s' || s || ' — ' || CASE WHEN s % 3 = 0 THEN '졸업 상태인 학생만 해당 페이지에 접근할 수 있다'
                   ELSE '재학/수료/제적 상태인 학생만 해당 페이지에 접근할 수 있다' END AS description,
              CASE WHEN s % 3 = 0 THEN 'graduated_student' ELSE 'enrolled_student' END AS actor,
              '' AS api_calls, '' AS related_fr_ids FROM spo WHERE s % 3 <> 2),
b2 AS (SELECT 2, 'views/P' || p_partkey || '.vue', 0, 0, 'irreversibility_guard', 'views/P' || p_partkey || '.vue',
              NULL, '종료합니다 ' || p_partkey,
              '''종료합니다 ' || p_partkey || ''' 텍스트 입력 확인 후에만 작업을 진행할 수 있다', NULL,
              'finish' || p_partkey, '' FROM part WHERE p_size % 7 = 0),
g AS (SELECT 'store/n' || c_nationkey || '_' || (c_custkey // 64) || '.js' AS path, c_custkey AS c, c_mktsegment
      FROM customer WHERE c_custkey % 3 <> 0),
b3 AS (SELECT 3, path, row_number() OVER (PARTITION BY path ORDER BY c) - 1, 0, 'client_side_filter',
              'store/index.js', NULL, 'state.segment === ''' || c_mktsegment || '''',
              '클라이언트는 ''state.segment === ''' || c_mktsegment || ''''' 조건으로 데이터를 필터링하여 표시한다',
              NULL, '', '' FROM g),
b4 AS (SELECT 4, 'views/P' || p_partkey || '.vue', 0, 0, 'async_polling', 'views/P' || p_partkey || '.vue', NULL,
              'res.data.isRegistrationDone == true',
              (p_size * 100) || 'ms 간격으로 [''status' || p_partkey || ''', ''refresh'']를 폴링하며 ' ||
              '''res.data.isRegistrationDone == true'' 조건이 충족될 때 종료한다', NULL,
              'status' || p_partkey || ',refresh', '' FROM part),
b5 AS (SELECT 5, 'views/P' || p_partkey || '.vue', 0, 0, 'auto_context', 'views/P' || p_partkey || '.vue', NULL,
              'created', '페이지 진입 시 ''fetchTerm' || p_size || ''' 액션을 자동 실행해 학기 컨텍스트를 설정한다',
              NULL, 'fetchTerm' || p_size, '' FROM part),
u AS (SELECT * FROM b1 UNION ALL SELECT * FROM b2 UNION ALL SELECT * FROM b3 UNION ALL SELECT * FROM b4
      UNION ALL SELECT * FROM b5)"""
CLIENT_REQ_SQL = CLIENT_REQ_CTE + """,
n AS (SELECT *, row_number() OVER (ORDER BY b, s_, o, i) AS rn FROM u)
SELECT CASE WHEN rn < 1000 THEN 'CL-' || lpad(CAST(rn AS VARCHAR), 3, '0') ELSE 'CL-' || rn END AS req_id,
       type, source, route, condition, description, actor, api_calls, related_fr_ids FROM n"""


@register("client_requirements", "L12,Q4,Q5", CLIENT_REQ_SQL)
def q_client_reqs(spark, sf_dir):
    r = L.client_requirements(routes(spark, sf_dir), components(spark, sf_dir),
                              C.store_getters(store_files(spark, sf_dir)), api(spark, sf_dir),
                              entry_points(spark, sf_dir), spec_evidence(spark, sf_dir))
    return r.select("req_id", "type", "source", "route", "condition", "description", "actor",
                    F.array_join("api_calls", ",").alias("api_calls"),
                    F.array_join("related_fr_ids", ",").alias("related_fr_ids"))


@register("ui_evidence", "L13,L14", f"""
WITH {LINK_CTE}
SELECT 'FR-' || c_custkey AS fr_id, e.component, e.route
FROM customer LEFT JOIN (
  SELECT creq.fr_id, creq.file AS component,
         CASE WHEN k IN (SELECT s_suppkey FROM supplier) THEN '/s' || k END AS route
  FROM creq JOIN cc USING (file) WHERE creq.fr_id IS NOT NULL) e ON e.fr_id = 'FR-' || c_custkey""")
def q_ui_evidence(spark, sf_dir):
    facts = cut(C.component_facts(components(spark, sf_dir)))
    cmap = cut(L.component_map(facts, routes(spark, sf_dir)))
    reqs = L.call_requirements(facts, api(spark, sf_dir), entry_points(spark, sf_dir), spec_evidence(spark, sf_dir))
    ev = L.ui_evidence(cut(reqs), cmap)
    feats = table(spark, sf_dir, "customer").select(
        F.concat(F.lit("FR-"), F.col("c_custkey").cast("string")).alias("fr_id"))
    return L.attach_ui_evidence(feats, ev).select("fr_id", "component", "route")


@register("client_api_params", "H20", f"""
WITH {API_SQL},
prm AS (SELECT 'get' || p_partkey AS method, 'id,opts' AS params
        FROM part
        UNION ALL SELECT 'status' || p_partkey, 'id' FROM part)
SELECT 'views/P' || p_partkey || '.vue' AS file, 'get' || p_partkey AS method, prm.params
FROM part JOIN prm ON prm.method = 'get' || p_partkey
UNION ALL SELECT 'views/P' || p_partkey || '.vue', 'status' || p_partkey, 'id' FROM part""")
def q_api_params(spark, sf_dir):
    p = L.api_params(components(spark, sf_dir), api(spark, sf_dir))
    return p.select("file", "method", F.array_join("params", ",").alias("params"))


@register("client_component_records", "H27", f"""
WITH calls AS ({CALLS_SQL}),
fields AS ({registry.ORACLE["client_vfor_fields"]}),
guards AS ({registry.ORACLE["client_disabled_guards"]}),
titles AS ({registry.ORACLE["client_page_title"]}),
lists AS (
  SELECT file, coalesce(string_agg(method, ',' ORDER BY ord) FILTER (call_kind = 'client'), '') AS client_calls,
         coalesce(string_agg(method, ',' ORDER BY ord) FILTER (call_kind = 'dispatch'), '') AS store_dispatches,
         coalesce(string_agg(method, ',' ORDER BY ord) FILTER (call_kind = 'this'), '') AS this_calls
  FROM calls GROUP BY file),
f AS (SELECT file, string_agg(field, ',' ORDER BY field) AS vfor_fields FROM fields GROUP BY file),
g AS (SELECT file, string_agg(condition, ',' ORDER BY ord) AS disabled_guards FROM guards GROUP BY file)
SELECT file, client_calls, store_dispatches, this_calls, page_title, vfor_fields,
       coalesce(disabled_guards, '') AS disabled_guards
FROM lists JOIN titles USING (file) JOIN f USING (file) LEFT JOIN g USING (file)""")
def q_component_records(spark, sf_dir):
    r = C.component_records(components(spark, sf_dir))
    return r.select("file", "page_title", *[F.array_join(c, ",").alias(c) for c in (
        "client_calls", "store_dispatches", "this_calls", "vfor_fields", "disabled_guards")])
