"""Contract queries for the whole component record (H27) and what is built from
it (L6, L10, L15): one pass over the components, then rows of a narrow table."""

from __future__ import annotations

from pyspark.sql import functions as F

from codefacts.operators import client as C
from codefacts.operators import linking as L
from codefacts.plans import registry
from codefacts.plans.client_checks import CALLS_SQL
from codefacts.plans.corpus_trace import entry_points, spec_evidence
from codefacts.plans.link_checks import LINK_CTE, ROLES_OF, ROUTE_OF, api, components, routes
from codefacts.plans.registry import register
from codefacts.session import cut, shuffled

SQL = registry.ORACLE


def facts(spark, sf_dir):
    return cut(C.component_facts(components(spark, sf_dir)))


@register("component_record_rows", "H27,L1", f"""
WITH calls AS ({CALLS_SQL}), life AS ({SQL["client_lifecycle_calls"]}),
hooks AS (SELECT file, lifecycle_hook, coalesce(string_agg(method, ',' ORDER BY ord) FILTER (call_kind = 'direct'), '') AS d,
                 coalesce(string_agg(method, ',' ORDER BY ord) FILTER (call_kind = 'indirect'), '') AS i,
                 coalesce(string_agg(method, ',' ORDER BY ord) FILTER (call_kind = 'dispatch'), '') AS s
          FROM life GROUP BY ALL)
SELECT file, CASE call_kind WHEN 'client' THEN 'client_calls' WHEN 'dispatch' THEN 'store_dispatches' ELSE 'this_calls' END AS kind,
       method AS value FROM calls
UNION ALL SELECT file, 'lifecycle_auto_calls', concat_ws('|', lifecycle_hook, d, i, s) FROM hooks
UNION ALL SELECT file, 'polling', concat_ws('|', interval_ms, direct_calls, indirect_calls, dispatch_calls,
                                            termination_condition, success_condition) FROM ({SQL["client_polling"]})
UNION ALL SELECT file, 'conditional_api_branches', concat_ws('|', pattern, condition, true_calls, false_calls)
FROM ({SQL["client_conditional_api"]})
UNION ALL SELECT file, 'confirmation_guards', concat_ws('|', required_text, nearby_api_calls) FROM ({SQL["client_confirmation_guards"]})
UNION ALL SELECT file, 'disabled_guards', condition FROM ({SQL["client_disabled_guards"]})
UNION ALL SELECT file, 'domain_constants', concat_ws('|', select_ord, value, label) FROM ({SQL["client_select_options"]})
UNION ALL SELECT file, 'page_title', page_title FROM ({SQL["client_page_title"]})
UNION ALL SELECT file, 'table_columns', "column" FROM ({SQL["client_table_columns"]})
UNION ALL SELECT file, 'form_fields', concat_ws('|', label, v_model, input_type, required, immutable) FROM ({SQL["client_form_fields"]})
UNION ALL SELECT file, 'vfor_fields', field FROM ({SQL["client_vfor_fields"]})
UNION ALL SELECT file, 'validation_messages', concat_ws('|', type, message, condition) FROM ({SQL["client_validation_messages"]})
UNION ALL SELECT file, 'resolved_api_calls', concat_ws('|', client_method, coalesce(http_method, ''), coalesce(url, ''))
FROM (WITH {LINK_CTE} SELECT * FROM rc)
UNION ALL SELECT file, 'api_params', concat_ws('|', method, params) FROM ({SQL["client_api_params"]})""")
def q_record_rows(spark, sf_dir):
    return L.record_rows(components(spark, sf_dir), api(spark, sf_dir)).select("file", "kind", "value")


@register("component_map_calls", "L6,L1,L3,L4", f"""
WITH {LINK_CTE},
m AS (SELECT 'views/P' || p_partkey || '.vue' AS file, {ROUTE_OF} AS route, {ROLES_OF} AS required_roles FROM part)
SELECT file, route, required_roles, ord, client_method, http_method, url, ep_id, fr_id FROM creq JOIN m USING (file)""")
def q_map_calls(spark, sf_dir):
    f = facts(spark, sf_dir)
    m = L.component_map(f, routes(spark, sf_dir)).select("file", "route", F.array_join("required_roles", ",").alias("required_roles"))
    reqs = L.call_requirements(f, api(spark, sf_dir), entry_points(spark, sf_dir), spec_evidence(spark, sf_dir))
    return reqs.join(shuffled(m), "file")


@register("component_map_items", "L6", f"""
SELECT file, 'store_dispatch' AS kind, ord, method AS value FROM ({CALLS_SQL}) WHERE call_kind = 'dispatch'
UNION ALL SELECT file, 'validation_message', ord, message || '|' || condition FROM ({SQL["client_validation_messages"]})
WHERE type = 'validation'""")
def q_map_items(spark, sf_dir):
    m = cut(L.component_map(components(spark, sf_dir), routes(spark, sf_dir)).select("file", "store_dispatches", "messages"))
    said = F.transform("messages", lambda x: F.concat_ws("|", x["message"], x["condition"]))
    both = [m.select("file", F.lit(kind).alias("kind"), F.posexplode(items).alias("ord", "value"))
            for kind, items in (("store_dispatch", F.col("store_dispatches")), ("validation_message", said))]
    return both[0].unionByName(both[1])


@register("ui_structure_items", "L10", f"""
WITH r AS (SELECT 'views/P' || p_partkey || '.vue' AS component, {ROUTE_OF} AS route FROM part),
i AS (SELECT file, 'table_column' AS kind, "column" AS value FROM ({SQL["client_table_columns"]})
      UNION ALL SELECT file, 'form_field', label FROM ({SQL["client_form_fields"]})
      UNION ALL SELECT file, 'list_item_field', field FROM ({SQL["client_vfor_fields"]}))
SELECT component, route, kind, value FROM r JOIN i ON i.file = r.component""")
def q_ui_items(spark, sf_dir):
    u = cut(L.ui_pages(components(spark, sf_dir), routes(spark, sf_dir)))

    def rows(kind, items):
        return u.select("component", "route", F.lit(kind).alias("kind"), F.explode(items).alias("value"))
    return (rows("table_column", F.col("table_columns"))
            .unionByName(rows("form_field", F.transform("form_fields", lambda x: x["label"])))
            .unionByName(rows("list_item_field", F.col("list_item_fields"))))


@register("client_summary", "L15", f"""
WITH {LINK_CTE}, n AS (SELECT count(*) AS n FROM part)
SELECT m AS metric, n AS value FROM n, (VALUES ('components'), ('validation_messages'), ('components_with_validation'),
  ('pages'), ('pages_with_columns'), ('pages_with_form'), ('pages_with_list')) v(m)
UNION ALL SELECT 'behaviors', sum(n)::BIGINT FROM ({SQL["behavior_counts"]})
UNION ALL SELECT 'requirements_covered', count(DISTINCT fr_id) FROM creq""")
def q_client_summary(spark, sf_dir):
    f, r = facts(spark, sf_dir), cut(routes(spark, sf_dir))
    cmap = cut(L.component_map(f, r))
    reqs = L.call_requirements(f, api(spark, sf_dir), entry_points(spark, sf_dir), spec_evidence(spark, sf_dir))
    ui, covered = cut(L.ui_structure(f, r)), cut(reqs.where("fr_id is not null").select("fr_id"))
    return L.client_summary(cmap, ui, L.behaviors(f), covered)
