"""Client linking: calls to endpoints to requirements, routes to components,
behaviours, client-only requirements and UI evidence (SURVEY L1-L15).

Small parameter tables may be broadcast; every table that grows with the
code base (components, calls, endpoints, evidence) is joined with ordinary
equi-joins so AQE can pick the strategy at run time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from codefacts import params as P
from codefacts.operators import client as C
from codefacts.operators.containment import first_containing
from codefacts.session import checkpoint_dir, cut, shuffled

# ----------------------------------------------------------------------------
# Evidence prefix, client-only requirement texts
# ----------------------------------------------------------------------------
RX_EP_REF = r"^(EP-\d+)"
REQ_PREFIX = "CL-"
IRREVERSIBLE_DESCRIPTION = "'{text}' 텍스트 입력 확인 후에만 작업을 진행할 수 있다"
FILTER_DESCRIPTION = "클라이언트는 '{cond}' 조건으로 데이터를 필터링하여 표시한다"
POLL_DESCRIPTION = "{ms}ms 간격으로 {calls}를 폴링하며 '{term}' 조건이 충족될 때 종료한다"
AUTO_CONTEXT_DESCRIPTION = "페이지 진입 시 '{action}' 액션을 자동 실행해 학기 컨텍스트를 설정한다"


def api_map(api: DataFrame) -> DataFrame:
    """One API method per name across client files; the last file wins."""
    return (api.groupBy("client_method")
            .agg(F.max_by(F.struct("http_method", "url", "params"), F.struct("path", "ord")).alias("a"))
            .select("client_method", "a.http_method", "a.url", "a.params"))


# ------------------------------------------------------------------ L1
def _facts(components: DataFrame) -> DataFrame:
    """``component_facts``, whether given or still to be read from the sources."""
    return components if "client_calls" in components.columns else C.component_facts(components)


def resolved_calls(components: DataFrame, api: DataFrame) -> DataFrame:
    """L1: ``(file, ord, client_method, http_method, url)``; unknown methods are
    kept with NULL verb and URL. ``components`` may be ``component_facts``."""
    calls = (_facts(components).select("file", F.posexplode("client_calls").alias("ord", "client_method"))
             .withColumn("ord", F.col("ord").cast("int")))
    return calls.join(shuffled(api_map(api)), "client_method", "left").select(
        "file", "ord", "client_method", "http_method", "url")


# ------------------------------------------------------------------ L2, L3
def endpoint_map(entry_points: DataFrame) -> DataFrame:
    """L2: ``(key, key_ord, ep_id)``: lower-cased route -> endpoint; a repeated
    route keeps its first position and its last id; blank routes dropped."""
    e = entry_points.where(F.col("route").isNotNull() & (F.col("route") != ""))
    return (e.groupBy(F.lower("route").alias("key"))
            .agg(F.min("ord").alias("key_ord"), F.max_by("ep_id", "ord").alias("ep_id")))


def endpoint_requirements(evidence: DataFrame) -> DataFrame:
    """L3: ``(ep_id, fr_id)`` through ``EP-n`` evidence prefixes, distinct (Q8)."""
    return (evidence.select(F.regexp_extract("ref", RX_EP_REF, 1).alias("ep_id"), "fr_id")
            .where(F.col("ep_id") != "").distinct())


# ------------------------------------------------------------------ L4
def resolve_urls(calls: DataFrame, emap: DataFrame, call_id: str = "call_id") -> DataFrame:
    """L4: endpoint of each ``(call_id, http_method, url)`` in three tiers.

    Tier 1 ``verb url`` and tier 2 ``url`` are equi-joins on the lower-cased
    key; only the rest go to the containment join (first key, in map order,
    that contains the URL). A blank URL resolves to nothing (SURVEY Q5).
    Output ``(call_id, ep_id, tier)``; ``ep_id`` NULL when unresolved.
    """
    c = calls.select(F.col(call_id).alias("_cid"),
                     F.lower(F.concat(F.coalesce(F.upper("http_method"), F.lit("")), F.lit(" "),
                                      F.coalesce("url", F.lit("")))).alias("_k1"),
                     F.lower(F.coalesce("url", F.lit(""))).alias("_k2"))
    # each different call text is resolved once, however many calls share it
    keys = c.select("_k1", "_k2").where(F.col("_k2") != "").distinct()
    e1 = emap.select(F.col("key").alias("_k1"), F.col("ep_id").alias("_e1"))
    e2 = emap.select(F.col("key").alias("_k2"), F.col("ep_id").alias("_e2"))
    t = keys.join(shuffled(e1), "_k1", "left").join(shuffled(e2), "_k2", "left")
    direct = F.col("_e1").isNotNull() | F.col("_e2").isNotNull()
    done = t.where(direct).select("_k1", "_k2", F.coalesce("_e1", "_e2").alias("ep_id"),
                                  F.when(F.col("_e1").isNotNull(), 1).otherwise(2).alias("tier"))
    rest = t.where(~direct).select("_k1", "_k2")
    t3 = first_containing(rest.select(F.col("_k2").alias("needle_id"), F.col("_k2").alias("needle")).distinct(),
                          emap.select("key", "key_ord", F.col("ep_id").alias("value")))
    t3 = rest.join(shuffled(t3.select(F.col("needle_id").alias("_k2"), F.col("value").alias("ep_id"))), "_k2").select(
        "_k1", "_k2", "ep_id", F.lit(3).alias("tier"))
    return (c.join(shuffled(done.unionByName(t3)), ["_k1", "_k2"], "left")
            .select(F.col("_cid").alias(call_id), "ep_id", "tier"))


def call_requirements(components: DataFrame, api: DataFrame, entry_points: DataFrame,
                      evidence: DataFrame) -> DataFrame:
    """L1 + L4 + L3 per component call: ``(file, ord, client_method,
    http_method, url, ep_id, fr_id)``; one row per requirement (NULL when none);
    calls without a URL are not resolved."""
    # each side is read once; resolution uses them several times
    rc = cut(resolved_calls(components, api))
    emap = cut(endpoint_map(entry_points))
    keyed = rc.withColumn("call_id", F.struct("file", "ord"))
    res = resolve_urls(keyed.where(F.col("url").isNotNull() & (F.col("url") != "")), emap)
    ep_fr = endpoint_requirements(evidence)
    # calls without an endpoint get a key of their own, so they do not meet in one partition
    ep_key = F.coalesce("ep_id", F.concat(F.lit("\x00"), F.xxhash64("call_id").cast("string")))
    ep_fr = ep_fr.withColumnRenamed("ep_id", "_ep")
    found = keyed.join(shuffled(res), "call_id", "left").withColumn("_key", ep_key)
    return (found.join(shuffled(ep_fr), F.col("_key") == F.col("_ep"), "left")
            .select("file", "ord", "client_method", "http_method", "url", "ep_id", "fr_id"))


# ------------------------------------------------------------------ L5
def component_routes(components: DataFrame, routes: DataFrame, match: str = "contains") -> DataFrame:
    """First route (router file, then position) whose component file, with
    ``src/`` removed, contains the component's relative path (``contains``, the
    default, SURVEY Q20) or ends with it on a segment boundary (``suffix``).
    Output ``(file, route, required_roles, needs_graduated, needs_not_graduated)``."""
    r = (routes.where(F.col("component_file").isNotNull())
         .select(F.replace(F.col("component_file"), F.lit("src/"), F.lit("")).alias("key"),
                 F.struct("source", "ord").alias("key_ord"),
                 F.struct("path", "required_roles", "needs_graduated", "needs_not_graduated").alias("value")))
    files = components.select("file").distinct()
    if match == "contains":
        hit = first_containing(files.select(F.col("file").alias("needle_id"), F.col("file").alias("needle")), r)
    else:
        seg = r.select(F.explode(F.transform(
            F.sequence(F.lit(0), F.size(F.split("key", "/", -1)) - 1),
            lambda i: F.array_join(F.slice(F.split("key", "/", -1), i + 1, 1 << 20), "/"))).alias("needle"),
            "key_ord", "value")
        hit = (files.join(shuffled(seg), files["file"] == seg["needle"])
               .groupBy("file").agg(F.min_by(F.struct("value", "key_ord"), "key_ord").alias("_w"))
               .select(F.col("file").alias("needle_id"), F.col("_w.value").alias("value")))
    return (files.join(shuffled(hit), files["file"] == hit["needle_id"], "left")
            .select("file", F.col("value.path").alias("route"),
                    F.coalesce(F.col("value.required_roles"), F.array().cast("array<string>")).alias("required_roles"),
                    F.col("value.needs_graduated").alias("needs_graduated"),
                    F.col("value.needs_not_graduated").alias("needs_not_graduated")))


# ------------------------------------------------------------------ L6
def component_map(components: DataFrame, routes: DataFrame) -> DataFrame:
    """Components with API calls or dispatches, with route, roles, dispatches,
    four behaviour flags, their validation-type messages and how many those are.
    ``components`` may be ``component_facts``; its calls with endpoints and
    requirements are ``call_requirements``, their parameters ``api_params``."""
    messages = F.filter("validation_messages", lambda m: m["type"] == "validation")
    # read before the filter, which would read the texts a second time
    cm = (_facts(components)
          .select("file", "store_dispatches", ((F.size("client_calls") > 0) | (F.size("store_dispatches") > 0)).alias("_calls"),
                  (F.size("polling") > 0).alias("has_polling"),
                  (F.size("conditional_api_branches") > 0).alias("has_conditional_api"),
                  (F.size("lifecycle_auto_calls") > 0).alias("has_auto_load"),
                  (F.size("confirmation_guards") > 0).alias("has_confirmation_guard"),
                  F.transform(messages, lambda m: F.struct(m["message"].alias("message"), m["condition"].alias("condition")))
                  .alias("messages"), F.size(messages).cast("bigint").alias("validation_messages")))
    cm = cut(cm).where("_calls")
    return (cm.join(shuffled(component_routes(cm, routes)), "file", "left")
            .select("file", "route", "required_roles", "has_polling", "has_conditional_api", "has_auto_load",
                    "has_confirmation_guard", "validation_messages", "store_dispatches", "messages"))


def record_rows(components: DataFrame, api: DataFrame) -> DataFrame:
    """The 16 parts of a component's record as rows ``(file, kind, ord,
    value)``: every fact of ``component_facts`` as one tagged array, exploded in one
    pass, and the calls resolved with the API map. The fields of a fact are
    joined with ``|``, lists in it with commas."""
    f = cut(_facts(components))

    def text(*fields):
        return F.concat_ws("|", *[F.coalesce(x.cast("string"), F.lit("")) for x in fields])

    def items(kind, column, value=lambda x: x):
        return F.transform(column, lambda x, i: F.struct(F.lit(kind).alias("kind"), i.alias("ord"), value(x).alias("value")))

    def names(xs):
        return F.array_join(xs, ",")
    calls3 = lambda x: [names(x[c]) for c in ("direct_calls", "indirect_calls", "dispatch_calls")]      # noqa: E731
    tagged = F.concat(
        items("client_calls", "client_calls"), items("store_dispatches", "store_dispatches"), items("this_calls", "this_calls"),
        items("lifecycle_auto_calls", "lifecycle_auto_calls", lambda x: text(x["lifecycle_hook"], *calls3(x))),
        items("polling", "polling", lambda x: text(x["interval_ms"], *calls3(x), x["termination_condition"], x["success_condition"])),
        items("conditional_api_branches", "conditional_api_branches",
              lambda x: text(x["pattern"], x["condition"], names(x["true_calls"]), names(x["false_calls"]))),
        items("confirmation_guards", "confirmation_guards", lambda x: text(x["required_text"], names(x["nearby_api_calls"]))),
        items("disabled_guards", "disabled_guards"),
        items("domain_constants", "domain_constants", lambda x: text(x["select_ord"], x["value"], x["label"])),
        items("page_title", F.filter(F.array("page_title"), lambda x: x.isNotNull())),
        items("table_columns", "table_columns"),
        items("form_fields", "form_fields", lambda x: text(x["label"], x["v_model"], x["input_type"], x["required"], x["immutable"])),
        items("vfor_fields", "vfor_fields"),
        items("validation_messages", "validation_messages", lambda x: text(x["type"], x["message"], x["condition"])))
    own = f.select("file", F.inline(tagged))
    api = cut(api_map(api))
    called = f.select("file", F.posexplode("client_calls").alias("ord", "client_method")).join(shuffled(api), "client_method", "left")
    resolved = called.select("file", F.lit("resolved_api_calls").alias("kind"), "ord",
                             text(F.col("client_method"), F.col("http_method"), F.col("url")).alias("value"))
    params = called.where("params is not null").select("file", F.lit("api_params").alias("kind"), "ord",
                                                       text(F.col("client_method"), names(F.col("params"))).alias("value"))
    return own.unionByName(resolved).unionByName(params)


# ------------------------------------------------------------------ L7-L9
def display_labels(labels: DataFrame, mapping: DataFrame | None = None) -> DataFrame:
    """``(domain, value, label)``; a domain named by several translator
    functions takes the last one's mapping (files by path, blocks by order).

    ``mapping(fn, domain)`` renames functions (H3); without it the fixed
    rename list applies."""
    if mapping is None:
        l = labels.withColumn("domain", C.domain_of("fn"))
    else:
        m = mapping.select(F.col("fn").alias("_fn"), F.col("domain").alias("_d"))
        l = (labels.join(shuffled(m), labels["fn"] == m["_fn"], "left")
             .withColumn("domain", F.coalesce("_d", "fn")).drop("_fn", "_d"))
    win = l.groupBy("domain").agg(F.max(F.struct("path", "block_ord")).alias("_w"))
    return (l.join(shuffled(win), "domain").where(F.struct("path", "block_ord") == F.col("_w"))
            .select("domain", "value", "label"))


def option_groups(components: DataFrame) -> DataFrame:
    """Distinct option groups by their sorted ``(value, label)`` signature;
    the first group seen (file order, then select order) represents it."""
    o = C.select_options(components)
    g = (o.groupBy("file", "select_ord")
         .agg(F.array_sort(F.collect_list(F.struct("value", "label"))).alias("sig")))
    return (g.groupBy("sig").agg(F.min(F.struct("file", "select_ord")).alias("first"))
            .select(F.col("first.file").alias("file"), F.col("first.select_ord").alias("select_ord"),
                    F.size("sig").alias("n_options")))


def label_summary(labels: DataFrame, components: DataFrame) -> DataFrame:
    """Translator functions with labels and components with a select group."""
    fns = labels.agg(F.count_distinct("fn").cast("bigint").alias("translator_functions"))
    comps = C.select_options(components).agg(F.count_distinct("file").cast("bigint")
                                             .alias("components_with_select"))
    return (fns.select("translator_functions", F.lit(None).cast("bigint").alias("components_with_select"))
            .unionByName(comps.select(F.lit(None).cast("bigint").alias("translator_functions"),
                                      "components_with_select"))
            .agg(F.max("translator_functions").alias("translator_functions"),
                 F.max("components_with_select").alias("components_with_select")))


# ------------------------------------------------------------------ L10
def ui_pages(components: DataFrame, routes: DataFrame) -> DataFrame:
    """Pages with any UI fact: ``(component, route, required_roles,
    breadcrumb, table_columns, form_fields, list_item_fields)``, the last three as
    lists. ``components`` may be ``component_facts``."""
    # read before the filter, which would read the texts a second time
    u = cut(_facts(components).select("file", F.col("page_title").alias("breadcrumb"), "table_columns", "form_fields",
                                      F.col("vfor_fields").alias("list_item_fields")))
    u = u.where((F.coalesce("breadcrumb", F.lit("")) != "") | (F.size("table_columns") > 0)
                | (F.size("form_fields") > 0) | (F.size("list_item_fields") > 0))
    return (u.join(shuffled(component_routes(u, routes)), "file", "left")
            .select(F.col("file").alias("component"), "route", "required_roles", "breadcrumb", "table_columns",
                    "form_fields", "list_item_fields"))


def ui_structure(components: DataFrame, routes: DataFrame) -> DataFrame:
    """L10 with the number of columns, fields and items instead of the lists."""
    u = ui_pages(components, routes)
    return u.select("component", "route", "required_roles", "breadcrumb",
                    *[F.size(c).cast("bigint").alias(c) for c in ("table_columns", "form_fields", "list_item_fields")])


# ------------------------------------------------------------------ L11
def behaviors(components: DataFrame) -> DataFrame:
    """L11 (``components`` may be ``component_facts``): polling, conditional API, auto load, confirmation and disabled
    guards in one table tagged by ``type``."""
    f = components
    if "client_calls" not in f.columns:
        # read once for all kinds of rows: a filter on a list would read it a second time
        f = cut(C.component_facts(f).select("file", "polling", "conditional_api_branches", "lifecycle_auto_calls",
                                            "confirmation_guards", "disabled_guards"))
    f = f.withColumnRenamed("file", "component")

    def rows(column, kind, numbered=True):
        if numbered:
            x = f.select("component", F.posexplode(column).alias("ord", "x")).select("component", "ord", "x.*")
        else:
            x = f.select("component", F.inline(column))
        return x.withColumn("type", F.lit(kind))
    empty = F.array().cast("array<string>")
    p = rows("polling", "polling")
    c = rows("conditional_api_branches", "conditional_api", False)
    a = rows("lifecycle_auto_calls", "auto_load", False).withColumn("ord", F.lit(0))
    g = rows("confirmation_guards", "confirmation_guard", False).withColumnRenamed("nearby_api_calls", "direct_calls")
    d = (f.select("component", F.posexplode("disabled_guards").alias("ord", "condition"))
         .withColumn("type", F.lit("disabled_guard")))
    out = p
    for x in (c, a, g, d):
        out = out.unionByName(x, allowMissingColumns=True)
    return out.withColumn("true_calls", F.coalesce("true_calls", empty))


def behavior_counts(b: DataFrame) -> DataFrame:
    """L15 (behaviour part): rows per behaviour type."""
    return b.groupBy("type").agg(F.count("*").cast("bigint").alias("n"))


# ------------------------------------------------------------------ L12
def number_rows(df: DataFrame, order_cols: list[str], id_col: str = "req_id",
                prefix: str = REQ_PREFIX, width: int = 3) -> DataFrame:
    """Consecutive numbering in ``order_cols`` order without a global window.

    Rows are range-partitioned and sorted within partitions; the position in
    a partition comes from ``monotonically_increasing_id`` (partition id in
    the upper bits), partition sizes are counted (one row per partition) and
    turned into offsets. The partitioned table is checkpointed first so both
    uses see the same rows in the same partitions.
    """
    spark = df.sparkSession
    checkpoint_dir(spark)
    s = (df.repartitionByRange(*order_cols).sortWithinPartitions(*order_cols)
         .withColumn("_mid", F.monotonically_increasing_id()))
    s = s.withColumn("_pid", F.shiftright("_mid", 33)).withColumn(
        "_pos", F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1)))
    # cut before counting so both uses see the same rows in the same partitions
    s = s.checkpoint(eager=True)
    counts = s.groupBy("_pid").agg(F.count("*").alias("_n"))
    # one row per partition: a running sum over this tiny table is cheap
    offs = counts.select("_pid", F.sum("_n").over(
        Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)).alias("_off"))
    s = s.join(offs, "_pid")
    n = F.coalesce(F.col("_off"), F.lit(0)) + F.col("_pos") + 1
    num = F.when(n < 10 ** width, F.lpad(n.cast("string"), width, "0")).otherwise(n.cast("string"))
    return s.withColumn(id_col, F.concat(F.lit(prefix), num)).drop("_mid", "_pid", "_pos", "_off")


def client_requirements(routes: DataFrame, components: DataFrame, getters: DataFrame,
                        api: DataFrame, entry_points: DataFrame, evidence: DataFrame,
                        templates=P.GUARD_TEMPLATES) -> DataFrame:
    """Client-only requirements with one running id ``CL-nnn``."""
    rows = client_requirement_rows(routes, components, getters, api, entry_points, evidence, templates)
    return number_rows(rows, ["_b", "_s", "_o", "_i"]).drop("_b", "_s", "_o", "_i")


def client_requirement_rows(routes: DataFrame, components: DataFrame, getters: DataFrame,
                            api: DataFrame, entry_points: DataFrame, evidence: DataFrame,
                            templates=P.GUARD_TEMPLATES) -> DataFrame:
    """L12 rows before numbering (sort keys ``_b, _s, _o, _i``).

    Order: route guards (router file, route position, guard), irreversibility
    guards, store getters that filter, polling flows (direct and indirect
    calls, SURVEY Q4), auto-context dispatches containing ``Term``/``term``.
    Related requirement ids of a guard come from its nearby calls resolved
    through the API map; a call without a URL resolves to nothing (Q5).
    """
    empty = F.array().cast("array<string>")
    parts = []
    for gi, (flag, desc, actor) in enumerate(templates):
        parts.append(routes.where(F.col(flag)).select(
            F.lit(1).alias("_b"), F.col("source").alias("_s"), F.col("ord").alias("_o"), F.lit(gi).alias("_i"),
            F.lit("access_guard").alias("type"), F.lit(P.ROUTER_SOURCE).alias("source"),
            F.col("path").alias("route"), F.lit(flag).alias("condition"),
            F.concat(F.col("path"), F.lit(" — " + desc)).alias("description"), F.lit(actor).alias("actor"),
            empty.alias("api_calls")))
    # read once for all parts: a filter on a list would read it a second time
    facts = cut(_facts(components).select("file", "confirmation_guards", "polling", "lifecycle_auto_calls"))
    g = facts.select("file", F.inline("confirmation_guards"))
    gcalls = g.select("file", "ord", F.posexplode("nearby_api_calls").alias("_ci", "client_method"))
    amap = api_map(api)
    gres = gcalls.join(shuffled(amap), "client_method", "left").withColumn("call_id", F.struct("file", "ord", "_ci"))
    rr = resolve_urls(gres.where(F.col("url").isNotNull() & (F.col("url") != "")).withColumn(
        "http_method", F.coalesce("http_method", F.lit("POST"))), endpoint_map(entry_points))
    frs = (gres.join(shuffled(rr), "call_id").join(shuffled(endpoint_requirements(evidence)), "ep_id")
           .groupBy("file", "ord").agg(F.array_sort(F.collect_set("fr_id")).alias("related_fr_ids")))
    parts.append(g.join(shuffled(frs), ["file", "ord"], "left").select(
        F.lit(2).alias("_b"), F.col("file").alias("_s"), F.col("ord").alias("_o"), F.lit(0).alias("_i"),
        F.lit("irreversibility_guard").alias("type"), F.col("file").alias("source"),
        F.lit(None).cast("string").alias("route"), F.col("required_text").alias("condition"),
        F.replace(F.lit(IRREVERSIBLE_DESCRIPTION), F.lit("{text}"), F.col("required_text")).alias("description"),
        F.lit(None).cast("string").alias("actor"), F.col("nearby_api_calls").alias("api_calls"),
        F.coalesce("related_fr_ids", empty).alias("related_fr_ids")))
    parts.append(getters.select(
        F.lit(3).alias("_b"), F.col("path").alias("_s"), F.col("ord").alias("_o"), F.lit(0).alias("_i"),
        F.lit("client_side_filter").alias("type"), F.lit(P.STORE_SOURCE).alias("source"),
        F.lit(None).cast("string").alias("route"), F.col("filter_condition").alias("condition"),
        F.replace(F.lit(FILTER_DESCRIPTION), F.lit("{cond}"), F.col("filter_condition")).alias("description"),
        F.lit(None).cast("string").alias("actor"), empty.alias("api_calls")))
    p = facts.select("file", F.posexplode("polling").alias("ord", "x")).select("file", "ord", "x.*")
    polled = F.concat("direct_calls", "indirect_calls")
    pdesc = F.replace(F.replace(F.replace(F.lit(POLL_DESCRIPTION), F.lit("{ms}"), F.coalesce(
        F.col("interval_ms").cast("string"), F.lit("None"))), F.lit("{calls}"),
        F.concat(F.lit("["), F.array_join(F.transform(polled, lambda x: F.concat(F.lit("'"), x, F.lit("'"))), ", "),
                 F.lit("]"))), F.lit("{term}"), F.coalesce("termination_condition", F.lit("None")))
    parts.append(p.select(
        F.lit(4).alias("_b"), F.col("file").alias("_s"), F.col("ord").alias("_o"), F.lit(0).alias("_i"),
        F.lit("async_polling").alias("type"), F.col("file").alias("source"),
        F.lit(None).cast("string").alias("route"), F.col("termination_condition").alias("condition"),
        pdesc.alias("description"), F.lit(None).cast("string").alias("actor"), polled.alias("api_calls")))
    lc = facts.select("file", F.inline("lifecycle_auto_calls"))
    hook_ord = F.when(F.col("lifecycle_hook") == "created", 0).otherwise(1)
    d = (lc.select("file", "lifecycle_hook", hook_ord.alias("_h"), F.posexplode("dispatch_calls").alias("_di", "action"))
         .where(F.col("action").contains("Term") | F.col("action").contains("term")))
    parts.append(d.select(
        F.lit(5).alias("_b"), F.col("file").alias("_s"), F.col("_h").alias("_o"),
        F.col("_di").alias("_i"), F.lit("auto_context").alias("type"), F.col("file").alias("source"),
        F.lit(None).cast("string").alias("route"), F.col("lifecycle_hook").alias("condition"),
        F.replace(F.lit(AUTO_CONTEXT_DESCRIPTION), F.lit("{action}"), F.col("action")).alias("description"),
        F.lit(None).cast("string").alias("actor"), F.array("action").alias("api_calls")))
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x, allowMissingColumns=True)
    return out.withColumn("related_fr_ids", F.coalesce("related_fr_ids", empty))


# ------------------------------------------------------------------ L13, L14
def ui_evidence(call_reqs: DataFrame, cmap: DataFrame) -> DataFrame:
    """Requirement -> (component, route, required roles), one row per
    call that resolves to it (flat; no list per requirement)."""
    return (call_reqs.where(F.col("fr_id").isNotNull()).select("fr_id", "file")
            .join(shuffled(cmap.select("file", "route", "required_roles")), "file")
            .select("fr_id", F.col("file").alias("component"), "route", "required_roles"))


def attach_ui_evidence(features: DataFrame, evidence_rows: DataFrame) -> DataFrame:
    """Every requirement with its UI evidence rows (NULL component when
    it has none)."""
    return features.join(shuffled(evidence_rows), "fr_id", "left")


# ------------------------------------------------------------------ L15
def client_summary(cmap: DataFrame, ui: DataFrame, b: DataFrame, evidence_rows: DataFrame) -> DataFrame:
    """One row of totals."""
    parts = {
        "components": cmap.agg(F.count("*").alias("v")),
        "validation_messages": cmap.agg(F.sum("validation_messages").alias("v")),
        "components_with_validation": cmap.agg(F.count_if(F.col("validation_messages") > 0).alias("v")),
        "pages": ui.agg(F.count("*").alias("v")),
        "pages_with_columns": ui.agg(F.count_if(F.col("table_columns") > 0).alias("v")),
        "pages_with_form": ui.agg(F.count_if(F.col("form_fields") > 0).alias("v")),
        "pages_with_list": ui.agg(F.count_if(F.col("list_item_fields") > 0).alias("v")),
        "behaviors": b.agg(F.count("*").alias("v")),
        "requirements_covered": evidence_rows.agg(F.count_distinct("fr_id").alias("v")),
    }
    out = None
    for name, df in parts.items():
        x = df.select(F.lit(name).alias("metric"), F.coalesce(F.col("v"), F.lit(0)).cast("bigint").alias("value"))
        out = x if out is None else out.unionByName(x)
    return out


# ------------------------------------------------------------------ H20
def api_params(components: DataFrame, api: DataFrame) -> DataFrame:
    """Per component, the known client methods it calls (first
    occurrence order) with their parameter names: ``(file, ord, method, params)``."""
    calls = _facts(components).select("file", F.posexplode("client_calls").alias("ord", "client_method"))
    return (calls.join(shuffled(api_map(api)), "client_method")
            .select("file", F.col("ord").cast("int").alias("ord"), F.col("client_method").alias("method"), "params"))
