"""Earlier client extractor: the operators it adds beyond ``client``,
SURVEY J1-J21.

Same style as ``client``: native regular expressions and array functions per
row; the only shuffles are the inversions (J15) and de-duplication by text
(J2), both grouped by bounded keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codefacts.functions import text as T
from codefacts.operators.client import RX_TEMPLATE_PARAM
from codefacts.session import shuffled

# ----------------------------------------------------------------------------
# Patterns of the earlier extractor (Java syntax)
# ----------------------------------------------------------------------------
RX_AXIOS = r"""(?iU)axios\.(get|post|put|delete|patch)\s*\(\s*[`'"]([^`'"]+)[`'"]"""
RX_HTTP = r"""(?iU)\$http\.(get|post|put|delete|patch)\s*\(\s*[`'"]([^`'"]+)[`'"]"""
RX_FETCH = r"""(?iU)fetch\s*\(\s*[`'"]([^`'"]+)[`'"](?:\s*,\s*\{[^}]*method\s*:\s*[`'"](\w+)[`'"])?"""
ALERT_PATTERNS = [
    r"""(?sU)\$swal\s*\(\s*\{[^}]*?title\s*:\s*['"]([^'"]+)['"]""",
    r"""(?U)\$swal\s*\(\s*['"]([^'"]+)['"]""",
    r"""(?U)\$toast\s*\.\s*\w+\s*\(\s*['"]([^'"]{2,})['"]""",
    r"""(?U)(?<!\w)alert\s*\(\s*['"]([^'"]{2,})['"]""",
    r"""(?U)(?<!\w)confirm\s*\(\s*['"]([^'"]{2,})['"]""",
    r"""(?U)\$message\s*(?:\.\s*\w+)?\s*\(\s*['"]([^'"]{2,})['"]""",
    r"""(?sU)\$notify\s*\(\s*\{[^}]*?message\s*:\s*['"]([^'"]+)['"]""",
]
RX_COND_RENDER = r"""(?U)v-(?:if|show)\s*=\s*['"]([^'"]{3,})['"]"""
RX_DISABLED = r"""(?U):disabled\s*=\s*['"]([^'"]{2,})['"]"""
RX_CLICK = r"""(?U)@click(?:\.[\w.]+)?\s*=\s*['"]([^'"]{1,})['"]"""
RX_POLL = r"(?U)setInterval\s*\([^,]+,\s*(\d+)\s*\)"
RX_LOADING = r"(?U)this\.(?:loading|isLoading|isFetching|isPending)\s*=\s*(true|false)"
RX_LIFECYCLE = r"(?sU)(?:created|mounted)\s*\(\s*\)\s*\{([^}]+)\}"
RX_THIS_METHOD = r"(?U)this\.(\w+)\s*\("
ROLE_GUARD_PATTERNS = [
    r"""(?iU)v-if\s*=\s*['"]([^'"]*(?:role|admin|auth|permission)[^'"]*)['"]""",
    r"""(?iU)if\s*\([^)]*(?:role|isAdmin|hasPermission|auth)[^)]*\)""",
    r"""(?U)(?:roles?|permissions?)\s*(?:===?|includes?)\s*['"](\w+)['"]""",
]
UI_STRING_PATTERNS = [
    r"(?U)>\s*([가-힣a-zA-Z][가-힣a-zA-Z0-9\s]{2,})\s*<",
    r"""(?U)(?:label|placeholder|title)\s*[=:]\s*['"]([^'"]{2,})['"]""",
]
RX_SCRIPT_SETUP = r"(?s)<script(?:\s+setup)?\s*>(.*?)</script>"
RX_TEMPLATE = r"(?s)<template>(.*?)</template>"
RX_NAME = r"""(?U)name\s*:\s*['"]([^'"]+)['"]"""
RX_STORE_DISPATCH = r"""(?U)\$store\.dispatch\s*\(\s*['"](\w+)['"]"""
RX_AXIOS_ACTION = r"(?U)(?:async\s+)?(?<!\w)(\w++)\s*+\([^)]*+\)\s*\{[^}]*axios\."
RX_ROUTE_PATH = r"""(?U)path\s*:\s*['"]([^'"]+)['"]"""
RX_ROUTE_COMPONENT = (r"""(?U)component\s*:\s*(?:\(\s*\)\s*=>\s*import\s*\(\s*['"]([^'"]+)['"]"""
                      r"""|resolve\s*=>\s*\w+\(\[?['"]([^'"]+)['"]|(\w+)\s*(?:,|\n|\r))""")
RX_REQUIRES_AUTH = r"(?iU)requiresAuth\s*:\s*(true|false)"
RX_ROLES = r"(?U)roles\s*:\s*\[([^\]]+)\]"
CONTEXT_BEFORE = 200
CONTEXT_KEEP = 150


def _ordered_distinct(arr: Column, min_len: int = 0) -> Column:
    a = F.transform(arr, T.strip_ws)
    if min_len:
        a = F.filter(a, lambda x: F.length(x) >= min_len)
    return F.array_distinct(a)


# ------------------------------------------------------------------ J19, J11
def sections(files: DataFrame) -> DataFrame:
    """J19 + J11: ``(file, component_name, script, template)``; the script tag
    may carry ``setup``; the name is the declared one, else the file stem."""
    c = F.col("content")
    script = F.regexp_extract(c, RX_SCRIPT_SETUP, 1)
    stem = F.regexp_extract(F.col("path"), r"([^/]*?)(?:\.[^./]*)?$", 1)
    return files.select(F.col("path").alias("file"),
                        F.coalesce(F.nullif(F.regexp_extract(script, RX_NAME, 1), F.lit("")), stem)
                        .alias("component_name"),
                        script.alias("script"), F.regexp_extract(c, RX_TEMPLATE, 1).alias("template"))


# ------------------------------------------------------------------ J1
def api_call_list(text) -> Column:
    """``ARRAY<STRUCT<client, ord, method, url, raw_url>>`` of axios,
    vue-resource and fetch calls; ``${...}`` becomes ``:param``; fetch defaults
    to GET."""
    def part(rx, client, method_group, url_group):
        def one(g, i):
            method = g[f"g{method_group}"]
            raw = g[f"g{url_group}"]
            return F.struct(F.lit(client).alias("client"), i.alias("ord"),
                            F.when(method == "", F.lit("GET")).otherwise(F.upper(method)).alias("method"),
                            F.regexp_replace(raw, RX_TEMPLATE_PARAM, ":param").alias("url"), raw.alias("raw_url"))
        return F.transform(T.groups(text, rx, 2), one)
    return F.concat(part(RX_AXIOS, "axios", 1, 2), part(RX_HTTP, "vue-resource", 1, 2), part(RX_FETCH, "fetch", 2, 1))


def api_calls(df: DataFrame, text_col: str = "script", key: str = "file") -> DataFrame:
    """``(file, client, ord, method, url, raw_url)``, one row per call."""
    return (df.select(F.col(key).alias("file"), F.explode(api_call_list(F.col(text_col))).alias("c"))
            .select("file", "c.client", "c.ord", "c.method", "c.url", "c.raw_url"))


# ------------------------------------------------------------------ J2
def message_list(script) -> Column:
    """``ARRAY<STRUCT<ord, message, context>>`` of dialog messages in pattern
    order, the first of equal texts, with the last 150 characters of the stripped
    200 before the call. ``ord`` is the pattern's number times 10**9 plus the
    match's number."""
    script = F.col(script) if isinstance(script, str) else script

    def style(i, rx):
        def one(h, o):
            ctx = T.strip_ws(T.before(script, h["pos"], CONTEXT_BEFORE))
            return F.struct((F.lit(i * 1_000_000_000) + o).cast("long").alias("ord"),
                            T.strip_ws(F.regexp_extract(h["m"], rx, 1)).alias("message"),
                            F.right(ctx, F.lit(CONTEXT_KEEP)).alias("context"))
        return F.transform(T.finditer(script, rx), one)
    every = F.filter(F.concat(*[style(i, rx) for i, rx in enumerate(ALERT_PATTERNS)]),
                     lambda m: F.length(m["message"]) >= 2)

    def first_of_equals(ms):
        texts = F.transform(ms, lambda m: m["message"])
        return F.transform(F.array_distinct(texts), lambda t: ms[(F.array_position(texts, t) - 1).cast("int")])
    return T.let(every, first_of_equals)


def user_messages(sec: DataFrame) -> DataFrame:
    """``(file, ord, message, context)``, distinct by text within a file."""
    return (sec.select("file", F.explode(message_list("script")).alias("m"))
            .select("file", "m.ord", "m.message", "m.context"))


# ------------------------------------------------------------------ J3-J8
def conditional_renders(template) -> Column:
    """Distinct ``v-if`` / ``v-show`` expressions (3 characters or more)."""
    return _ordered_distinct(T.findall(template, RX_COND_RENDER, 1), 3)


def disabled_conditions(template) -> Column:
    """Distinct ``:disabled`` expressions, no keyword filter."""
    return _ordered_distinct(T.findall(template, RX_DISABLED, 1), 2)


def click_handlers(template) -> Column:
    """Distinct click handler expressions."""
    return _ordered_distinct(T.findall(template, RX_CLICK, 1))


def poll_intervals(script) -> Column:
    """Every ``setInterval`` delay (ms), in order."""
    return F.transform(T.findall(script, RX_POLL, 1), lambda x: x.cast("int"))


def has_loading_state(script) -> Column:
    """The loading flag is set both true and false."""
    v = T.findall(script, RX_LOADING, 1)
    return F.array_contains(v, "true") & F.array_contains(v, "false")


def lifecycle_methods(script) -> Column:
    """``this.x(`` calls inside ``created`` / ``mounted`` bodies (no nested
    braces), merged over hooks, first seen order."""
    bodies = T.findall(script, RX_LIFECYCLE, 1)
    return F.array_distinct(F.flatten(F.transform(bodies, lambda b: T.findall(b, RX_THIS_METHOD, 1))))


# ------------------------------------------------------------------ J9, J10, J20
def role_guards(text) -> Column:
    """Whole-match role guards from three patterns, distinct in order."""
    arrs = [T.findall(text, rx, 0) for rx in ROLE_GUARD_PATTERNS]
    return F.array_distinct(F.transform(F.concat(*arrs), T.strip_ws))


def ui_strings(template) -> Column:
    """Visible texts and label/placeholder/title values, distinct."""
    arrs = [T.findall(template, rx, 1) for rx in UI_STRING_PATTERNS]
    return F.array_distinct(F.filter(F.transform(F.concat(*arrs), T.strip_ws), lambda x: F.length(x) > 1))


def store_dispatches(script) -> Column:
    """Distinct ``$store.dispatch('x')`` actions."""
    return T.distinct_matches(script, RX_STORE_DISPATCH, 1)


# ------------------------------------------------------------------ J12, J13
def store_modules(files: DataFrame) -> DataFrame:
    """Store modules with API calls: ``(file, store_module, actions)``;
    actions are names whose body reaches ``axios.`` before its first ``}``."""
    stem = F.regexp_extract(F.col("path"), r"([^/]*?)(?:\.[^./]*)?$", 1)
    calls = api_calls(files.select("path", "content"), "content", "path").select("file").distinct()
    m = files.join(shuffled(calls.withColumnRenamed("file", "path")), "path", "left_semi")
    return m.select(F.col("path").alias("file"), stem.alias("store_module"),
                    T.findall("content", RX_AXIOS_ACTION, 1).alias("actions"))


def store_api_map(files: DataFrame) -> DataFrame:
    """One row per (store module, API call)."""
    mods = store_modules(files)
    calls = api_calls(files.select("path", "content"), "content", "path")
    return (mods.join(shuffled(calls), "file")
            .select("store_module", F.col("actions").alias("action_names"), F.col("method").alias("http_method"),
                    "url", "file", "client", "ord"))


# ------------------------------------------------------------------ J14, J15
def route_segments(files: DataFrame) -> DataFrame:
    """Routes by segment (this ``path:`` to the next): ``(file, ord, path,
    component_path, requires_auth, roles)``; the component is the first one
    declared after the path inside the segment."""
    content = F.col("content")

    def segments(ps):
        def one(p, i):
            nxt = F.coalesce(F.get(ps, i + 1)["pos"], F.length(content) + 1)
            return F.struct(p["m"].alias("m"), F.substring(content, p["pos"], nxt - p["pos"]).alias("seg"))
        return F.transform(ps, one)
    p = (files.select("path", F.posexplode(T.let(T.finditer(content, RX_ROUTE_PATH), segments)).alias("ord", "s"))
         .select("path", F.col("ord").cast("int").alias("ord"), "s.m", "s.seg"))
    raw = F.coalesce(*[F.nullif(F.regexp_extract("seg", RX_ROUTE_COMPONENT, g), F.lit("")) for g in (1, 2, 3)])
    roles = T.search("seg", RX_ROLES, 1)
    return p.select(
        F.col("path").alias("file"), "ord", F.regexp_extract("m", RX_ROUTE_PATH, 1).alias("route_path"),
        T.strip_ws(F.replace(raw, F.lit("@/"), F.lit(""))).alias("component_path"),
        (T.search("seg", RX_REQUIRES_AUTH, 1) == "true").alias("requires_auth"),
        F.when(roles.isNotNull(), F.transform(F.split(roles, ",", -1),
                                              lambda r: T.strip_chars(T.strip_ws(r), "'\""))).alias("roles"))


def component_route_paths(segments: DataFrame) -> DataFrame:
    """``(component, route_path)`` by the exact normalised component path
    (``src/`` removed, leading ``/`` stripped); flat, one row per route."""
    return (segments.where(F.col("component_path").isNotNull())
            .select(T.lstrip_chars(F.replace("component_path", F.lit("src/"), F.lit("")), "/").alias("component"),
                    F.col("route_path")))


# ------------------------------------------------------------------ J16-J18, J21
def observable_facts(sec: DataFrame) -> DataFrame:
    """``(component, fact_kind, ord, value, context)`` of J2-J8; all lists
    are made in one pass over the row and exploded together."""
    def facts(kind, values):
        return F.transform(values, lambda v, i: F.struct(
            F.lit(kind).alias("fact_kind"), i.cast("long").alias("ord"), v.cast("string").alias("value"),
            F.lit(None).cast("string").alias("context")))
    messages = F.transform(message_list("script"), lambda m: F.struct(
        F.lit("user_messages").alias("fact_kind"), m["ord"].alias("ord"), m["message"].alias("value"),
        m["context"].alias("context")))
    loading = F.when(has_loading_state("script"), F.array(F.lit("true"))).otherwise(F.array().cast("array<string>"))
    every = F.concat(
        messages, facts("conditional_renders", conditional_renders("template")),
        facts("disabled_conditions", disabled_conditions("template")),
        facts("click_handlers", click_handlers("template")), facts("polling", poll_intervals("script")),
        facts("has_loading_state", loading), facts("lifecycle_calls", lifecycle_methods("script")))
    return (sec.select(F.col("file").alias("component"), F.explode(every).alias("f"))
            .select("component", "f.fact_kind", "f.ord", "f.value", "f.context"))


def fact_totals(facts: DataFrame) -> DataFrame:
    """Rows per fact kind."""
    return facts.groupBy("fact_kind").agg(F.count("*").cast("bigint").alias("n"))


def component_records(sec: DataFrame) -> DataFrame:
    """The older record, one row per component: its API calls, dispatches,
    texts, guards and observable facts as lists of the file."""
    return sec.select(
        "file", "component_name", api_call_list(F.col("script")).alias("api_calls"),
        store_dispatches("script").alias("vuex_dispatches"), ui_strings("template").alias("ui_strings"),
        role_guards(F.concat("script", "template")).alias("role_guards"),
        message_list("script").alias("user_messages"),
        conditional_renders("template").alias("conditional_renders"),
        disabled_conditions("template").alias("disabled_conditions"),
        click_handlers("template").alias("click_handlers"), poll_intervals("script").alias("polling"),
        has_loading_state("script").alias("has_loading_state"),
        lifecycle_methods("script").alias("lifecycle_calls"))


def component_map_v1(sec: DataFrame, segments: DataFrame) -> DataFrame:
    """Components with API calls, dispatches or routes: their J21 record and
    the number of their routes (``n_routes``; the routes themselves are J15)."""
    routes_n = (component_route_paths(segments).groupBy("component")
                .agg(F.count("*").cast("bigint").alias("n_routes")))
    rec = component_records(sec)
    out = (rec.join(shuffled(routes_n), rec["file"] == routes_n["component"], "left").drop("component")
           .withColumnRenamed("file", "component")
           .withColumn("n_routes", F.coalesce("n_routes", F.lit(0))))
    return out.where((F.size("api_calls") > 0) | (F.size("vuex_dispatches") > 0) | (F.col("n_routes") > 0))
