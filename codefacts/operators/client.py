"""Client (Vue single-file component / JS) fact extraction, SURVEY H1-H30.

Every operator maps a table of texts to flat fact rows with native Spark
expressions. Per-file list logic (distinct in order, stop lists, pairing of
neighbouring cells, choosing the first header row) uses higher-order array
functions inside the row, so no operator here shuffles; joins with other
tables happen in ``codefacts.operators.linking``.

Python's ``re`` treats ``\\w``, ``\\s``, ``\\d`` and ``\\b`` as Unicode; the Java
patterns below therefore start with ``(?U)`` (SURVEY Q16).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from codefacts import params as P
from codefacts.functions import text as T
from codefacts.session import shuffled

# ----------------------------------------------------------------------------
# Extraction patterns (Java syntax; same matches as the analysed
# tool's Python patterns)
# ----------------------------------------------------------------------------
def _up_to(tag: str) -> str:
    """A group up to the first closing ``tag``, and that tag. It runs over whole
    pieces between ``<``: a reluctant repeat tries the tag behind every character."""
    return rf"((?:[^<]++|<(?!/{tag}>))*+)</{tag}>"


RX_TEMPLATE = r"<template>" + _up_to("template")
RX_SCRIPT = r"<script>" + _up_to("script")
RX_CLIENT_CALL = r"(?U)Client\.(\w+)\s*\("
RX_THIS_CALL = r"(?U)this\.(\w+)\s*\("
RX_DISPATCH = r"""(?U)dispatch\s*\(\s*['"](\w+)['"]"""
# a word is tried from its first character only, so a long run of letters costs one look
RX_API_HEADER = r"(?U)(?:async\s+)?(?<!\w)(\w++)\s*+\(([^)]*+)\)\s*+\{"
RX_AXIOS = r"""(?iU)axios\.(get|post|put|delete|patch)\s*\(\s*['"`]([^'"`]+)['"`]"""
RX_RETURN_URL = r"""(?U)return\s+['"`]([^'"`;]+/api/[^'"`;]+)['"`]"""
RX_TEMPLATE_PARAM = r"\$\{[^}]+\}"
RX_ROUTE_START = r"(?U)\{\s*\n?\s*path\s*:"
RX_ROUTE_PATH = r"""(?U)path\s*:\s*['"]([^'"]+)['"]"""
RX_ROUTE_NAME = r"""(?U)name\s*:\s*['"]([^'"]+)['"]"""
RX_ROUTE_COMPONENT = r"""(?U)import\s*\(\s*['"](@/[^'"]+)['"]"""
RX_ROUTE_META = r"(?U)meta\s*:\s*\{([^}]+)\}"
RX_NEEDS_PERMISSION = r"(?U)needsPermission\s*:\s*(\d+)"
RX_NEEDS_GRADUATED = r"(?U)needsGraduated\s*:\s*true"
RX_NEEDS_NOT_GRADUATED = r"(?U)needsNotGraduated\s*:\s*true"
RX_TRANSLATOR_SPLIT = r"Vue\.prototype\.\$"
RX_TRANSLATOR_NAME = r"(?U)^(\w+)"
RX_TRANSLATOR_CASE = r"""(?U)case\s+['"]([^'"]+)['"]\s*:\s*\n\s*return\s+['"]([^'"]+)['"]"""
RX_POLL = r"(?U)setInterval\s*\("
RX_POLL_DELAY = r"(?U),\s*(\d+)\s*\)\s*;?\s*$"
RX_POLL_CONTINUE = r"(?sU)if\s*\(([^)]+)\)\s*\{[^}]*return[^}]*\}[^}]*clearInterval"
RX_POLL_STOP = r"(?U)if\s*\(([^)]+)\)[^{]*\{[^}]*clearInterval"
RX_POLL_SUCCESS = r"(?U)(?:isRegistration\w+|registration_id)\s*[!=]=+\s*\w+"
RX_CLICK_TERNARY = (r"""(?iU)@click\s*=\s*"([^"]*(?:semester|term|type|status|SPRING|FALL)[^"]*)\?"""
                    r"""\s*(\w+)\s*\(\)\s*:\s*(\w+)\s*\(\)\"""")
# where it fails at the start of a line or statement, or behind a match, it fails in the rest of that line too
RX_SCRIPT_TERNARY = (r"(?iU)(?:\G|(?<![^\n;]))([^\n;]+(?:semester|term|type|status|role|SPRING|FALL)[^\n;]*)\?"
                     r"\s*(\w+)\s*\(\)\s*:\s*(\w+)\s*\(\)")
# the part of it that can be found without trying every character of a line as the start
RX_SCRIPT_CHOICE = r"(?U)\?\s*\w+\s*\(\)\s*:\s*\w+\s*\(\)"
RX_IF_ELSE = (r"(?iU)if\s*\(([^)]*(?:SPRING|FALL|semester|type|status)[^)]*)\)\s*\{([^}]*)\}"
              r"\s*(?:else\s*\{([^}]*)\})?")
RX_CONFIRM = r"(?U)inputValidator\s*:\s*(?:async\s*)?\([^)]*\)\s*=>\s*\{"
RX_CONFIRM_TEXT = r"""(?U)!==\s*['"]([^'"]{2,})['"]"""
RX_SWAL = r"""(?U)\.\$swal\s*\(\s*['"]([^'"]{2,})['"]\s*\)"""
RX_IF_COND = r"(?U)if\s*\(([^)]{3,})\)"
RX_GETTER_COND = r"(?U)if\s*\(([^)]+)\)\s*\{[\s\S]*?return\s+\w+"
RX_RETURN_FALSE = r"(?U)return\s+false"
RX_DISABLED = r""":disabled\s*=\s*"((?:[^"\\]|\\.)*+)\""""
RX_SELECT = r"<select[^>]*>" + _up_to("select")
RX_OPTION = r"""<option[^>]*value=['"]([^'"]+)['"][^>]*>([^<]+)</option>"""
RX_TITLE = r"""(?U)<p\s+class=['"](?:title|solo_title)['"][^>]*>([^<]+)</p>"""
RX_THEAD = r"<thead>" + _up_to("thead")
RX_TR_ATTR = r"<tr([^>]*)>" + _up_to("tr")
RX_TD_TEXT = r"<td[^>]*>([^<]*)</td>"
RX_TBODY = r"<tbody>" + _up_to("tbody")
RX_TR = r"<tr[^>]*>" + _up_to("tr")
RX_TD = r"<td[^>]*>" + _up_to("td")
RX_TAG = r"<[^>]+>"
RX_VMODEL = r"""(?U)v-model\s*=\s*['"]([^'"]+)['"]"""
RX_INPUT_TYPE = r"""(?U)type\s*=\s*['"]([^'"]+)['"]"""
RX_DISABLED_ATTR = r"""(?U):disabled\s*=\s*['"]([^'"]+)['"]"""
RX_BARE_DISABLED = r"(?U)\bdisabled\b(?!\s*=)"
RX_BARE_READONLY = r"(?U)\breadonly\b(?!\s*=)"
RX_REQUIRED_CLASS = r"""class=['"][^'"]*(needs)[^'"]* ['"]"""
REQUIRED_STAR = '<span class="needs">*'
RX_VFOR = r"""(?U)v-for\s*=\s*['"](?:\((\w+)(?:,\s*\w+)?\)|(\w+))\s+in\s+\w+['"]"""
RX_MEMBER_CHAIN = r"(?U)(?<!\w)\w++(?:\.\w++)++"
RX_STORE_ACTION = r"(?U)(?:async\s+)?(?<!\w)(\w++)\s*+\(\s*\{[^}]*\}\s*(?:,\s*[^)]+)?\)\s*\{"
RX_STORE_GETTER = r"(?U)(?<!\w)(\w++)\s*+\(\s*state\s*\)\s*\{"
RX_STATE_BLOCK = r"(?U)state\s*:\s*\{([^}]+)\}"
RX_STATE_FIELD = r"(?U)(?<!\w)(\w++)\s*+:"


def _str_array(values) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def _explode_list(df: DataFrame, keys: list[str], arr: Column, name: str) -> DataFrame:
    return (df.select(*keys, F.posexplode(arr).alias("ord", name))
            .withColumn("ord", F.col("ord").cast("int")))


# ------------------------------------------------------------------ H9, J19
def split_sfc(files: DataFrame, path: str = "path") -> DataFrame:
    """H9: ``(file, template, script)``; a missing section is ``''``.

    The template ends at the first closing tag (nested templates are cut) and
    the script tag must carry no attributes (SURVEY Q19).
    """
    c = F.col("content")
    return files.select(F.col(path).alias("file"),
                        F.regexp_extract(c, RX_TEMPLATE, 1).alias("template"),
                        F.regexp_extract(c, RX_SCRIPT, 1).alias("script"))


# ------------------------------------------------------------------ H10-H12
def client_call_list(script) -> Column:
    """Distinct ``Client.x(`` method names in first-seen order."""
    return T.distinct_matches(script, RX_CLIENT_CALL, 1)


def this_call_list(script, skip=P.THIS_CALL_SKIP) -> Column:
    """Distinct ``this.x(`` names minus the stop list, first-seen order."""
    return F.array_except(T.findall(script, RX_THIS_CALL, 1), _str_array(skip))


def dispatch_list(script) -> Column:
    """Distinct store dispatches in first-seen order."""
    return T.distinct_matches(script, RX_DISPATCH, 1)


def component_calls(components: DataFrame) -> DataFrame:
    """H10-H12 as rows ``(file, call_kind, ord, method)``."""
    s = F.col("script")
    parts = [
        _explode_list(components, ["file"], client_call_list(s), "method").withColumn("call_kind", F.lit("client")),
        _explode_list(components, ["file"], dispatch_list(s), "method").withColumn("call_kind", F.lit("dispatch")),
        _explode_list(components, ["file"], this_call_list(s), "method").withColumn("call_kind", F.lit("this")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("file", "call_kind", "ord", "method")


# ------------------------------------------------------------------ H1
def decode_perm(mask, bits=P.PERM_BITS) -> Column:
    """H1: role names whose bit is set in ``mask``, ascending bit order.

    NULL or 0 gives an empty list.
    """
    mask = F.col(mask) if isinstance(mask, str) else mask
    roles = F.array(*[F.struct(F.lit(b).alias("bit"), F.lit(r).alias("role")) for b, r in sorted(bits)])
    return F.coalesce(
        F.transform(F.filter(roles, lambda x: mask.bitwiseAND(x["bit"]) != 0), lambda x: x["role"]),
        F.array().cast("array<string>"))


# ------------------------------------------------------------------ H2, H3
def translator_labels(files: DataFrame) -> DataFrame:
    """H2: ``(path, block_ord, fn, value, label)`` from prototype switch blocks.

    A function name repeated later in the file replaces the earlier block, and
    inside a block a repeated value keeps its last label (dict semantics).
    """
    blocks = F.split(F.col("content"), RX_TRANSLATOR_SPLIT, -1)
    b = (files.select("path", F.posexplode(F.slice(blocks, 2, 1 << 30)).alias("block_ord", "block"))
         .withColumn("fn", F.regexp_extract("block", RX_TRANSLATOR_NAME, 1))
         .where(F.col("fn") != "")
         .select("path", F.col("block_ord").cast("int").alias("block_ord"), "fn",
                 F.posexplode(T.groups("block", RX_TRANSLATOR_CASE, 2)).alias("pair_ord", "p"))
         .select("path", "block_ord", "fn", "pair_ord",
                 F.col("p.g1").alias("value"), F.col("p.g2").alias("label")))
    last_block = (b.groupBy("path", "fn").agg(F.max("block_ord").alias("_b")))
    b = b.join(shuffled(last_block), ["path", "fn"]).where(F.col("block_ord") == F.col("_b")).drop("_b")
    return (b.groupBy("path", "block_ord", "fn", "value")
            .agg(F.max_by("label", "pair_ord").alias("label"), F.min("pair_ord").alias("ord"))
            .select("path", "block_ord", "fn", "ord", "value", "label"))


def domain_of(fn, mapping=P.TRANSLATOR_FUNC_TO_DOMAIN) -> Column:
    """H3: domain name of a translator function; its own name by default."""
    fn = F.col(fn) if isinstance(fn, str) else fn
    m = F.create_map(*[x for k, v in mapping for x in (F.lit(k), F.lit(v))])
    return F.coalesce(F.try_element_at(m, fn), fn)


# ------------------------------------------------------------------ H4-H6
def api_methods(files: DataFrame, budget: int | None = None, skip=P.API_METHOD_SKIP) -> DataFrame:
    """H4-H6: ``(path, ord, client_method, http_method, url, params)``.

    A method header opens a block that runs to its closing brace (``budget``:
    at most that long); the first axios call gives verb and URL (H5), else a
    returned ``/api/`` URL counts as GET with ``${...}`` parts as ``:param`` (H6).
    A method name seen again later in the file keeps its last hit.
    """
    m = (files.select("path", F.posexplode(T.blocks("content", RX_API_HEADER, budget=budget)).alias("ord", "h"))
         .select("path", F.col("ord").cast("int").alias("ord"),
                 F.regexp_extract("h.m", RX_API_HEADER, 1).alias("client_method"),
                 F.regexp_extract("h.m", RX_API_HEADER, 2).alias("_params"), F.col("h.body").alias("body"))
         .where(~F.col("client_method").isin(*skip)))
    ax = T.search("body", RX_AXIOS, 0)
    ret_url = F.when(F.col("body").contains("return `") | F.col("body").contains("return '"),
                     T.search("body", RX_RETURN_URL, 1))
    m = m.select(
        "path", "ord", "client_method",
        F.filter(F.transform(F.split(T.strip_ws("_params"), ",", -1), T.strip_ws), lambda x: x != "")
        .alias("params"),
        F.when(ax.isNotNull(), F.upper(F.regexp_extract("body", RX_AXIOS, 1)))
        .when(ret_url.isNotNull(), F.lit("GET")).alias("http_method"),
        F.when(ax.isNotNull(), F.regexp_extract("body", RX_AXIOS, 2))
        .when(ret_url.isNotNull(), F.regexp_replace(ret_url, RX_TEMPLATE_PARAM, ":param")).alias("url"))
    hits = m.where(F.col("http_method").isNotNull())
    last = (hits.groupBy("path", "client_method")
            .agg(F.max_by(F.struct("ord", "http_method", "url", "params"), "ord").alias("w")))
    return last.select("path", F.col("w.ord").alias("ord"), "client_method",
                       F.col("w.http_method").alias("http_method"), F.col("w.url").alias("url"),
                       F.col("w.params").alias("params"))


# ------------------------------------------------------------------ H7, H8
def routes(files: DataFrame, budget: int | None = None) -> DataFrame:
    """H7-H8: one row per route object; nested child routes are rows too."""
    found = T.blocks("content", RX_ROUTE_START, open_first=True, budget=budget)
    r = (files.select("path", F.posexplode(found).alias("ord", "h"))
         .select("path", F.col("ord").cast("int").alias("ord"), F.col("h.body").alias("block")))
    meta = F.coalesce(T.search("block", RX_ROUTE_META, 1), F.lit(""))
    mask = T.search(meta, RX_NEEDS_PERMISSION, 1).cast("int")
    comp = T.search("block", RX_ROUTE_COMPONENT, 1)
    out = r.select(
        F.col("path").alias("source"), "ord",
        T.search("block", RX_ROUTE_PATH, 1).alias("path"),
        T.search("block", RX_ROUTE_NAME, 1).alias("name"),
        F.replace(comp, F.lit("@/"), F.lit("src/")).alias("component_file"),
        F.col("block").contains("requireAuth").alias("requires_auth"),
        mask.alias("permission_bitmask"),
        decode_perm(mask).alias("required_roles"),
        meta.rlike(RX_NEEDS_GRADUATED).alias("needs_graduated"),
        meta.rlike(RX_NEEDS_NOT_GRADUATED).alias("needs_not_graduated"))
    return out.where(F.col("path").isNotNull())


# ------------------------------------------------------------------ H13
def lifecycle_list(script="script", hooks=P.LIFECYCLE_HOOKS, budget: int | None = None) -> Column:
    """Calls of the first ``created()`` / ``mounted()`` body, one struct per
    hook; hooks without calls omitted."""
    def of_hook(hook):
        return T.let(T.first_block(script, r"(?U)" + hook + r"\s*\(\s*\)\s*\{", budget=budget), lambda body: F.struct(
            F.lit(hook).alias("lifecycle_hook"), client_call_list(body).alias("direct_calls"),
            dispatch_list(body).alias("dispatch_calls"), this_call_list(body).alias("indirect_calls")))
    return F.filter(F.array(*map(of_hook, hooks)), lambda h: (
        (F.size(h["direct_calls"]) > 0) | (F.size(h["dispatch_calls"]) > 0) | (F.size(h["indirect_calls"]) > 0)))


def lifecycle_calls(components: DataFrame, hooks=P.LIFECYCLE_HOOKS, budget: int | None = None) -> DataFrame:
    """``(file, lifecycle_hook, direct_calls, dispatch_calls, indirect_calls)``."""
    return components.select("file", F.inline(lifecycle_list("script", hooks, budget)))


# ------------------------------------------------------------------ H14
def polling_list(script="script", budget: int | None = None) -> Column:
    """One struct per ``setInterval(`` with delay, calls and conditions."""
    def one(h):
        call = h["body"]
        cont = T.search(call, RX_POLL_CONTINUE, 1)
        stop = T.search(call, RX_POLL_STOP, 1)
        return F.struct(
            T.search(T.strip_ws(call), RX_POLL_DELAY, 1).cast("int").alias("interval_ms"),
            client_call_list(call).alias("direct_calls"), this_call_list(call).alias("indirect_calls"),
            dispatch_list(call).alias("dispatch_calls"),
            F.when(cont.isNotNull(), F.concat(F.lit("NOT ("), T.strip_ws(cont), F.lit(")")))
            .otherwise(T.strip_ws(stop)).alias("termination_condition"),
            T.strip_ws(T.search(call, RX_POLL_SUCCESS, 0)).alias("success_condition"))
    return F.transform(T.blocks(script, RX_POLL, "(", ")", keep_header=True, budget=budget), one)


def _numbered(components: DataFrame, items: Column) -> DataFrame:
    return (components.select("file", F.posexplode(items).alias("ord", "x"))
            .select("file", F.col("ord").cast("int").alias("ord"), "x.*"))


def polling(components: DataFrame, budget: int | None = None) -> DataFrame:
    """``(file, ord, interval_ms, ...)``, one row per poller."""
    return _numbered(components, polling_list("script", budget))


# ------------------------------------------------------------------ H15-H17
CHOICES = "array<struct<pattern:string,source:string,ord:int,condition:string,true_calls:array<string>,false_calls:array<string>>>"


def conditional_list(template="template", script="script") -> Column:
    """Conditional API choices ``(pattern, source, ord, condition,
    true_calls, false_calls)``.

    Ternaries carry one method per branch; an if/else carries the client calls
    (duplicates kept) followed by the ``this`` calls of each branch, and is kept
    only when some branch calls something.
    """
    def choice(pattern, source, i, g, yes, no):
        return F.struct(F.lit(pattern).alias("pattern"), F.lit(source).alias("source"), i.alias("ord"),
                        T.strip_ws(g["g1"]).alias("condition"), yes.alias("true_calls"), no.alias("false_calls"))

    def ternary(col, rx, pattern, source):
        return F.transform(T.groups(col, rx, 3), lambda g, i: choice(pattern, source, i, g, F.array(g["g2"]), F.array(g["g3"])))

    def branch(text):
        return F.concat(T.findall(text, RX_CLIENT_CALL, 1), this_call_list(text))
    script = F.col(script) if isinstance(script, str) else script
    choices = ternary(script, RX_SCRIPT_TERNARY, "script_ternary", "script")
    choices = F.when(~script.rlike(RX_SCRIPT_CHOICE), F.array().cast(CHOICES)).otherwise(choices)
    ie = F.transform(T.groups(script, RX_IF_ELSE, 3),
                     lambda g, i: choice("if_else", "script", i, g, branch(g["g2"]), branch(g["g3"])))
    return F.concat(ternary(template, RX_CLICK_TERNARY, "template_ternary", "template"),
                    choices,
                    F.filter(ie, lambda c: (F.size(c["true_calls"]) > 0) | (F.size(c["false_calls"]) > 0)))


def conditional_api(components: DataFrame) -> DataFrame:
    """``(file, pattern, source, ord, condition, true_calls, false_calls)``."""
    return components.select("file", F.inline(conditional_list()))


# ------------------------------------------------------------------ H18
def confirmation_list(script="script", budget: int | None = None, before: int = 800, behind: int = 200) -> Column:
    """Exact-text confirmation validators with the client calls near them.

    "Near" is from ``before`` characters before to ``behind`` after the start of
    the validator: the distance is what the fact states, it cuts nothing off the
    validator itself."""
    text = F.col(script) if isinstance(script, str) else script

    def one(h, i):
        lo = F.greatest(F.lit(1), h["pos"] - before)
        return F.struct(i.alias("ord"), T.search(h["body"], RX_CONFIRM_TEXT, 1).alias("required_text"),
                        client_call_list(F.substring(text, lo, h["pos"] + behind - lo)).alias("nearby_api_calls"))
    return F.filter(F.transform(T.blocks(text, RX_CONFIRM, budget=budget), one), lambda g: g["required_text"].isNotNull())


def confirmation_guards(components: DataFrame, budget: int | None = None, before: int = 800,
                        behind: int = 200) -> DataFrame:
    """``(file, ord, required_text, nearby_api_calls)``."""
    return components.select("file", F.inline(confirmation_list("script", budget, before, behind)))


# ------------------------------------------------------------------ H19
def message_list(script="script", before: int = 400, behind: int = 80) -> Column:
    """Dialog messages with the nearest preceding ``if`` condition (within
    ``before`` characters, which is what makes it the message's own) and type
    validation > success > error > info."""
    text = F.col(script) if isinstance(script, str) else script

    def one(h):
        message = F.regexp_extract(h["m"], RX_SWAL, 1)
        cond = T.strip_ws(F.try_element_at(T.findall(T.before(text, h["pos"], before), RX_IF_COND, 1), F.lit(-1)))
        kind = (F.when(T.after(text, h["pos"], behind).rlike(RX_RETURN_FALSE), "validation")
                .when(T.contains_any(message, P.SUCCESS_WORDS), "success")
                .when(T.contains_any(message, P.ERROR_WORDS), "error").otherwise("info"))
        return F.struct(message.alias("message"), cond.alias("condition"), kind.alias("type"))
    return F.transform(T.finditer(text, RX_SWAL), one)


def validation_messages(components: DataFrame, before: int = 400, behind: int = 80) -> DataFrame:
    """``(file, ord, message, condition, type)``."""
    return _numbered(components, message_list("script", before, behind))


# ------------------------------------------------------------------ H21-H26
def disabled_guards(components: DataFrame, words=P.DISABLED_GUARD_WORDS) -> DataFrame:
    """``:disabled`` expressions that mention a state word."""
    return (_explode_list(components, ["file"], T.findall("template", RX_DISABLED, 1), "condition")
            .where(T.contains_any("condition", words)))


def select_option_list(template="template") -> Column:
    """``(select_ord, ord, value, label)`` of static select options."""
    def of_select(block, select_ord):
        return F.transform(T.groups(block, RX_OPTION, 2), lambda o, i: F.struct(
            select_ord.alias("select_ord"), i.alias("ord"), o["g1"].alias("value"), T.strip_ws(o["g2"]).alias("label")))
    return F.flatten(F.transform(T.findall(template, RX_SELECT, 1), of_select))


def select_options(components: DataFrame) -> DataFrame:
    """``(file, select_ord, ord, value, label)``."""
    return components.select("file", F.inline(select_option_list()))


def disabled_list(template="template", words=P.DISABLED_GUARD_WORDS) -> Column:
    """H21 as a list."""
    return F.filter(T.findall(template, RX_DISABLED, 1), lambda x: T.contains_any(x, words))


def page_title(template) -> Column:
    """Breadcrumb text of ``<p class="title">``; NULL when absent."""
    return T.strip_ws(T.search(template, RX_TITLE, 1))


def table_column_list(template="template") -> Column:
    """Header cells of the first ``thead`` row without ``v-if`` (else the
    first row); blank cells dropped; null without a ``thead``."""
    def header(rows):
        chosen = F.coalesce(F.try_element_at(F.filter(rows, lambda r: ~r["g1"].contains("v-if")), F.lit(1)),
                            F.try_element_at(rows, F.lit(1)))["g2"]
        return F.filter(F.transform(T.findall(chosen, RX_TD_TEXT, 1), T.strip_ws), lambda x: x != "")
    return T.let(T.groups(T.search(template, RX_THEAD, 1), RX_TR_ATTR, 2), header)


def table_columns(components: DataFrame) -> DataFrame:
    """``(file, ord, column)``."""
    return _explode_list(components.select("file", table_column_list().alias("_c")), ["file"], F.col("_c"), "column")


def form_field_list(template="template") -> Column:
    """Label cell followed by an input cell, per ``tbody`` row.

    Cells are paired with their right neighbour inside the row (``zip_with``
    over the cell array), so no window or shuffle is involved.
    """
    rows = T.findall(F.coalesce(T.search(template, RX_TBODY, 1), F.lit("")), RX_TR, 1)

    def field(row_ord, i, cell, nxt):
        dis = T.search(nxt, RX_DISABLED_ATTR, 1)
        kind = F.coalesce(T.search(nxt, RX_INPUT_TYPE, 1), F.when(nxt.contains("<select"), "select")
                          .when(nxt.contains("<textarea"), "textarea").otherwise("text"))
        return F.struct(
            row_ord.alias("row_ord"), i.alias("cell_ord"), T.strip_ws(F.regexp_replace(cell, RX_TAG, "")).alias("label"),
            T.search(nxt, RX_VMODEL, 1).alias("v_model"), kind.alias("input_type"),
            (cell.rlike(RX_REQUIRED_CLASS) | cell.contains(REQUIRED_STAR)).alias("required"),
            F.when(dis.isNotNull(), T.strip_ws(dis) == "true")
            .otherwise(nxt.rlike(RX_BARE_DISABLED) | nxt.rlike(RX_BARE_READONLY)).alias("immutable"))

    def of_row(row, row_ord):
        def pairs(tds):
            n = F.greatest(F.size(tds) - 1, F.lit(0))
            near = F.zip_with(F.slice(tds, 1, n), F.slice(tds, 2, n), lambda a, b: F.struct(a.alias("cell"), b.alias("nxt")))
            near = F.transform(near, lambda p, i: F.struct(i.alias("i"), p["cell"].alias("cell"), p["nxt"].alias("nxt")))
            held = F.filter(near, lambda p: p["nxt"].rlike("<(?:input|select|textarea)"))
            return F.transform(held, lambda p: field(row_ord, p["i"], p["cell"], p["nxt"]))
        return T.let(T.findall(row, RX_TD, 1), pairs)
    return F.filter(F.flatten(F.transform(rows, of_row)), lambda f: f["label"] != "")


def form_fields(components: DataFrame) -> DataFrame:
    """``(file, row_ord, cell_ord, label, v_model, input_type, required, immutable)``."""
    return components.select("file", F.inline(form_field_list()))


def vfor_fields(template, skip=P.VFOR_FIELD_SKIP) -> Column:
    """Sorted distinct property names used on any ``v-for`` loop variable.

    All chains ``a.b.c`` are taken in one walk, cut into their words, and a word is
    kept when the one in front of it is a loop variable; no per-row dynamic pattern.
    """
    loops = T.groups(template, RX_VFOR, 2)
    vars_ = F.transform(loops, lambda g: F.when(g["g1"] != "", g["g1"]).otherwise(g["g2"]))

    def members(names):
        def of_chain(words):
            return F.filter(F.zip_with(F.slice(words, 1, F.size(words) - 1), F.slice(words, 2, F.size(words) - 1), lambda a, b: F.when(
                F.array_contains(names, a), b)), lambda b: b.isNotNull() & ~F.array_contains(_str_array(skip), b))
        chains = F.transform(T.findall(template, RX_MEMBER_CHAIN, 0), lambda c: F.split(c, r"\.", -1))
        found = F.array_sort(F.array_distinct(F.flatten(F.transform(chains, of_chain))))
        return F.when(F.size(names) > 0, found).when(names.isNotNull(), F.array().cast("array<string>"))
    return T.let(vars_, members)


# ------------------------------------------------------------------ H28-H30
def store_actions(files: DataFrame, budget: int | None = None, skip=P.STORE_ACTION_SKIP) -> DataFrame:
    """``(path, action, ord, client_method)`` for actions that call the API.
    A repeated action name keeps its last definition."""
    a = (files.select("path", F.posexplode(T.blocks("content", RX_STORE_ACTION, budget=budget)).alias("aord", "h"))
         .select("path", F.col("aord").cast("int").alias("aord"),
                 F.regexp_extract("h.m", RX_STORE_ACTION, 1).alias("action"), F.col("h.body").alias("body"))
         .where(~F.col("action").isin(*skip))
         .select("path", "aord", "action", client_call_list("body").alias("calls"))
         .where(F.size("calls") > 0))
    last = a.groupBy("path", "action").agg(F.max_by("calls", "aord").alias("calls"))
    return _explode_list(last, ["path", "action"], F.col("calls"), "client_method")


def store_getters(files: DataFrame, skip=P.STORE_GETTER_SKIP) -> DataFrame:
    """Getters that filter on a condition, ``(path, ord, getter, filter_condition)``:
    the first ``if`` of the getter's body whose block returns something."""
    def getter(h):
        return F.struct(F.regexp_extract(h["m"], RX_STORE_GETTER, 1).alias("getter"),
                        T.strip_ws(T.search(h["body"], RX_GETTER_COND, 1)).alias("filter_condition"))
    found = F.filter(F.transform(T.blocks("content", RX_STORE_GETTER), getter),
                     lambda g: g["filter_condition"].isNotNull())
    return (files.select("path", F.posexplode(found).alias("ord", "g"))
            .select("path", F.col("ord").cast("int").alias("ord"), "g.getter", "g.filter_condition")
            .where(~F.col("getter").isin(*skip)))


def store_state(files: DataFrame, skip=P.STORE_STATE_SKIP) -> DataFrame:
    """Persistent state field names, minus the skip list (order kept)."""
    block = F.coalesce(T.search("content", RX_STATE_BLOCK, 1), F.lit(""))
    fields = F.filter(T.findall(block, RX_STATE_FIELD, 1), lambda x: ~x.isin(*skip))
    return _explode_list(files, ["path"], fields, "field")


# ------------------------------------------------------------------ H27
def component_facts(components: DataFrame) -> DataFrame:
    """All facts of H10-H26 of a component in one row, from one pass over its
    text: what is read from ``components`` is read once, and what is linked later
    (routes, API map, requirements) starts from this narrow table. Lists are
    those of one file.

    ``(file, client_calls, store_dispatches, this_calls, lifecycle_auto_calls,
    polling, conditional_api_branches, confirmation_guards, disabled_guards,
    domain_constants, page_title, table_columns, form_fields, vfor_fields,
    validation_messages)``."""
    t, s = F.col("template"), F.col("script")
    facts = components.select(
        "file", client_call_list(s).alias("client_calls"), dispatch_list(s).alias("store_dispatches"),
        this_call_list(s).alias("this_calls"), lifecycle_list(s).alias("lifecycle_auto_calls"),
        polling_list(s).alias("polling"), conditional_list(t, s).alias("conditional_api_branches"),
        confirmation_list(s).alias("confirmation_guards"), disabled_list(t).alias("disabled_guards"),
        select_option_list(t).alias("domain_constants"), page_title(t).alias("page_title"),
        table_column_list(t).alias("table_columns"), form_field_list(t).alias("form_fields"),
        vfor_fields(t).alias("vfor_fields"), message_list(s).alias("validation_messages"))
    # a list without a match may be null
    return facts.select(*[F.coalesce(f.name, F.array().cast(f.dataType)).alias(f.name)
                          if isinstance(f.dataType, ArrayType) else f.name for f in facts.schema.fields])


def component_records(components: DataFrame) -> DataFrame:
    """The facts that are plain lists of names."""
    return component_facts(components).select("file", "client_calls", "store_dispatches", "this_calls", "page_title",
                                              "vfor_fields", "disabled_guards")
