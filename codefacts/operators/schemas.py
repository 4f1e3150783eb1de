"""Request / response schema enrichment, SURVEY E1-E18.

Schemas are kept flat: one row per field with its JSON key path from the
root (``path``), the expansion depth, and an order path (``ord_path``) that
sorts rows exactly as the nested document lists them (declared fields first,
then fields promoted from embedded structs).

Recursive expansion (E8) is six unrolled rounds of ``calls ⋈ fields``: a
round expands every pending (struct, depth, visited, path) call at once, so
the work is a bounded number of joins whatever the number of roots.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from codefacts import params as P
from codefacts.functions import text as T
from codefacts.session import checkpoint_dir, cut, shuffled

# ----------------------------------------------------------------------------
# JSON key pattern, case conversion and descriptions
# ----------------------------------------------------------------------------
RX_JSON_KEY = r'json:"([^,"\\]+)'
RX_ACRONYM = r"([A-Z]+)([A-Z][a-z])"
RX_CAMEL = r"([a-z\d])([A-Z])"
PLACEHOLDER_DESCRIPTION = "recursive/deep reference"
UNKNOWN_DESCRIPTION = "unknown type "
EMBED_ORD_BASE = 1 << 50


# ------------------------------------------------------------------ E1
def struct_registry(structs: DataFrame, types_prefix: str = "types/") -> DataFrame:
    """One winning definition per struct name: ``(name, path, ord, body)``.

    The first definition wins (least ``(path, ord)``), except that a file under
    ``types_prefix`` overrides, and among those the last one wins. Two
    partial aggregations, no window sort, so a name defined very often does
    not gather its rows in one task.
    """
    s = structs.withColumn("_t", F.col("path").startswith(types_prefix))
    agg = s.groupBy("name").agg(
        F.max(F.when(F.col("_t"), F.struct("path", "ord", "body"))).alias("_tw"),
        F.min(F.when(~F.col("_t"), F.struct("path", "ord", "body"))).alias("_ow"))
    w = F.coalesce(F.col("_tw"), F.col("_ow"))
    return agg.select("name", w["path"].alias("path"), w["ord"].alias("ord"), w["body"].alias("body"))


# ------------------------------------------------------------------ E2-E7
def json_key(tag, name) -> Column:
    """Key from the ``json`` tag, else acronym-aware snake case."""
    tag = F.col(tag) if isinstance(tag, str) else tag
    name = F.col(name) if isinstance(name, str) else name
    snake = F.lower(F.regexp_replace(F.regexp_replace(name, RX_ACRONYM, "$1_$2"), RX_CAMEL, "$1_$2"))
    return F.coalesce(F.nullif(T.search(F.coalesce(tag, F.lit("")), RX_JSON_KEY, 1), F.lit("")), snake)


def is_optional(ftype, tag) -> Column:
    """Pointer, slice of pointers, or ``omitempty`` in the tag."""
    ftype = F.col(ftype) if isinstance(ftype, str) else ftype
    tag = F.col(tag) if isinstance(tag, str) else tag
    return (ftype.startswith("*") | ftype.startswith("[]*")
            | F.coalesce(tag, F.lit("")).contains("omitempty"))


def raw_type(ftype) -> Column:
    """Type with leading ``[``, ``]`` and ``*`` removed."""
    return T.lstrip_chars(ftype, "[]*")


def base_type(ftype, aliases=P.TYPE_NAME_ALIASES) -> Column:
    """E5: wrapper characters stripped, package prefix dropped, alias applied."""
    t = F.element_at(F.split(raw_type(ftype), r"\.", -1), -1)
    m = F.create_map(*[x for k, v in aliases for x in (F.lit(k), F.lit(v))])
    return F.coalesce(F.try_element_at(m, t), t)


def is_primitive(ftype, primitives=P.PRIMITIVE_TYPES, suffix_rule: bool = True) -> Column:
    """Primitive by name (base or raw) or, with ``suffix_rule``,
    any raw type ending in ``int`` / ``float``."""
    raw = raw_type(ftype)
    c = base_type(ftype).isin(*primitives) | raw.isin(*primitives)
    if suffix_rule:
        c = c | raw.endswith("int") | raw.endswith("float")
    return c


def _scalars(spark: SparkSession, scalars=P.SCALAR_ALIASES) -> DataFrame:
    return spark.createDataFrame(list(scalars), "_sname string, _stype string, _sdesc string")


# ------------------------------------------------------------------ E11 inputs
def embedded_candidates(registry: DataFrame, fields: DataFrame) -> DataFrame:
    """Per registered struct, body lines that name another registered
    struct: ``(name, eord, lookup)``. A line qualifies when, stripped, it is
    non-empty, holds no blank and is no declared field name; ``a.B`` looks up
    ``B``; the first letter raised is tried first. ``*X`` never qualifies
    (SURVEY Q12)."""
    lines = (registry.select("name", "path", F.posexplode(F.split("body", r"\r?\n|\r", -1)).alias("eord", "line"))
             .select("name", "path", "eord", T.strip_ws("line").alias("s"))
             .where((F.col("s") != "") & ~F.col("s").contains(" ")))
    known = fields.select(F.col("path").alias("_p"), F.col("struct").alias("_st"), F.col("name").alias("s")).distinct()
    lines = lines.join(shuffled(known), (lines["path"] == known["_p"]) & (lines["name"] == known["_st"])
                       & (lines["s"] == known["s"]), "left_anti")
    et = F.element_at(F.split("s", r"\.", -1), -1)
    cap = F.concat(F.upper(F.substring(et, 1, 1)), F.substring(et, 2, 1 << 30))
    lines = lines.select("name", "eord", et.alias("_et"), cap.alias("_cap"))
    names1 = registry.select(F.col("name").alias("_n1"))
    names2 = registry.select(F.col("name").alias("_n2"))
    j = (lines.join(shuffled(names1), lines["_cap"] == names1["_n1"], "left")
         .join(shuffled(names2), lines["_et"] == names2["_n2"], "left"))
    return (j.select("name", F.col("eord").cast("int").alias("eord"),
                     F.coalesce("_n1", "_n2").alias("lookup"))
            .where(F.col("lookup").isNotNull()))


# ------------------------------------------------------------------ E8-E10
def expand_schemas(spark: SparkSession, roots: DataFrame, registry: DataFrame, fields: DataFrame,
                   max_depth: int | None = None, suffix_rule: bool = True) -> DataFrame:
    """Flat expansion of every ``root`` struct name in ``roots``.

    Output ``(root, path ARRAY<STRING>, depth, ord_path ARRAY<BIGINT>, json_key,
    go_type, required, is_array, description)``. Type cascade: session id >
    scalar alias > primitive > known struct > raw. A struct already on the
    current path yields one placeholder row, and so does a call deeper than
    ``max_depth`` where one is given; an unregistered name yields an "unknown type" row. ``sessionID``
    fields are kept (required) only at the root.

    ``fields`` is the G9 table restricted to the winning definitions.
    """
    checkpoint_dir(spark)
    registry = cut(registry)
    reg = registry.select(F.col("name").alias("_rn"), F.col("path").alias("_rp"), F.col("ord").alias("_ro"))
    fields = cut(fields.join(shuffled(reg), (fields["path"] == reg["_rp"]) & (fields["struct_ord"] == reg["_ro"]),
                             "left_semi"))
    fl = fields.select(F.col("path").alias("_fp"), F.col("struct_ord").alias("_fo"),
                       F.col("ord").alias("_ford"), F.col("name").alias("_fname"),
                       F.col("type").alias("_ftype"), F.col("tag").alias("_ftag"))
    emb = cut(embedded_candidates(registry, fields).select(
        F.col("name").alias("_en"), "eord", F.col("lookup").alias("_lookup")))
    sc = _scalars(spark)
    empty_s = F.array().cast("array<string>")
    empty_i = F.array().cast("array<bigint>")
    calls = cut(roots.select("root", F.col("root").alias("name"), F.lit(0).alias("depth"),
                             empty_s.alias("visited"), empty_s.alias("kpath"), empty_i.alias("opath")))
    row_cols = ["root", "kpath", "depth", "ord_path", "json_key", "go_type", "required", "is_array", "description"]
    out = []
    while True:
        stop = F.array_contains("visited", F.col("name"))
        if max_depth is not None:
            stop = stop | (F.col("depth") > max_depth)
        ph = calls.where(stop).select(
            "root", "kpath", "depth", F.array_append("opath", F.lit(0)).alias("ord_path"),
            F.concat(F.lit("<"), F.col("name"), F.lit(">")).alias("json_key"),
            F.col("name").alias("go_type"), F.lit(False).alias("required"),
            F.lit(None).cast("boolean").alias("is_array"),
            F.lit(PLACEHOLDER_DESCRIPTION).alias("description"))
        live = calls.where(~stop)
        unk = live.join(shuffled(reg), live["name"] == reg["_rn"], "left_anti").select(
            "root", "kpath", "depth", F.array_append("opath", F.lit(0)).alias("ord_path"),
            F.lower("name").alias("json_key"), F.col("name").alias("go_type"),
            F.lit(False).alias("required"), F.lit(None).cast("boolean").alias("is_array"),
            F.concat(F.lit(UNKNOWN_DESCRIPTION), F.col("name")).alias("description"))
        known = live.join(shuffled(reg), live["name"] == reg["_rn"])
        f = known.join(shuffled(fl), (known["_rp"] == fl["_fp"]) & (known["_ro"] == fl["_fo"]))
        ft, tag = F.col("_ftype"), F.col("_ftag")
        f = (f.withColumn("_jk", json_key(tag, "_fname")).withColumn("_opt", is_optional(ft, tag))
             .withColumn("_bt", base_type(ft))
             .join(sc, F.col("_bt") == sc["_sname"], "left")
             .join(shuffled(reg.select(F.col("_rn").alias("_sn"))), F.col("_bt") == F.col("_sn"), "left")
             .where(~((ft == P.SESSION_ID_TYPE) & (F.col("depth") > 0))))
        prim = is_primitive(ft, suffix_rule=suffix_rule) | F.col("_bt").isin(*P.PRIMITIVE_TYPES)
        kind = (F.when(ft == P.SESSION_ID_TYPE, "session").when(F.col("_sname").isNotNull(), "scalar")
                .when(prim, "primitive").when(F.col("_sn").isNotNull(), "struct").otherwise("raw"))
        f = f.withColumn("_kind", kind)
        is_struct = F.col("_kind") == "struct"
        rows = f.select(
            "root", "kpath", "depth", F.array_append("opath", F.col("_ford")).alias("ord_path"),
            F.col("_jk").alias("json_key"),
            F.when(F.col("_kind") == "session", F.lit("string"))
            .when(F.col("_kind") == "scalar", F.col("_stype"))
            .when(F.col("_kind") == "primitive", raw_type(ft))
            .when(is_struct, F.col("_bt")).otherwise(ft).alias("go_type"),
            F.when(F.col("_kind") == "session", F.lit(True)).otherwise(~F.col("_opt")).alias("required"),
            F.when(F.col("_kind") == "primitive", ft.startswith("[]"))
            .when(is_struct, ft.contains("[]")).alias("is_array"),
            F.when(F.col("_kind") == "session", F.lit(P.SESSION_ID_DESCRIPTION))
            .when(F.col("_kind") == "scalar", F.col("_sdesc")).alias("description"),
            # the call this field makes in the next round (struct-typed fields)
            F.when(is_struct, F.col("_bt")).alias("n_name"),
            F.array_append("visited", F.col("name")).alias("n_visited"),
            F.array_append("kpath", F.col("_jk")).alias("n_kpath"),
            F.array_append("opath", F.col("_ford")).alias("n_opath"))
        emb_calls = known.join(shuffled(emb), known["name"] == emb["_en"]).select(
            "root", F.lit(False).alias("_row"), F.col("_lookup").alias("n_name"),
            F.array_append("visited", F.col("name")).alias("n_visited"), F.col("kpath").alias("n_kpath"),
            F.array_append("opath", F.col("eord") + EMBED_ORD_BASE).alias("n_opath"), "depth")
        step = (ph.withColumn("_row", F.lit(True))
                .unionByName(unk.withColumn("_row", F.lit(True)))
                .unionByName(rows.withColumn("_row", F.lit(True)), allowMissingColumns=True)
                .unionByName(emb_calls, allowMissingColumns=True))
        # one write per round: the rows of this round and the calls of the next
        step = cut(step)
        out.append(step.where(F.col("_row")).select(*row_cols))
        calls = step.where(F.col("n_name").isNotNull()).select(
            "root", F.col("n_name").alias("name"), (F.col("depth") + 1).alias("depth"),
            F.col("n_visited").alias("visited"), F.col("n_kpath").alias("kpath"), F.col("n_opath").alias("opath"))
        if calls.isEmpty():
            break
    res = out[0]
    for o in out[1:]:
        res = res.unionByName(o)
    return res.select("root", F.array_append("kpath", F.col("json_key")).alias("path"), "depth",
                      "ord_path", "json_key", "go_type", "required", "is_array", "description")


# ------------------------------------------------------------------ E12-E18
def rule_schemas(spark: SparkSession, rule_records: DataFrame, entry_points: DataFrame,
                 registry: DataFrame, overrides=P.HANDLER_PARAM_OVERRIDES) -> DataFrame:
    """Per rule record its request and response struct.

    ``(rule_id, ord, entrypoint_id, enriched, handler, method, request_struct,
    request_found, response_struct, response_found, override)``.
    A record whose endpoint is unknown or has no handler passes through
    (``enriched`` false). Overrides win and may name no struct; an override to
    an unregistered struct still counts as a request struct (SURVEY Q10),
    ``request_found`` tells whether a schema exists. The endpoint map keeps the
    last definition of a repeated id.
    """
    ep = (entry_points.groupBy("ep_id")
          .agg(F.max_by(F.struct("method", "handler_symbol"), "ord").alias("_e"))
          .select(F.col("ep_id").alias("_ep"), F.col("_e.method").alias("method"),
                  F.col("_e.handler_symbol").alias("handler")))
    ov = (overrides if isinstance(overrides, DataFrame)
          else spark.createDataFrame(list(overrides), "_oh string, _os string"))
    ov = ov.toDF("_oh", "_os").withColumn("_ov", F.lit(True))
    # handler and structs are those of the endpoint: found once for each, then joined to its rules
    h = F.col("handler")
    enriched = F.coalesce(h != "", F.lit(False))
    cap = F.concat(F.upper(F.substring(h, 1, 1)), F.substring(h, 2, 1 << 30))
    names = registry.select("name")
    cands = {"p1": F.concat(h, F.lit("Param")), "p2": F.concat(cap, F.lit("Param")),
             "r1": F.concat(h, F.lit("Resp")), "r2": F.concat(cap, F.lit("Resp"))}
    for k, c in cands.items():
        n = names.select(F.col("name").alias(f"_{k}"))
        ep = ep.withColumn(f"_c{k}", c).join(shuffled(n), F.col(f"_c{k}") == F.col(f"_{k}"), "left")
    # no broadcast hint: an override table may grow with the code base; AQE
    # broadcasts it from its measured size when it is small
    ep = ep.join(shuffled(ov), h == F.col("_oh"), "left")
    req = F.when(F.col("_ov").isNotNull(), F.col("_os")).otherwise(F.coalesce("_p1", "_p2"))
    resp = F.coalesce("_r1", "_r2")
    reg_names = names.select(F.col("name").alias("_qn"))
    ep = (ep.withColumn("request_struct", F.when(enriched, req))
          .withColumn("response_struct", F.when(enriched, resp))
          .join(shuffled(reg_names), F.col("request_struct") == F.col("_qn"), "left")
          .select("_ep", enriched.alias("enriched"), "handler", "method", "request_struct",
                  F.col("_qn").isNotNull().alias("request_found"), "response_struct",
                  F.col("response_struct").isNotNull().alias("response_found"),
                  F.col("_ov").isNotNull().alias("override")))
    r = rule_records.join(shuffled(ep), rule_records["entrypoint_id"] == ep["_ep"], "left")

    def known(flag):
        return F.coalesce(flag, F.lit(False)).alias(flag)
    return r.select("rule_id", "ord", "entrypoint_id", known("enriched"), "handler", "method", "request_struct",
                    known("request_found"), "response_struct", known("response_found"), known("override"))


def attach_schemas(rs: DataFrame, schema_rows: DataFrame) -> DataFrame:
    """Schema rows per rule and side (``request`` / ``response``)."""
    sides = (rs.where(F.col("request_found")).select("rule_id", F.lit("request").alias("side"),
                                                     F.col("request_struct").alias("root"))
             .unionByName(rs.where(F.col("response_found")).select(
                 "rule_id", F.lit("response").alias("side"), F.col("response_struct").alias("root"))))
    return sides.join(shuffled(schema_rows), "root")


def schema_counters(rs: DataFrame) -> DataFrame:
    """Updated / no request struct / no response struct (DELETE endpoints
    and handlers mentioning ``export`` are not counted as missing a response)."""
    e = F.col("enriched")
    no_resp = e & ~F.col("response_found") & ~F.coalesce(F.col("method") == "DELETE", F.lit(False)) \
        & ~F.lower(F.coalesce(F.col("handler"), F.lit(""))).contains("export")
    has_req = F.col("request_struct").isNotNull()
    return rs.agg(F.count_if(e & has_req).cast("bigint").alias("updated"),
                  F.count_if(e & ~has_req).cast("bigint").alias("no_param"),
                  F.count_if(no_resp).cast("bigint").alias("no_resp"))
