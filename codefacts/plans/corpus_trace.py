"""Generated trace inputs: entry points, rule records, spec features and
evidence, derived from the given tables (SURVEY §4 rows "entry points, rules"
and "spec and evidence").

* ``entry_points`` - one per part k: ``EP-<k>``; method GET/POST/PUT by the
  API verb of ``get<k>`` (DELETE when k % 8 = 6); route ``METHOD url``,
  the bare url when k % 5 = 0, or ``GET url/all`` when k % 5 = 1 (found only
  by containment); handler ``get<k>`` (``export<k>`` when k % 10 = 8, none
  when k % 10 = 9).
* ``rule_records`` - one per distinct ``(l_orderkey, l_linenumber)``, for its
  least part p: ``EP-<p>-R-<o*8+ln>`` on endpoint ``EP-<p>`` (an unknown
  ``EP-X<p>`` when ln = 7); ``ord = o*8+ln``.
* ``spec_features`` - one per customer: ``FR-<c>`` in domain ``c_mktsegment``.
* ``spec_evidence`` - one reference per order, from the rule of its least
  line number: the rule id when o % 7 = 0, ``EP-<p>`` when o % 7 in (1, 2),
  a rule-like id that does not exist when o % 7 = 3, else ``DG-<o>``.
* ``spec_files`` - one JSON document per 16 customers: their domains, features
  and references; no list of references when c % 9 = 0, null when c % 11 = 0,
  an entry that is no text in front when c % 5 = 0; no cross-cutting items when
  the file's number % 4 = 1; cut off in the middle when it is % 4 = 3.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codefacts.session import shuffled
from codefacts.sources.tables import table


def api_url(k, ptype):
    """URL of ``get<k>`` in the generated API client."""
    ks = k.cast("string")
    return (F.when(k % 4 == 3, F.concat(F.lit(":param/api/v1/file/:param/"), ks))
            .otherwise(F.concat(F.lit("/api/v1/"), F.lower(ptype), F.lit("/"), ks)))


def api_verb(k):
    return F.when(k % 4 == 1, "POST").when(k % 4 == 2, "PUT").otherwise("GET")


def entry_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    k = F.col("p_partkey")
    url = api_url(k, F.col("p_type"))
    method = F.when(k % 8 == 6, "DELETE").otherwise(api_verb(k))
    route = (F.when(k % 5 == 0, url)
             .when(k % 5 == 1, F.concat(F.lit("GET "), url, F.lit("/all")))
             .otherwise(F.concat(method, F.lit(" "), url)))
    handler = (F.when(k % 10 == 9, F.lit(""))
               .when(k % 10 == 8, F.concat(F.lit("export"), k.cast("string")))
               .otherwise(F.concat(F.lit("get"), k.cast("string"))))
    return p.select(k.cast("int").alias("ord"), F.concat(F.lit("EP-"), k.cast("string")).alias("ep_id"),
                    method.alias("method"), route.alias("route"), handler.alias("handler_symbol"))


def rule_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    r = li.groupBy("l_orderkey", "l_linenumber").agg(F.min("l_partkey").alias("p"))
    o, ln, p = F.col("l_orderkey"), F.col("l_linenumber"), F.col("p")
    ordv = o * 8 + ln
    return r.select(ordv.alias("ord"),
                    F.concat(F.lit("EP-"), p.cast("string"), F.lit("-R-"), ordv.cast("string")).alias("rule_id"),
                    F.when(ln == 7, F.concat(F.lit("EP-X"), p.cast("string")))
                    .otherwise(F.concat(F.lit("EP-"), p.cast("string"))).alias("entrypoint_id"),
                    o.alias("orderkey"), ln.alias("linenumber"), p.alias("partkey"))


def spec_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return c.select(F.col("c_mktsegment").alias("domain"), F.col("c_custkey").alias("ord"),
                    F.concat(F.lit("FR-"), F.col("c_custkey").cast("string")).alias("fr_id"))


def spec_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    rr = rule_records(spark, sf_dir)
    first = (rr.groupBy("orderkey").agg(F.min_by(F.struct("rule_id", "partkey"), "linenumber").alias("r")))
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    j = o.join(shuffled(first), o["o_orderkey"] == first["orderkey"])
    ok = F.col("o_orderkey")
    ps = F.col("r.partkey").cast("string")
    ref = (F.when(ok % 7 == 0, F.col("r.rule_id"))
           .when(ok % 7 <= 2, F.concat(F.lit("EP-"), ps))
           .when(ok % 7 == 3, F.concat(F.lit("EP-"), ps, F.lit("-R-0")))
           .otherwise(F.concat(F.lit("DG-"), ok.cast("string"))))
    return j.select(F.concat(F.lit("FR-"), F.col("o_custkey").cast("string")).alias("fr_id"),
                    ok.alias("ref_ord"), ref.alias("ref"))


def spec_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(file_path, document)``."""
    refs = spec_evidence(spark, sf_dir).groupBy("fr_id").agg(
        F.array_sort(F.collect_list(F.struct("ref_ord", "ref")))["ref"].alias("refs"))
    f = spec_features(spark, sf_dir).join(shuffled(refs), "fr_id", "left")
    c = F.col("ord")
    texts = F.transform(F.coalesce("refs", F.array().cast("array<string>")), lambda r: F.concat(F.lit('"'), r, F.lit('"')))
    listed = F.concat(F.lit(',"evidence_refs":['), F.array_join(F.when(c % 5 == 0, F.concat(
        F.array(F.lit('{"no":["text"]}')), texts)).otherwise(texts), ","), F.lit("]"))
    listed = F.when(c % 9 == 0, "").when(c % 11 == 0, ',"evidence_refs":null').otherwise(listed)
    f = f.select(F.floor(c / 16).alias("n"), "domain", "ord",
                 F.concat(F.lit('{"fr_id":"'), "fr_id", F.lit('"'), listed, F.lit("}")).alias("text"))
    d = f.groupBy("n", "domain").agg(F.array_sort(F.collect_list(F.struct("ord", "text")))["text"].alias("features"))
    d = d.select("n", "domain", F.concat(F.lit('{"name":"'), "domain", F.lit('","features":['),
                                         F.array_join("features", ","), F.lit("]}")).alias("text"))
    g = d.groupBy("n").agg(F.array_sort(F.collect_list(F.struct("domain", "text")))["text"].alias("domains"))
    n = F.col("n").cast("string")
    crossing = F.when(F.col("n") % 4 == 1, "").otherwise(F.concat(F.lit(',"cross_cutting":[{"xc_id":"XC-'), n, F.lit('"}]')))
    text = F.concat(F.lit('{"structured_spec":{"domains":['), F.array_join("domains", ","), F.lit("]"), crossing, F.lit("}}"))
    text = F.when(F.col("n") % 4 == 3, text.substr(F.lit(1), F.floor(F.length(text) / 2).cast("int"))).otherwise(text)
    return g.select(F.concat(F.lit("spec/c"), n).alias("file_path"), text.alias("document"))


def param_overrides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Handler overrides for parts of size 1: ``get<k>`` -> ``Get<k>Resp`` when
    k is even, else "no request struct"."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_size").where(F.col("p_size") == 1)
    k = F.col("p_partkey").cast("string")
    return p.select(F.concat(F.lit("get"), k).alias("handler"),
                    F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit("Get"), k, F.lit("Resp"))).alias("struct"))


ORACLE_CTE = """
p AS (SELECT p_partkey AS k, p_size AS z, p_type,
             CASE p_partkey % 3 WHEN 0 THEN 'get' || p_partkey || 'Param'
                                WHEN 1 THEN 'Get' || p_partkey || 'Param' END AS pname
      FROM part),
reg AS (SELECT pname AS name FROM p WHERE pname IS NOT NULL
        UNION ALL SELECT 'Get' || k || 'Resp' FROM p WHERE k % 2 = 0
        UNION ALL SELECT 'Base' FROM p WHERE k = 0),
ep AS (SELECT k AS ord, 'EP-' || k AS ep_id,
              CASE WHEN k % 8 = 6 THEN 'DELETE' WHEN k % 4 = 1 THEN 'POST' WHEN k % 4 = 2 THEN 'PUT'
                   ELSE 'GET' END AS method,
              CASE WHEN k % 10 = 9 THEN '' WHEN k % 10 = 8 THEN 'export' || k ELSE 'get' || k END AS handler
       FROM p),
ov AS (SELECT 'get' || k AS handler, CASE WHEN k % 2 = 0 THEN 'Get' || k || 'Resp' END AS struct
       FROM p WHERE z = 1),
rr AS (SELECT l_orderkey * 8 + l_linenumber AS ord,
              'EP-' || min(l_partkey) || '-R-' || (l_orderkey * 8 + l_linenumber) AS rule_id,
              CASE WHEN l_linenumber = 7 THEN 'EP-X' ELSE 'EP-' END || min(l_partkey) AS entrypoint_id,
              l_orderkey AS o, l_linenumber AS ln, min(l_partkey) AS pk
       FROM lineitem GROUP BY l_orderkey, l_linenumber),
rs AS (SELECT rr.rule_id, rr.ord, rr.entrypoint_id, ep.method, ep.handler,
              ep.ep_id IS NOT NULL AND ep.handler <> '' AS enriched,
              CASE WHEN ov.handler IS NOT NULL THEN ov.struct
                   WHEN ep.handler || 'Param' IN (SELECT name FROM reg) THEN ep.handler || 'Param'
                   WHEN upper(substr(ep.handler, 1, 1)) || substr(ep.handler, 2) || 'Param' IN (SELECT name FROM reg)
                   THEN upper(substr(ep.handler, 1, 1)) || substr(ep.handler, 2) || 'Param' END AS req,
              CASE WHEN ep.handler || 'Resp' IN (SELECT name FROM reg) THEN ep.handler || 'Resp'
                   WHEN upper(substr(ep.handler, 1, 1)) || substr(ep.handler, 2) || 'Resp' IN (SELECT name FROM reg)
                   THEN upper(substr(ep.handler, 1, 1)) || substr(ep.handler, 2) || 'Resp' END AS resp
       FROM rr LEFT JOIN ep ON rr.entrypoint_id = ep.ep_id LEFT JOIN ov ON ov.handler = ep.handler)
"""
