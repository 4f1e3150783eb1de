"""Spec enrichment: evidence references resolved to rule-record schemas,
SURVEY F1-F7.

Evidence references keep their position (``ref_ord``); "the first hit" is
``min_by(..., ref_ord)`` after a join, never a scan that stops early.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codefacts.session import shuffled
from codefacts.sources.documents import list_items, value_at

# ----------------------------------------------------------------------------
# Reference patterns (matched at the start of the text only)
# ----------------------------------------------------------------------------
RX_RULE_REF = r"^EP-\d+-R-\d+"
RX_EP_PREFIX = r"^(EP-\d+)"


def spec_features(docs: DataFrame) -> DataFrame:
    """``(source_file, domain, ord, fr_id, feature)`` of the structured spec
    documents ``(source_file, document)``; ``ord`` is the pair of positions of
    domain and feature."""
    domains = list_items(docs.select("source_file", "document"), "document", "$.structured_spec.domains", "d", "entry")
    features = list_items(domains.select("source_file", "d", "entry"), "entry", "$.features", "f", "feature")
    return features.select("source_file", value_at("entry", "$.name").alias("domain"), F.struct("d", "f").alias("ord"),
                           value_at("feature", "$.fr_id").alias("fr_id"), "feature")


def spec_evidence(features: DataFrame) -> DataFrame:
    """``(fr_id, ref_ord, ref)`` of the features' references in list order;
    entries that are no text are left out, positions count them."""
    refs = list_items(features.select("fr_id", "feature"), "feature", "$.evidence_refs", "ref_ord", "entry")
    return refs.select("fr_id", "ref_ord", value_at("entry", "$").alias("ref")).where("ref is not null")


def spec_cross_cutting(docs: DataFrame) -> DataFrame:
    """``(source_file, ord, xc_id)`` of the cross-cutting items."""
    items = list_items(docs.select("source_file", "document"), "document", "$.structured_spec.cross_cutting")
    return items.select("source_file", "ord", value_at("item", "$.xc_id").alias("xc_id"))


def rule_lookup(rule_schemas: DataFrame) -> DataFrame:
    """rule id -> record; a repeated id keeps its last record."""
    return (rule_schemas.groupBy("rule_id")
            .agg(F.max_by(F.struct("ord", "request_struct", "request_found", "response_struct",
                                   "response_found", "enriched"), "ord").alias("r"))
            .select("rule_id", "r.*"))


def first_rule_per_endpoint(rule_schemas: DataFrame) -> DataFrame:
    """per endpoint, its first rule record in input order."""
    return (rule_schemas.groupBy("entrypoint_id")
            .agg(F.min_by(F.struct("rule_id", "ord", "request_struct", "request_found", "response_struct",
                                   "response_found", "enriched"), "ord").alias("r"))
            .select("entrypoint_id", "r.*"))


def resolve_features(features: DataFrame, evidence: DataFrame, rule_schemas: DataFrame) -> DataFrame:
    """Per feature the matched rule and its schema roots.

    Tier 1: the first reference that looks like a rule id and exists. Tier 2
    (only when tier 1 found nothing): the first reference whose ``EP-n``
    prefix has rule records; that endpoint's first record. A tier-1 hit whose
    record has no schema ends the search with NULL schemas (SURVEY Q9): the
    tiers are combined on the hit, not on the schema. Output
    ``(domain, ord, fr_id, tier, rule_id, request_struct, response_struct)``
    with the struct names only when a schema exists.
    """
    rl = rule_lookup(rule_schemas)
    fr = first_rule_per_endpoint(rule_schemas)
    ev = evidence.select("fr_id", "ref_ord", "ref")
    t1 = (ev.where(F.col("ref").rlike(RX_RULE_REF))
          .join(shuffled(rl), ev["ref"] == rl["rule_id"])
          .groupBy("fr_id").agg(F.min_by(F.struct("rule_id", "request_struct", "request_found",
                                                  "response_struct", "response_found", "enriched"),
                                         "ref_ord").alias("t1")))
    t2 = (ev.withColumn("_ep", F.regexp_extract("ref", RX_EP_PREFIX, 1)).where(F.col("_ep") != "")
          .join(shuffled(fr), F.col("_ep") == fr["entrypoint_id"])
          .groupBy("fr_id").agg(F.min_by(F.struct("rule_id", "request_struct", "request_found",
                                                  "response_struct", "response_found", "enriched"),
                                         "ref_ord").alias("t2")))
    f = features.join(shuffled(t1), "fr_id", "left").join(shuffled(t2), "fr_id", "left")
    hit = F.when(F.col("t1").isNotNull(), F.col("t1")).otherwise(F.col("t2"))
    tier = F.when(F.col("t1").isNotNull(), 1).when(F.col("t2").isNotNull(), 2)
    return f.select("domain", "ord", "fr_id", tier.alias("tier"), hit["rule_id"].alias("rule_id"),
                    F.when(hit["enriched"] & hit["request_found"], hit["request_struct"]).alias("request_struct"),
                    F.when(hit["enriched"] & hit["response_found"], hit["response_struct"]).alias("response_struct"))


def cross_cutting(items: DataFrame) -> DataFrame:
    """cross-cutting items carry NULL schemas."""
    return items.select("*", F.lit(None).cast("string").alias("request_struct"),
                        F.lit(None).cast("string").alias("response_struct"))


def coverage(resolved: DataFrame) -> DataFrame:
    """requirements with a request schema over all requirements."""
    return resolved.agg(F.count_if(F.col("request_struct").isNotNull()).cast("bigint").alias("enriched"),
                        F.count("*").cast("bigint").alias("total"))
