"""Nested audit export: each current candidate with its anchor, licences, sources and open reviews, as one row.

Every list is aggregated by candidate on its own and the lists meet by
candidate afterwards, so licences and reviews never multiply each other; all
sides are dealt by the candidate once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.functions.values import json_is_empty
from cairn.operators.gate import HARD_NEGATIVE_FLAGS, has_flag
from cairn.operators.review import BLOCKING_SUFFIXES

LICENCES = "ca_abc"
#: Flags, besides those that close a place, of records that block nothing (fixed values).
UNSURE_FLAGS = ("consumer_identity_conflict", "stale")
_JSON = {"ignoreNullFields": "false"}


def field_coverage(phone: Column, website: Column, hours: Column, price: Column, settings: Column) -> Column:
    """struct of booleans: which optional fields of a snapshot have a value; hours are JSON, settings an array."""
    given = lambda c: F.coalesce(F.trim(c), F.lit("")) != ""
    return F.struct(given(phone).alias("phone"), given(website).alias("website"), (~json_is_empty(hours)).alias("hours"), price.isNotNull().alias("price"),
                    (F.coalesce(F.size(settings), F.lit(0)) > 0).alias("settings"))


def audit_export(candidates: DataFrame, records: DataFrame, links: DataFrame, reviews: DataFrame, version: str, as_of: Column) -> DataFrame:
    """One row per verified or published candidate of the version whose lease has not ended, lists as JSON.

    candidates: ``candidate_id``, ``candidate_state``, ``decision_version``, ``verification_expires_at``, ``anchor_source``,
    ``anchor_record_id``, ``normalized_address`` and the snapshot's ``phone_e164``, ``website_url``, ``hours``, ``price_level``, ``setting_slugs``;
    records: ``source``, ``record_id`` (together unique), ``name``, ``normalized_address``, ``license_type``, ``type_status``, ``status``, ``retired_at``, ``flags``,
    ``classification_confidence``; links: ``candidate_id``, ``source``, ``record_id``, ``identity_confidence``; reviews: ``candidate_id``, ``review_id``, ``source``,
    ``record_id``, ``state``, ``reason``, ``score``.  Candidates without an anchor record have no row, those without licences or
    reviews empty lists.
    """
    current = candidates.where(F.col("candidate_state").isin("verified", "published") & (F.col("decision_version") == version) & (F.col("verification_expires_at") > as_of))
    anchor = records.select(F.col("source").alias("anchor_source"), F.col("record_id").alias("anchor_record_id"), F.col("name").alias("anchor_name"), "classification_confidence")
    licences = links.where(F.col("source") == LICENCES).join(records, ["source", "record_id"]).groupBy("candidate_id").agg(
        F.sort_array(F.collect_list(F.struct("record_id", "name", "license_type", "type_status", "identity_confidence"))).alias("licences"))
    sources = links.groupBy("candidate_id").agg(F.sort_array(F.collect_set("source")).alias("linked_sources"))
    pending = reviews.where("state = 'pending'").join(records.select(
        "source", "record_id", "name", F.col("normalized_address").alias("_address"), "status", "retired_at", "flags"), ["source", "record_id"], "left")
    own = current.select("candidate_id", "normalized_address")
    known = F.col("status").isNotNull()
    blocks = (known & F.col("retired_at").isNull() & (F.col("status") == "open") & ~has_flag(F.col("flags"), (*HARD_NEGATIVE_FLAGS, *UNSURE_FLAGS))
              & (F.col("_address") == F.col("normalized_address")) & (F.col("reason").endswith(BLOCKING_SUFFIXES[0]) | F.col("reason").endswith(BLOCKING_SUFFIXES[1])))
    ordered = F.struct((-F.col("score")).alias("o"), F.col("source").alias("s"), F.col("review_id").alias("i"),
                       F.struct("review_id", "source", "name", "reason", "score").alias("r"))
    opened = pending.join(own, "candidate_id").groupBy("candidate_id").agg(
        F.count("*").alias("pending_review_items"), F.transform(F.sort_array(F.collect_list(F.when(known, ordered))), lambda x: x["r"]).alias("reviews"),
        F.count_if(blocks).alias("blocking_exact_address_conflicts"))
    joined = current.join(anchor, ["anchor_source", "anchor_record_id"]).join(licences, "candidate_id", "left").join(sources, "candidate_id", "left").join(opened, "candidate_id", "left")
    listed = lambda c: F.coalesce(F.to_json(c, _JSON), F.lit("[]")).alias(c)
    none = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    coverage = field_coverage(*(F.col(c) for c in ("phone_e164", "website_url", "hours", "price_level", "setting_slugs")))
    return joined.select("candidate_id", "anchor_name", "classification_confidence", F.to_json(coverage, _JSON).alias("optional_field_coverage"), listed("licences"),
                         listed("linked_sources"), none("pending_review_items"), listed("reviews"), none("blocking_exact_address_conflicts"))
