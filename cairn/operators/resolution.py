"""Where one staged record goes: linked, created with or without a partner, reviewed, or left staged."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cairn.operators.classify import ACCESS_TYPES, merged_type
from cairn.operators.gate import combined_quality, first_outcome, safe_to_create

#: Confidence from which an unmatched record is worth a review (a fixed value).
WORTH_REVIEW = 0.78


def combine(a: Column, b: Column) -> Column:
    """One record (struct) made of two of different sources, or null where they do not agree.

    Both are structs with source, source_status, primary_type, consumer_facing,
    latitude, longitude, phone, website_url, classification_confidence,
    source_family, public_access and quality_flags.  The consumer-facing one
    leads; an open and a closed one, incompatible types, and pairs without a
    consumer or a point make no record.
    """
    statuses = F.array(a["source_status"], b["source_status"])
    has = lambda s: F.coalesce(F.array_contains(F.array_compact(statuses), s), F.lit(False))
    kind = merged_type(a["primary_type"], a["consumer_facing"], b["primary_type"], b["consumer_facing"])
    lead = F.when(a["consumer_facing"], a).when(b["consumer_facing"], b)
    placed = lambda r: r["latitude"].isNotNull() & r["longitude"].isNotNull()
    at = F.when(placed(lead), lead).when(placed(a), a).otherwise(b)
    sure = F.greatest(*(F.coalesce(r["classification_confidence"], F.lit(0.0)) for r in (a, b)))
    given = lambda c: F.nullif(c, F.lit(""))
    fits = ~(has("closed") & has("open")) & kind.isNotNull() & lead.isNotNull() & placed(at)
    return F.when(fits, F.struct(
        lead["source"].alias("source"), F.when(has("open"), "open").otherwise(lead["source_status"]).alias("source_status"), kind.alias("primary_type"),
        lead["consumer_facing"].alias("consumer_facing"), at["latitude"].alias("latitude"), at["longitude"].alias("longitude"),
        F.coalesce(given(lead["phone"]), given(at["phone"])).alias("phone"), F.coalesce(given(lead["website_url"]), given(at["website_url"])).alias("website_url"),
        sure.alias("classification_confidence"), lead["source_family"].alias("source_family"), lead["public_access"].alias("public_access"),
        lead["quality_flags"].alias("quality_flags")))


def _safe(r: Column, quality: Column) -> Column:
    return safe_to_create(r["source_family"], r["source_status"], r["latitude"], r["longitude"], r["primary_type"], r["consumer_facing"], r["public_access"],
                          r["quality_flags"], quality, ACCESS_TYPES)


def route_record(record: Column, action: Column, reason: Column, candidate: Column, other: Column, both: Column, identity: Column,
                 other_linked: Column) -> Column:
    """struct(state, reason): link, review, create or staged, by the first rule that holds.

    action, reason and candidate are the match decision's; other is the record
    of another source that corroborates this one (null: none), both what
    ``combine`` makes of the two, identity their score, other_linked whether the
    other is linked already.
    """
    sure = F.coalesce(record["classification_confidence"], F.lit(0.0))
    quality = combined_quality(record["classification_confidence"], other["classification_confidence"], F.coalesce(record["primary_type"] == other["primary_type"], F.lit(False)), identity)
    pair = other.isNotNull() & both.isNotNull() & _safe(both, quality)
    matched, unclear = (action == "auto_match") & candidate.isNotNull(), action == "review"
    decided = first_outcome([
        (matched, "link", "auto_match"), (unclear, "review", "ambiguous_match"), (other.isNotNull() & both.isNull(), "review", "source_conflict"),
        (pair & other_linked, "link", "linked_source_corroboration"), (pair, "create", "cross_source_corroboration"),
        (_safe(record, sure), "create", "high_confidence_new"), (sure >= WORTH_REVIEW, "review", "needs_type_or_location_corroboration"),
    ], ("staged", ""))
    own = F.coalesce(matched | unclear, F.lit(False)) & reason.isNotNull()
    return F.struct(decided["state"].alias("state"), F.when(own, reason).otherwise(F.nullif(decided["reason"], F.lit(""))).alias("reason"))
