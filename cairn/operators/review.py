"""Reviews: link revalidation, review queues, resolutions, contributions and manual observations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.functions.values import digest
from cairn.operators.latest import latest_per_key

LINK_THRESHOLD, REVIEWED_SCORE = 0.96, 0.99
NOTE_LENGTH, REVIEWER_LENGTH = 2000, (3, 200)
MANUAL_LEASE_DAYS, CONTRIBUTION_DAYS, MERCHANT_DAYS = 90, 90, 180
BLOCKING_SUFFIXES = ("same_location_name_conflict", "probable_identity_needs_review")


def revalidate(links: DataFrame, accepted: DataFrame, keys: list[str]) -> DataFrame:
    """Links with their ``outcome``: keep (score .96 or more), reviewed (same evidence accepted: .99), else review.

    links: keys, action, score, evidence_hash; accepted: keys, evidence_hash of accepted reviews.
    """
    a = accepted.select(*keys, "evidence_hash", F.lit(True).alias("_ok")).distinct()
    joined = links.join(a, [*keys, "evidence_hash"], "left")
    keep = (F.col("action") == "match") & (F.col("score") >= LINK_THRESHOLD)
    return joined.select(*keys, "evidence_hash", F.when(keep, "keep").when(F.col("_ok"), "reviewed").otherwise("review").alias("outcome"),
                         F.when(keep, F.col("score")).when(F.col("_ok"), F.lit(REVIEWED_SCORE)).alias("identity_confidence"))


def review_reason(types_compatible: Column, reason: Column) -> Column:
    return F.when(~types_compatible, F.concat(F.lit("type_conflict:"), reason)).otherwise(reason)


def evidence_snapshot(**facts: Column) -> Column:
    """Normalized facts of both sides as one struct, for a review's evidence and hash."""
    return F.struct(*(facts[k].alias(k) for k in sorted(facts)))


def enqueue(found: DataFrame, reviews: DataFrame, keys: list[str]) -> DataFrame:
    """Reviews to open: those whose very evidence has not been resolved; one for each key (the last reason wins)."""
    done = reviews.where("state <> 'pending'").select(*keys, "evidence_hash")
    fresh = found.join(done, [*keys, "evidence_hash"], "left_anti")
    return latest_per_key(fresh, keys, ["score", "reason"], ["evidence_hash"])


def resolve(reviews: DataFrame, resolutions: DataFrame, keys: list[str]) -> DataFrame:
    """State of reviews after resolutions; one on other evidence, on a settled review or without a proper note is ignored."""
    r = resolutions.where(F.col("resolution").isin("same_place", "not_same_or_stale") & (F.length("note") <= NOTE_LENGTH)
                          & F.length(F.trim("reviewer")).between(*REVIEWER_LENGTH)).select(*keys, "evidence_hash", "resolution", "reviewer")
    joined = reviews.join(r, [*keys, "evidence_hash"], "left")
    applies = (F.col("state") == "pending") & F.col("resolution").isNotNull()
    return joined.select(*keys, "evidence_hash", F.when(applies, "resolved").otherwise(F.col("state")).alias("state"),
                         F.when(applies, F.col("resolution")).alias("resolution"), F.when(applies, F.col("reviewer")).alias("reviewer"))


def blocking(candidates: DataFrame, reviews: DataFrame, key: str) -> DataFrame:
    """Candidates that a pending review of an exact address holds back."""
    ends = F.col("reason").endswith(BLOCKING_SUFFIXES[0]) | F.col("reason").endswith(BLOCKING_SUFFIXES[1])
    return candidates.join(reviews.where((F.col("state") == "pending") & F.col("exact_address") & ends), key, "left_semi")


def covered_by_review(current: Column, reviewed: Column) -> Column:
    """Whether a manual review has seen all current evidence (of which there is some)."""
    return F.coalesce((F.size(current) > 0) & (F.size(F.array_except(current, reviewed)) == 0), F.lit(False))


def manual_observations(ledger: DataFrame, observed: DataFrame, as_of: Column, policy_days: int) -> DataFrame:
    """New manual observations with their expiry; a key seen before with the same value is a replay and adds nothing.

    observed: idempotency_key, entity, field_name, value_text, lease_days.  A key seen with another value is returned with ``conflict``.
    """
    rows = observed.withColumn("value_hash", digest(F.col("entity"), F.col("field_name"), F.col("value_text")))
    old = ledger.select("idempotency_key", F.col("value_hash").alias("_h"))
    days = F.least(F.col("lease_days"), F.lit(min(policy_days, MANUAL_LEASE_DAYS)))
    joined = rows.join(old, "idempotency_key", "left").where(~F.col("_h").eqNullSafe(F.col("value_hash")))
    return joined.withColumn("conflict", F.col("_h").isNotNull()).withColumn("expires_at", as_of + F.make_dt_interval(days)).drop("_h")


def contributions(rows: DataFrame, terms: DataFrame, claims: DataFrame, as_of: Column) -> DataFrame:
    """Contributions that may be reviewed: under active terms and, for merchants, with a verified claim; with their expiry."""
    active = terms.where((F.col("state") == "active") & (F.col("effective_from") <= as_of)).select(F.col("version").alias("terms_version"))
    verified = claims.where("state = 'verified'").select("user_id", "entity")
    ok = rows.join(active, "terms_version", "left_semi")
    merchants = ok.where("kind = 'merchant'").join(verified, ["user_id", "entity"], "left_semi")
    days = F.when(F.col("kind") == "merchant", MERCHANT_DAYS).otherwise(CONTRIBUTION_DAYS)
    return ok.where("kind <> 'merchant'").unionByName(merchants).withColumn("expires_at", as_of + F.make_dt_interval(days))


def valid_transition(old: Column, new: Column, audited: Column) -> Column:
    """Whether a review's state may change so: pending to resolved with an audit row; settled rows never."""
    return (old == "pending") & (new == "pending") | (old == "pending") & (new == "resolved") & audited
