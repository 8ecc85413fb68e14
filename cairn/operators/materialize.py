"""Published projections: overlays, provider links, withdrawal, publishing and anchors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.operators.resolve import MINIMUM_SCORES, corroborated

#: Confidence of a projected value that carries none.
DEFAULT_CONFIDENCE = 0.95


def default_confidence(value: Column, stored: Column) -> Column:
    return F.when(value.isNotNull(), F.coalesce(stored, F.lit(DEFAULT_CONFIDENCE)))


def minimum_score(field: Column) -> Column:
    """The least score of a field's selection."""
    pairs = [F.lit(x) for kv in MINIMUM_SCORES.items() for x in kv]
    return F.coalesce(F.element_at(F.create_map(*(p.cast("string") if i % 2 == 0 else p.cast("double") for i, p in enumerate(pairs))), field), F.lit(0.68))


def overlay_candidates(snapshot: DataFrame, decisions: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Snapshots with the selected field values; a field with evidence but no selection becomes null.

    decisions: key, field, selected_value, status, source, origin_count; one row per key and field.
    Uncorroborated contacts count as insufficient.
    """
    ok = (F.col("status") == "selected") & corroborated(F.col("field"), F.col("source"), F.col("origin_count"))
    judged = decisions.select(key, "field", F.when(ok, F.col("selected_value")).alias("v"),
                              F.when(ok, "selected").when(F.col("status") == "conflicted", "conflicted").otherwise("insufficient").alias("s"))
    wide = judged.groupBy(key).pivot("field", fields).agg(F.first("v").alias("v"), F.first("s").alias("s"))
    joined = snapshot.join(wide, key, "left")
    cols = [F.when(F.col(f"{f}_s").isNotNull(), F.col(f"{f}_v")).otherwise(F.col(f)).alias(f) for f in fields]
    status = [F.col(f"{f}_s").alias(f"{f}_status") for f in fields]
    return joined.select(*(c for c in snapshot.columns if c not in fields), *cols, *status)


def projection_overlay(owned: Column, current: Column, resolved: Column) -> Column:
    """Fields that the resolver owns keep its value, null included."""
    return F.when(owned, current).otherwise(resolved)


def provider_links(current: DataFrame, eligible: DataFrame, keys: list[str]) -> DataFrame:
    """New state of links: the best eligible row of each key, first matched and last validated times, retired without one."""
    best = eligible.groupBy(*keys).agg(F.max(F.struct("confidence", "provider_id")).alias("_b"), F.min("matched_at").alias("_m"), F.max("validated_at").alias("_v"))
    joined = current.join(best, keys, "full_outer")
    return joined.select(*keys, F.coalesce("_b.provider_id", "provider_id").alias("provider_id"), F.least("matched_at", "_m").alias("matched_at"),
                         F.greatest("validated_at", "_v").alias("validated_at"), F.col("_b").isNull().alias("retired"))


def withdraw_expired(entities: DataFrame, as_of: Column) -> DataFrame:
    """Published rows whose lease is missing or over become suppressed and their candidates need verification."""
    over = (F.col("publication_state") == "published") & (F.col("verification_expires_at").isNull() | (F.col("verification_expires_at") <= as_of))
    return entities.withColumn("candidate_state", F.when(over, "needs_verification").otherwise(F.col("candidate_state"))).withColumn(
        "publication_state", F.when(over, "suppressed").otherwise(F.col("publication_state")))


def publish(candidates: DataFrame, cap: int, used: int, armed: bool) -> DataFrame:
    """Candidates to publish now: verified, in order of verification and id, as many as slots are free; none if not armed."""
    free = max(0, cap - used) if armed else 0
    return candidates.where("candidate_state = 'verified'").orderBy("verified_at", "id").limit(free)


def promote_anchor(current_source: Column, offered_source: Column) -> Column:
    """Whether an offered anchor replaces the current one: only the preferred source does, and only another's."""
    return (offered_source == "fsq") & (current_source != "fsq")


def corroborated_website(observations: DataFrame, agreed: DataFrame, entity: str, host: str, url: str) -> DataFrame:
    """The smallest full URL of each entity's agreed host."""
    return observations.join(agreed.select(entity, F.col("value").alias(host)), [entity, host]).groupBy(entity).agg(F.min(url).alias(url))


def field_coverage(entities: DataFrame, fields: list[str]) -> DataFrame:
    """One row: how many entities have a value in each field."""
    return entities.agg(F.count("*").alias("entities"), *(F.count_if(F.col(f).isNotNull() & (F.trim(F.col(f).cast("string")) != "")).alias(f) for f in fields))
