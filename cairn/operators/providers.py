"""Provider matching, live places, due scans, leases and cooldowns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.functions.text import is_e164, names_compatible, normalize_phone, safe_url
from cairn.operators.gate import HARD_NEGATIVE_FLAGS, has_flag
from cairn.operators.reports import match_outcome

# Reasons by priority, cooldowns by error code, the bounds of an interval.
REJECTION_PRIORITY = ["ambiguous", "name_mismatch", "location_mismatch", "type_mismatch", "closed", "invalid_identity", "missing_coordinates", "invalid_candidate"]
COOLDOWN_SECONDS = {"unauthorized": 3600, "forbidden": 3600, "invalid_request": 86400, "rate_limited": 900, "invalid_payload": 1800}
OTHER_COOLDOWN_SECONDS = 300
INTERVAL_SECONDS = (60, 90 * 86400)


def _first(cases: list[tuple[Column, str]], otherwise: str | None) -> Column:
    return reduce(lambda c, r: c.when(F.coalesce(r[0], F.lit(False)), r[1]), cases, F).otherwise(F.lit(otherwise).cast("string"))


def candidate_rejection(provider_id: Column, closed: Column, meters: Column, expected_name: Column, name: Column, name_score: Column,
                        address_score: Column, same_phone: Column, category: Column) -> Column:
    """Why a provider's candidate is no match, else null; meters is null without coordinates."""
    by_name = ((name_score >= 0.90) & (meters <= 75)) | (names_compatible(expected_name, name) & ((address_score >= 0.86) | same_phone))
    return _first([
        (~F.coalesce(provider_id.rlike("^[A-Za-z0-9_-]{6,64}$"), F.lit(False)), "invalid_identity"), (closed, "closed"),
        (meters.isNull(), "missing_coordinates"), (meters > 100, "location_mismatch"),
        (~F.coalesce(by_name, F.lit(False)), "name_mismatch"), (~F.coalesce(category, F.lit(False)), "type_mismatch")], None)


def candidate_confidence(meters: Column, name_score: Column, address_score: Column, same_phone: Column) -> Column:
    return (F.when(same_phone, 0.995).when((address_score >= 0.96) & (meters <= 50), 0.99)
            .when((name_score >= 0.90) & (meters <= 50), 0.98).otherwise(0.97))


def select_matches(candidates: DataFrame, entity: str, rejection: str, provider_id: str, confidence: str) -> DataFrame:
    """One outcome per entity: matched (with its one valid candidate), ambiguous, or the dominant rejection."""
    valid = F.col(rejection).isNull()
    # at most one row per rejection reason is gathered
    grouped = candidates.groupBy(entity).agg(
        F.count_if(valid).alias("_valid"), F.collect_set(rejection).alias("_reasons"),
        F.max(F.when(valid, F.struct(provider_id, confidence))).alias("_one"))
    matched = F.col("_valid") == 1
    return grouped.select(entity, match_outcome(F.col("_valid"), F.col("_reasons"), REJECTION_PRIORITY).alias("outcome"),
                          F.when(matched, F.col(f"_one.{provider_id}")).alias(provider_id), F.when(matched, F.col(f"_one.{confidence}")).alias(confidence))


def place_rejection(returned_id: Column, expected_id: Column, veracity: Column, date_closed: Column, flags: Column, meters: Column,
                    expected_name: Column, name: Column, category: Column) -> Column:
    """Why a live place is not used, else null; names must share three quarters of the smaller."""
    return _first([
        (~returned_id.eqNullSafe(expected_id), "identity_mismatch"), (veracity.isNull() | (veracity < 4), "low_veracity"),
        (F.coalesce(date_closed, F.lit("")) != "", "closed"), (has_flag(flags, HARD_NEGATIVE_FLAGS), "provider_warning"),
        (meters.isNull(), "missing_coordinates"), (meters > 100, "location_mismatch"),
        (~F.coalesce(names_compatible(expected_name, name, 0.75), F.lit(False)), "name_mismatch"),
        (~F.coalesce(category, F.lit(False)), "type_mismatch")], None)


def live_projection(requested: dict[str, Column], tel: Column, website: Column, price: Column, settings: Column) -> list[Column]:
    """Only the requested fields, in their types; price must be a whole number 1 to 4."""
    level = price.try_cast("double")
    none = F.array().cast("array<string>")
    return [F.when(requested["phone"] & is_e164(normalize_phone(tel)), normalize_phone(tel)).alias("phone_e164"),
            F.when(requested["website"] & safe_url(website), website).alias("website_url"),
            F.when(requested["price"] & level.between(1, 4) & (level == F.floor(level)), level.cast("int")).alias("price_level"),
            F.when(requested["settings"], F.coalesce(settings, none)).otherwise(none).alias("setting_slugs")]


def missing_fields(requested: dict[str, Column], values: dict[str, Column]) -> list[Column]:
    """For each requested field whether it is still without a value."""
    return [(requested[f] & values[f].isNull()).alias(f) for f in requested]


def cooldown_seconds(code: Column) -> Column:
    return reduce(lambda c, kv: c.when(code == kv[0], kv[1]), COOLDOWN_SECONDS.items(), F).otherwise(OTHER_COOLDOWN_SECONDS)


def clamp_interval(seconds: Column) -> Column:
    return F.greatest(F.lit(INTERVAL_SECONDS[0]), F.least(F.lit(INTERVAL_SECONDS[1]), seconds))


def due_order() -> list[Column]:
    """Unlinked first, then never tried, then those without a retry time, then the earliest."""
    return [F.when(F.col("provider_id").isNull(), 0).otherwise(1), F.col("attempted_at").asc_nulls_first(), F.col("retry_after").asc_nulls_first(), F.col("id").asc()]


def due(links: DataFrame, as_of: Column, limit: int) -> DataFrame:
    """The first links to look at: no lease in force and no cooldown (a bounded top-k)."""
    free = (F.col("lease_until").isNull() | (F.col("lease_until") <= as_of)) & (F.col("retry_after").isNull() | (F.col("retry_after") <= as_of))
    return links.where(free).orderBy(*due_order()).limit(limit)


def after_sync(links: DataFrame, outcomes: DataFrame, as_of: Column) -> DataFrame:
    """New state of links after a sync: ids of matches, cooldowns of errors; a lease with another fingerprint is void."""
    o = outcomes.select("id", F.col("outcome").alias("_o"), F.col("provider_id").alias("_p"), F.col("code").alias("_c"), F.col("fingerprint").alias("_f"))
    joined = links.join(o, "id", "left")
    valid = F.col("_o").isNotNull() & F.col("fingerprint").eqNullSafe(F.col("_f"))
    return joined.select(
        "id", "fingerprint", F.when(valid & (F.col("_o") == "matched"), F.col("_p")).otherwise(F.col("provider_id")).alias("provider_id"),
        F.when(valid, as_of).otherwise(F.col("attempted_at")).alias("attempted_at"),
        F.when(valid & (F.col("_o") == "error"), as_of + F.make_dt_interval(secs=cooldown_seconds(F.col("_c")).cast("decimal(18,6)")))
        .when(~valid, F.col("retry_after")).alias("retry_after"),
        F.when(~valid, F.col("lease_until")).alias("lease_until"))


def invalidated(history: DataFrame, key: str, order: str, identity: str) -> DataFrame:
    """Rows of a history at which the identity changed, whose cached values are void."""
    from pyspark.sql import Window

    w = Window.partitionBy(key).orderBy(order)
    return history.withColumn("_b", F.lag(identity).over(w)).withColumn("_n", F.row_number().over(w)).where(
        (F.col("_n") > 1) & ~F.col("_b").eqNullSafe(F.col(identity))).drop("_b", "_n")
