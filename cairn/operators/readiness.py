"""Release readiness, health, audits, manifests and the next action."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.functions.values import subset


def blockers(checks: dict[str, Column], source_stale: Column | None = None) -> Column:
    """Names of the checks that hold, in order; with ``source_stale:name`` for each stale source."""
    names = F.array_compact(F.array(*(F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in checks.items())))
    return names if source_stale is None else F.concat(names, F.transform(source_stale, lambda s: F.concat(F.lit("source_stale:"), s)))


def publication_counts(entities: DataFrame, version: str, release: str, as_of: Column) -> DataFrame:
    """One row: live, expired, stale and released publications."""
    published = F.col("publication_state") == "published"
    return entities.agg(
        F.count_if(published & (F.col("status") == "open")).alias("live"),
        F.count_if(published & (F.col("verification_expires_at").isNull() | (F.col("verification_expires_at") <= as_of))).alias("expired"),
        F.count_if(published & ~F.col("verification_version").eqNullSafe(F.lit(version))).alias("stale"),
        F.count_if(published & (F.col("expansion_release_id") == release)).alias("released"))


def healthy_weeks(runs: DataFrame, least_jobs: Column, version: str, as_of: Column, days: int) -> DataFrame:
    """One row: distinct weeks with a complete successful refresh, and the latest of them."""
    good = runs.where((F.col("run_type") == "catalog_refresh") & (F.col("state") == "succeeded") & (F.col("dead_count") == 0) & (F.col("job_count") >= least_jobs)
                      & (F.col("decision_version") == version) & (F.col("finished_at") >= as_of - F.make_dt_interval(F.lit(days))))
    return good.agg(F.count_distinct(F.date_trunc("week", "finished_at")).alias("weeks"), F.max("finished_at").alias("latest"))


def available_slots(approved: Column, maximum: Column, used: Column) -> Column:
    return F.when(approved, F.greatest(maximum - used, F.lit(0))).otherwise(0)


def release_state(counts: DataFrame, weeks: DataFrame, event: DataFrame, stale_sources: DataFrame, least_weeks: int, hours: int, as_of: Column) -> DataFrame:
    """One row: ready, blockers and slots.  event has at most one row (the latest authorization); all inputs are one-row reports."""
    stale = stale_sources.agg(F.array_sort(F.collect_list("source")).alias("sources"))
    joined = counts.crossJoin(F.broadcast(weeks)).crossJoin(F.broadcast(stale)).join(F.broadcast(event.limit(1)), F.lit(True), "left")
    slots = available_slots(F.coalesce(F.col("event_type") == "approved", F.lit(False)), F.coalesce("maximum_new_publications", F.lit(0)), F.col("released"))
    found = blockers({
        "authorization_missing": F.col("event_type").isNull(), "authorization_revoked": F.col("event_type") != "approved",
        "authorization_not_effective": F.col("effective_at") > as_of, "authorization_expired": F.col("event_type").isNotNull() & (
            F.col("expires_at").isNull() | (F.col("expires_at") <= as_of)),
        "published_verification_expired": F.col("expired") > 0, "published_decision_version_stale": F.col("stale") > 0,
        "insufficient_healthy_refresh_weeks": F.col("weeks") < least_weeks,
        "latest_refresh_stale": F.col("latest").isNull() | (F.col("latest") < as_of - F.make_dt_interval(hours=F.lit(hours))),
    }, F.col("sources"))
    every = F.concat(found, F.when(slots == 0, F.array(F.lit("release_capacity_exhausted"))).otherwise(F.array().cast("array<string>")))
    return joined.select((F.size(every) == 0).alias("ready"), every.alias("blockers"), slots.alias("available_slots"))


def shown_blockers(names: Column, authorized: Column) -> Column:
    """Without the capacity blocker where the release is not authorized anyway."""
    return F.when(authorized, names).otherwise(F.array_except(names, F.array(F.lit("release_capacity_exhausted"))))


def same_scope(a: Column, b: Column) -> Column:
    """Whether two city lists are equal up to case and order."""
    norm = lambda x: F.array_sort(F.transform(x, F.lower))
    return norm(a).eqNullSafe(norm(b))


def invariant_audit(candidates: DataFrame, version: str, as_of: Column) -> DataFrame:
    """One row of counts of broken invariants among verified and published candidates."""
    held = F.col("candidate_state").isin("verified", "published")
    given = lambda c: F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")) != ""
    without = (given("phone_e164") & ~given("phone_source")) | (given("website_url") & ~given("website_source"))
    return candidates.agg(
        F.count_if(held & ~F.col("decision_version").eqNullSafe(F.lit(version))).alias("stale_decision_version"),
        F.count_if(held & (F.col("verification_expires_at").isNull() | (F.col("verification_expires_at") <= as_of))).alias("expired_verified_state"),
        F.count_if(held & F.col("primary_type").isin("brewery", "winery", "distillery") & ~F.col("verification_tier").eqNullSafe(F.lit("manual"))).alias(
            "automated_generic_manufacturers"),
        F.count_if(held & without).alias("optional_fields_missing_provenance"))


def manifest_problems(cities: DataFrame, counties: int, expected: int) -> DataFrame:
    """Rows (problem) of a release manifest: wrong numbers of counties or cities, repeated cities."""
    counted = cities.agg(F.count_distinct("county").alias("k"), F.count("*").alias("n"), F.count_distinct(F.lower("city")).alias("d"))
    return counted.select(F.explode(F.array_compact(F.array(
        F.when(F.col("k") != counties, F.lit("counties")), F.when(F.col("n") != expected, F.lit("cities")), F.when(F.col("d") != F.col("n"), F.lit("repeated")))))
        .alias("problem"))


def fact_problems(facts: DataFrame) -> DataFrame:
    """Facts of a manifest with the rules that they break."""
    uuid = F.col("candidate_id").rlike("^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$")
    https = (F.size("evidence_urls").between(1, 10)) & F.forall("evidence_urls", lambda u: u.startswith("https://"))
    broken = blockers({"candidate_id": ~uuid, "evidence_urls": ~https, "lease_days": ~F.col("lease_days").between(1, 365), "note": F.length("note") > 2000})
    return facts.withColumn("problems", broken).where(F.size("problems") > 0)


def license_subset(ids: Column, allowed: Column) -> Column:
    return subset(ids, allowed)


def next_action(required_ready: Column, expired: Column, visible: Column, legacy: Column, detail: Column, live: Column, ready: Column, review: Column, errors: Column) -> Column:
    """A dashboard's next step by priority."""
    return (F.when(~required_ready, "complete_required_snapshots").when(expired > 0, "sweep_expired").when(visible > 0, "remove_unsafe_rows")
            .when(legacy > 0, "quarantine_legacy_rows").when(detail < live, "restore_detail_routing").when(ready > 0, "keep_candidates_private")
            .when(review > 0, "review_identity_conflicts").when(errors > 0, "retry_provider_errors").when(live == 0, "leave_catalog_empty").otherwise("none"))
