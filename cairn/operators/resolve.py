"""Field resolution: evidence scores, agreement, selection and conflicts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cairn.functions.values import bounded, payload_hash, source_family

# Freshness by age in days (up to, factor), the factor beyond, and the one of unknown age.
FRESHNESS = {
    "hours": (((180, 1.0), (365, 0.90), (730, 0.70)), 0.50, 0.70),
    "price_level": (((365, 1.0), (730, 0.80)), 0.60, 0.70),
    "": (((365, 1.0), (1095, 0.96)), 0.88, 0.92),
}
MINIMUM_SCORES = {"phone_e164": 0.68, "website_url": 0.68, "neighborhood": 0.68, "hours": 0.58, "price_level": 0.75}
OTHER_MINIMUM = 0.68
#: The origin that a source states itself, where it is not of the source's name (fixed values).
DIRECT_ORIGINS = {"fsq": "foursquare"}
MARGIN = 0.06
SCORE_CAP = 0.995
AGREEMENT_STEP, AGREEMENT_CAP = 0.04, 0.08


def freshness_factor(updated: Column, as_of: Column, field: Column | None = None) -> Column:
    """Step function of age in whole days; hours and prices age faster."""
    age = F.greatest(F.lit(0), F.floor((F.unix_timestamp(as_of) - F.unix_timestamp(updated)) / 86400))

    def curve(kind: str) -> Column:
        steps, beyond, unknown = FRESHNESS[kind]
        chain = F.when(updated.isNull(), unknown)
        for days, factor in steps:
            chain = chain.when(age <= days, factor)
        return chain.otherwise(beyond)

    if field is None:
        return curve("")
    return F.when(field == "hours", curve("hours")).when(field == "price_level", curve("price_level")).otherwise(curve(""))


def evidence_score(authority: Column, confidence: Column, identity: Column, freshness: Column) -> Column:
    return bounded(authority) * bounded(confidence) * (0.70 + 0.30 * bounded(identity)) * freshness


def group_values(evidence: DataFrame, keys: list[str], value: str, score: str, origin: str, evidence_id: str) -> DataFrame:
    """One row per value: its best score with the bonus for further origins, its origins and best evidence.

    Origins and maxima combine before the shuffle; only distinct origins are gathered.
    """
    agg = evidence.where(F.col(value).isNotNull() & (F.col(value) != "")).groupBy(*keys, value).agg(
        F.max(score).alias("_base"), F.array_sort(F.collect_set(origin)).alias("origins"),
        F.max(F.struct(F.col(score), F.col(evidence_id))).alias("_best"), F.count("*").alias("evidence_count"))
    bonus = F.least(F.lit(AGREEMENT_CAP), AGREEMENT_STEP * (F.greatest(F.size("origins"), F.lit(1)) - 1))
    return agg.select(*keys, value, "origins", "evidence_count", F.col(f"_best.{evidence_id}").alias("best_evidence"),
                      F.least(F.lit(SCORE_CAP), F.col("_base") + bonus).alias("score"))


def select_value(values: DataFrame, keys: list[str], value: str, minimum: Column | float, margin: float = MARGIN) -> DataFrame:
    """One row per key: the selected value or null, its score and ``status`` selected, conflicted or insufficient.

    The best value must reach the minimum and beat the second by the margin.
    A close call is still decided if both share an origin and it is ``direct_origin`` of the best, where given.
    """
    w = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc(value))
    ranked = values.withColumn("_k", F.row_number().over(w)).withColumn("_second", F.lead("score").over(w)).withColumn(
        "_origins2", F.lead("origins").over(w)).withColumn("_n", F.count("*").over(Window.partitionBy(*keys)))
    least = minimum if isinstance(minimum, Column) else F.lit(minimum)
    clear = F.col("_second").isNull() | (F.col("score") - F.col("_second") >= margin)
    if "direct_origin" in values.columns:
        clear = clear | (F.arrays_overlap("origins", "_origins2") & F.array_contains("origins", F.col("direct_origin")))
    chosen = (F.col("score") >= least) & clear
    return ranked.where("_k = 1").select(
        *keys, F.when(chosen, F.col(value)).alias("selected_value"), F.when(chosen, F.col("score")).alias("score"),
        F.col("_n").alias("value_count"), F.size("origins").alias("origin_count"),
        F.when(chosen, "selected").when(F.col("_n") > 1, "conflicted").otherwise("insufficient").alias("status"))


def score_evidence(evidence: DataFrame, as_of: Column) -> DataFrame:
    """Evidence with its ``score`` and its ``origins`` (the source's family where it names none)."""
    factor = freshness_factor(F.col("source_updated_at"), as_of, F.col("field"))
    named = F.coalesce(F.size("origin_keys") > 0, F.lit(False))
    return evidence.withColumn("score", evidence_score(F.col("authority"), F.col("evidence_confidence"), F.col("identity_confidence"), factor)).withColumn(
        "origins", F.when(named, F.col("origin_keys")).otherwise(F.array(source_family(F.col("source")))))


def rank_values(scored: DataFrame) -> DataFrame:
    """One row per entity, field and normalized value: its score with the bonus for further origins, and its best evidence.

    A website's best evidence is one by https before one of a higher score; of equal evidence the smallest id is the best.
    """
    value = F.coalesce(F.nullif("normalized_value", F.lit("")), F.nullif("value_text", F.lit("")))
    secure = (F.col("field") == "website_url") & ~F.coalesce(F.col("value_text").startswith("https://"), F.lit(False))
    facts = F.struct("value_text", "source", "evidence_id")
    grouped = scored.withColumn("value", value).where(F.col("value").isNotNull()).groupBy("entity", "field", "value").agg(
        F.max("score").alias("base"), F.min_by(facts, F.struct(secure.cast("int").alias("a"), (-F.col("score")).alias("s"), "evidence_id")).alias("best"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("origins")))).alias("origins"), F.array_sort(F.collect_set("evidence_id")).alias("evidence_ids"))
    bonus = F.least(F.lit(AGREEMENT_CAP), AGREEMENT_STEP * (F.greatest(F.size("origins"), F.lit(1)) - 1))
    return grouped.select("entity", "field", "value", "best.*", "origins", "evidence_ids", F.least(F.lit(SCORE_CAP), F.col("base") + bonus).alias("score"))


def decide_fields(evidence: DataFrame, as_of: Column, version: str, retained: DataFrame | None = None) -> DataFrame:
    """One decision per entity and field with evidence or a retained value: selected, retained or unknown, with its fingerprint.

    The best value must reach the field's least score and beat the next by the
    margin, unless both share an origin that the best one's source states
    itself.  retained: entity, field, value_text, confidence of present values
    that stay where nothing is selected.  ``value_count`` tells how many values competed.
    """
    w = Window.partitionBy("entity", "field").orderBy(F.desc("score"), "value")
    ranked = rank_values(score_evidence(evidence, as_of)).select(
        "*", F.row_number().over(w).alias("_k"), F.lead("score").over(w).alias("_second"), F.lead("origins").over(w).alias("_other"),
        F.count("*").over(Window.partitionBy("entity", "field")).alias("value_count"))
    direct = F.coalesce(F.element_at(F.create_map(*(F.lit(x) for kv in DIRECT_ORIGINS.items() for x in kv)), F.col("source")), F.col("source"))
    own_copy = F.arrays_overlap("origins", "_other") & F.coalesce(F.array_contains("origins", direct), F.lit(False))
    least = F.coalesce(F.element_at(F.create_map(*(F.lit(x) for kv in MINIMUM_SCORES.items() for x in kv)), F.col("field")), F.lit(OTHER_MINIMUM))
    clear = F.col("_second").isNull() | (F.col("score") - F.col("_second") >= MARGIN) | F.coalesce(own_copy, F.lit(False))
    best = ranked.where("_k = 1").withColumn("_chosen", (F.col("score") >= least) & clear).drop("_k", "_second", "_other")
    if retained is None:
        best = best.withColumn("_kept", F.lit(None).cast("string")).withColumn("_sure", F.lit(None).cast("double"))
    else:
        best = best.join(retained.select("entity", "field", F.col("value_text").alias("_kept"), F.col("confidence").alias("_sure")), ["entity", "field"], "full_outer")
    chosen = F.coalesce("_chosen", F.lit(False))
    none = F.array().cast(evidence.schema["evidence_id"].dataType.simpleString().join(("array<", ">")))
    decided = best.select(
        "entity", "field", F.when(chosen | F.col("_kept").isNotNull(), "selected").otherwise("unknown").alias("status"),
        F.when(chosen, F.col("value_text")).otherwise(F.col("_kept")).alias("value_text"), F.when(chosen, F.round("score", 3)).when(F.col("_kept").isNotNull(), F.round(F.coalesce("_sure", F.lit(0.0)), 3)).alias("confidence"),
        F.when(chosen, F.col("source")).alias("source"), F.when(chosen, F.col("evidence_ids")).otherwise(none).alias("evidence_ids"),
        F.when(chosen, F.col("origins")).otherwise(F.array().cast("array<string>")).alias("origins"),
        F.when(chosen, "highest_scoring_admissible_evidence").when(F.col("_kept").isNotNull(), "retained_existing_canonical_value").otherwise(
            "no_admissible_unconflicted_evidence").alias("reason"), F.coalesce("value_count", F.lit(0)).alias("value_count"))
    return decided.withColumn("fingerprint", payload_hash(
        entity=F.col("entity"), field=F.col("field"), status=F.col("status"), value=F.col("value_text"), confidence=F.col("confidence"),
        evidence=F.col("evidence_ids"), version=F.lit(version)))


def preferred_evidence(evidence: DataFrame, sources: tuple[str, ...] = ("datasf_neighborhoods", "overture_divisions"), field: str = "neighborhood") -> DataFrame:
    """Evidence of which, for one field of an entity, only that of its most preferred source stays, where it has one."""
    place = F.coalesce(F.nullif(F.array_position(F.array(*(F.lit(s) for s in sources)), F.col("source")), F.lit(0)), F.lit(len(sources) + 1))
    best = evidence.where(F.col("field") == field).groupBy("entity").agg(F.min(place).alias("_best"))
    joined = evidence.join(best, "entity", "left")
    return joined.where((F.col("field") != field) | (F.col("_best") > len(sources)) | (place == F.col("_best"))).drop("_best")


def changed_decisions(decisions: DataFrame, current: DataFrame) -> DataFrame:
    """Decisions whose fingerprint is not the current one of their entity and field; a return to an older decision is a change."""
    now = current.select("entity", "field", F.col("fingerprint").alias("_now"))
    return decisions.join(now, ["entity", "field"], "left").where(~F.col("fingerprint").eqNullSafe(F.col("_now"))).drop("_now")


def review_reason(status: Column, value_count: Column, origin_count: Column, high_risk: Column) -> Column:
    """Why a field needs review, or null."""
    return F.when((status != "selected") & (value_count > 1), "conflicting_admissible_evidence").when(
        (status == "selected") & high_risk & (origin_count < 2), "single_origin_high_risk_field")


def noisy_or(confidences: Column, top: int = 4, weight: float = 0.90) -> Column:
    """Joint confidence of an array: top values by noisy-or, cap .995; one alone at most .94; none 0."""
    best = F.slice(F.sort_array(confidences, asc=False), 1, top)
    miss = F.aggregate(best, F.lit(1.0), lambda m, c: m * (1 - weight * c))
    return F.when(F.size(confidences) == 0, 0.0).when(
        F.size(confidences) == 1, F.least(F.lit(0.94), weight * F.get(best, F.lit(0)))).otherwise(
        F.least(F.lit(SCORE_CAP), F.greatest(F.lit(0.0), 1 - miss)))


def type_confidence(matching: Column, best: Column, families: Column, identity: Column) -> Column:
    """Best score plus .03 per further source family (cap .06); min(.70, identity) without a matching row."""
    return F.when(matching == 0, F.least(F.lit(0.70), identity)).otherwise(
        F.least(F.lit(SCORE_CAP), best + F.least(F.lit(0.06), 0.03 * F.greatest(F.lit(0), families - 1))))


def corroborated(field: Column, source: Column, origins: Column) -> Column:
    """Phones and websites need two origins unless entered by hand."""
    return ~field.isin("phone_e164", "website_url") | (source == "manual") | (origins >= 2)


def review_confidence(evidence: Column, identity: Column, authority: Column) -> Column:
    return F.least(F.lit(0.99), evidence * identity * (0.7 + 0.3 * authority))
