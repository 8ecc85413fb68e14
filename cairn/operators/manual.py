"""Manual decisions on conflicting fields, and how long they stand.

A review is a dated event that settles a conflict with one of its values or
with none (audited unknown).  The latest manual decision of a field stands
before the automatic one as long as the present evidence is a part of what was
reviewed; new evidence gives the field back to the resolver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.operators.resolve import review_confidence

REVIEW_VERSION = "manual-review-1"
#: Projected fields and the columns that say where they come from; an address has none and is never taken away (fixed values).
PROJECTED = {"phone_e164": "phone", "website_url": "website", "neighborhood": "neighborhood", "hours": "hours", "price_level": "price", "address": None}


def settle_conflicts(conflicts: DataFrame, reviews: DataFrame, observations: DataFrame, as_of: Column) -> tuple[DataFrame, DataFrame]:
    """Manual decisions, and reviews that settle nothing with their reason.

    conflicts: ``conflict_id``, ``entity``, ``field``, ``state``, ``evidence_ids``; reviews: ``conflict_id``, ``reviewed_at``, ``reviewer``, ``notes``,
    ``evidence_id`` (null: unknown); observations: ``evidence_id``, ``entity``, ``field``, ``value``, ``status``, ``expires_at``, ``evidence_confidence``,
    ``identity_confidence``, ``authority``.  A conflict is settled by the first of its reviews that may do so: it must be
    pending, the reviewer and the notes filled, and a selected value present evidence of the same field.
    """
    c = conflicts.select("conflict_id", "entity", "field", F.col("state").alias("_state"), "evidence_ids")
    live = observations.where((F.col("status") == "asserted") & (F.col("expires_at").isNull() | (F.col("expires_at") > as_of)))
    o = live.select("evidence_id", F.col("entity").alias("_e"), F.col("field").alias("_f"), "value", F.round(F.greatest(F.lit(0.0), review_confidence(
        F.col("evidence_confidence"), F.col("identity_confidence"), F.col("authority"))), 3).alias("confidence"))
    joined = reviews.join(c, "conflict_id", "left").join(o, "evidence_id", "left")
    blank = lambda name: F.coalesce(F.trim(name), F.lit("")) == ""
    chosen = F.col("evidence_id").isNotNull()
    own = F.coalesce((F.col("_e") == F.col("entity")) & (F.col("_f") == F.col("field")), F.lit(False))
    problem = (F.when(F.col("entity").isNull(), "no_such_conflict").when(F.col("_state") != "pending", "not_pending").when(blank("reviewer") | blank("notes"), "reviewer_and_notes_required")
               .when(chosen & ~own, "evidence_not_current"))
    judged = joined.withColumn("problem", problem)
    usable = judged.where("problem IS NULL")
    first = usable.groupBy("conflict_id").agg(F.min_by(F.struct(
        "entity", "field", "evidence_id", "value", "confidence", "evidence_ids", "reviewed_at", "reviewer"), F.struct("reviewed_at", "reviewer", F.coalesce("evidence_id", F.lit("")))).alias("d"))
    d = first.select("conflict_id", "d.*")
    picked = F.col("evidence_id").isNotNull()
    decisions = d.select(
        "conflict_id", "entity", "field", F.when(picked, "selected").otherwise("unknown").alias("status"), F.when(picked, F.col("value")).alias("value"),
        F.when(picked, F.col("confidence")).alias("confidence"), F.array_sort(F.array_distinct(F.concat("evidence_ids", F.when(picked, F.array("evidence_id")).otherwise(
            F.array().cast("array<string>"))))).alias("evidence_ids"), F.when(picked, "human_evidence_review").otherwise("human_review_unverified").alias("reason"),
        F.col("reviewed_at").alias("decided_at"), "reviewer", F.lit(REVIEW_VERSION).alias("resolver_version"))
    used = d.select("conflict_id", F.col("reviewed_at").alias("_at"), F.col("reviewer").alias("_who"), F.col("evidence_id").alias("_what"))
    late = judged.join(used, "conflict_id", "left").withColumn("problem", F.coalesce("problem", F.when(
        ~(F.col("reviewed_at").eqNullSafe(F.col("_at")) & F.col("reviewer").eqNullSafe(F.col("_who")) & F.col("evidence_id").eqNullSafe(F.col("_what"))), "not_pending")))
    return decisions, late.where("problem IS NOT NULL").select("conflict_id", "reviewed_at", "reviewer", "problem")


def standing_decisions(automatic: DataFrame, manual: DataFrame, evidence: DataFrame) -> DataFrame:
    """The decision that stands for each entity and field: ``entity, field, status, value, confidence, source``.

    automatic: ``entity``, ``field``, ``status``, ``value``, ``confidence``; manual: decisions of ``settle_conflicts``; evidence: ``entity``, ``field``, ``evidence_ids`` of what is
    known now.  A manual decision without any present evidence does not stand.
    """
    last = manual.groupBy("entity", "field").agg(F.max_by(F.struct("status", "value", "confidence", "evidence_ids"), F.struct("decided_at", "conflict_id")).alias("m"))
    joined = automatic.join(last, ["entity", "field"], "full_outer").join(evidence.select("entity", "field", F.col("evidence_ids").alias("_now")), ["entity", "field"], "left")
    covers = F.coalesce((F.size("_now") > 0) & (F.size(F.array_except("_now", "m.evidence_ids")) == 0), F.lit(False))
    pick = lambda c: F.when(covers, F.col(f"m.{c}")).otherwise(F.col(c)).alias(c)
    return joined.select("entity", "field", pick("status"), pick("value"), pick("confidence"), F.when(covers, "manual").otherwise("resolver").alias("source")).where("status IS NOT NULL")


def reapply_manual(entities: DataFrame, standing: DataFrame, entity: str) -> DataFrame:
    """Published rows with the manual decisions that stand projected over them, other fields unchanged.

    A selected value comes with source ``manual`` and its confidence; an audited unknown takes value, source and
    confidence away, but never an address.
    """
    manual = standing.where("source = 'manual'").groupBy(F.col("entity").alias(entity)).pivot("field", list(PROJECTED)).agg(
        F.first("status").alias("status"), F.first("value").alias("value"), F.first("confidence").alias("confidence"))
    joined = entities.join(manual.toDF(entity, *(f"_m_{c}" for c in manual.columns[1:])), entity, "left")
    changed: dict[str, Column] = {}
    for field, name in PROJECTED.items():
        status, selected = F.col(f"_m_{field}_status"), F.col(f"_m_{field}_status") == "selected"
        kind = entities.schema[field].dataType
        if name is None:
            changed[field] = F.when(selected, F.col(f"_m_{field}_value").cast(kind)).otherwise(F.col(field))
            continue
        for column, value in ((field, F.col(f"_m_{field}_value").cast(kind)), (f"{name}_source", F.lit("manual")), (f"{name}_confidence", F.col(f"_m_{field}_confidence"))):
            changed[column] = F.when(selected, value).when(status.isNull(), F.col(column))
    return joined.select(*(changed[c].alias(c) if c in changed else c for c in entities.columns))
