"""Evidence ledger: records to claims, rights, fingerprints, append-only rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.functions.text import blank_to_null
from cairn.functions.values import digest
from cairn.operators.snapshot import append_new

RIGHTS = ("may_store", "may_display", "may_derive", "may_redistribute")


def to_claims(records: DataFrame, keys: list[str], fields: dict[str, Column]) -> DataFrame:
    """Wide records to (keys, field_name, value_text); null and blank values make no claim."""
    pairs = F.array(*(F.struct(F.lit(n).alias("field_name"), blank_to_null(c.cast("string")).alias("value_text")) for n, c in fields.items()))
    return records.select(*keys, F.explode(pairs).alias("_c")).select(*keys, "_c.*").where("value_text IS NOT NULL")


def settings_claims(records: DataFrame, keys: list[str], settings: str) -> DataFrame:
    """One claim for each element of an array column."""
    return records.select(*keys, F.lit("setting_slug").alias("field_name"), F.explode(settings).alias("value_text"))


def admit(claims: DataFrame, policies: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Claims with ``admitted`` and the first ``rejection``, by the policy of their source.

    A policy row has ``source``, the four rights, ``authority`` and
    ``allowed_license_ids``; optionally ``effective_from`` and
    ``effective_until``.  Claims have ``source``, ``license_ids``,
    ``origin_keys`` and ``authority``.  The policy table is small by nature
    (a row per source and version), and Spark broadcasts it if it is.
    """
    p = policies.select("source", *RIGHTS, F.col("authority").alias("_most"), "allowed_license_ids",
                        *(c for c in ("effective_from", "effective_until") if c in policies.columns))
    if as_of is not None and "effective_from" in policies.columns:
        p = p.where((F.col("effective_from") <= as_of) & (F.col("effective_until").isNull() | (F.col("effective_until") > as_of)))
    rights = F.lit(True)
    for r in RIGHTS:
        rights = rights & F.coalesce(F.col(r), F.lit(False))
    reason = (
        F.when(F.col("_most").isNull(), "no_policy").when(~rights, "rights_missing")
        .when(F.size(F.array_except("license_ids", "allowed_license_ids")) > 0, "license_not_allowed")
        .when(F.size("origin_keys") == 0, "no_origin").when(F.col("authority") > F.col("_most"), "authority_exceeds_policy"))
    joined = claims.join(p, "source", "left").withColumn("rejection", reason)
    return joined.withColumn("admitted", F.col("rejection").isNull()).select(*claims.columns, "admitted", "rejection")


def ledger_rows(claims: DataFrame, keys: list[str]) -> DataFrame:
    """Claims with their content fingerprint."""
    return claims.withColumn("fingerprint", digest(*(F.col(c) for c in [*keys, "source", "field_name", "value_text"])))


def append(ledger: DataFrame, claims: DataFrame, keys: list[str]) -> DataFrame:
    """The rows that an append adds: each new fingerprint once."""
    return append_new(ledger, ledger_rows(claims, keys), "fingerprint")
