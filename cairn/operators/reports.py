"""Coverage, rollups, quorum votes, audits and overlays."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def count_where(condition: Column, name: str) -> Column:
    return F.count_if(condition).alias(name)


def ranked_counts(df: DataFrame, keys: list[str], limit: int | None = None) -> DataFrame:
    """Group sizes, largest first, ties by key; a limit makes a top-k report."""
    counted = df.groupBy(*keys).agg(F.count("*").alias("n")).orderBy(F.desc("n"), *keys)
    return counted if limit is None else counted.limit(limit)


def coverage(entities: DataFrame, key: str, fields: list[str], decisions: DataFrame) -> DataFrame:
    """Each entity with each field: ``conflicted``, ``unknown``, ``stale`` or the decision's status.

    decisions: ``key, field, status, conflicted, stale`` (at most one row per pair).
    The fields are a literal list, so the matrix is an explode, not a cross join.
    """
    matrix = entities.select(key, F.explode(F.array(*(F.lit(f) for f in fields))).alias("field"))
    d = decisions.select(key, "field", "status", "conflicted", "stale")
    state = (F.when(F.coalesce("conflicted", F.lit(False)), "conflicted").when(F.col("status").isNull(), "unknown")
             .when(F.coalesce("stale", F.lit(False)), "stale").otherwise(F.col("status")))
    return matrix.join(d, [key, "field"], "left").select(key, "field", state.alias("state"))


def strict_winner(votes: DataFrame, entity: str, choice: str, least: int = 2) -> DataFrame:
    """The choice with most votes, if it has ``least`` of them and more than any other."""
    tally = votes.groupBy(entity, choice).agg(F.count("*").alias("votes"))
    w = Window.partitionBy(entity).orderBy(F.desc("votes"), choice)
    ranked = tally.withColumn("_k", F.row_number().over(w)).withColumn("_second", F.lead("votes").over(w))
    return ranked.where((F.col("_k") == 1) & (F.col("votes") >= least) & (F.col("votes") > F.coalesce("_second", F.lit(0)))).select(
        entity, choice, "votes")


def quorum(df: DataFrame, entity: str, voter: str, closed: Column, opened: Column, least: int = 2) -> DataFrame:
    """Entities that at least so many distinct voters call closed and none calls open."""
    return df.groupBy(entity).agg(F.count_distinct(F.when(closed, F.col(voter))).alias("closed_votes"),
                                  F.count_if(opened).alias("open_votes")).where(
        (F.col("closed_votes") >= least) & (F.col("open_votes") == 0)).select(entity, "closed_votes")


def rollup_state(total: Column, done: Column, failed: Column) -> Column:
    """State of a run from counts of its jobs."""
    return (F.when(total == 0, "empty").when(done == total, "succeeded").when(failed == total, "failed")
            .when(done + failed == total, "partial").otherwise("running"))


def ordered_json(keys: list[str], order: str, fields: list[str], name: str) -> Column:
    """Aggregate: JSON array of objects in order.  The group must be bounded by nature, as for a parent's children."""
    rows = F.array_sort(F.collect_list(F.struct(order, *(f for f in fields if f != order))))
    return F.to_json(F.transform(rows, lambda r: F.struct(*(r[f].alias(f) for f in fields)))).alias(name)


def overlay(fields: list[str], sources: list[tuple[str, str]]) -> list[Column]:
    """For each field the first filled value by order of sources, and which source gave it.

    sources: (name, column prefix) in order of precedence.
    """
    out = []
    for f in fields:
        out.append(F.coalesce(*(F.col(f"{p}{f}") for _, p in sources)).alias(f))
        out.append(reduce(lambda c, s: c.when(F.col(f"{s[1]}{f}").isNotNull(), F.lit(s[0])), sources, F).otherwise(
            F.lit(None).cast("string")).alias(f"{f}_source"))
    return out


def dominant_reason(reasons: Column, priority: list[str]) -> Column:
    """The first of the priorities among an array of reasons."""
    return F.get(F.filter(F.array(*(F.lit(p) for p in priority)), lambda p: F.array_contains(reasons, p)), F.lit(0))


def match_outcome(valid: Column, reasons: Column, priority: list[str]) -> Column:
    """Outcome of a provider search from its number of valid candidates."""
    return F.when(valid == 1, "matched").when(valid > 1, "ambiguous").otherwise(
        F.coalesce(dominant_reason(reasons, priority), F.lit("not_found")))
