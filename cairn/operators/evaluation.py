"""Incremental evaluation of candidates, its history, and what it does to publications.

A candidate is judged anew only where its facts differ from those of its last
judgement, where the rules have another version, or where a date has passed on
which time alone may change the verdict.  All others keep their row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.sources.shared import written
from cairn.sources.versions import VersionedTable

_STATE = ("candidate_id long, candidate_state string, decision_reason string, decision_version string, facts_hash string, review_at timestamp, "
          "evaluated_at timestamp, publication_state string, publication_reason string")
_HISTORY = "candidate_id long, evaluated_at timestamp, candidate_state string, decision_reason string, decision_version string, facts_hash string"


def facts_hash(facts: DataFrame, key: str) -> Column:
    """SHA-256 of all columns but the key, by name, nulls included."""
    ordered = F.struct(*(F.col(c) for c in sorted(c for c in facts.columns if c != key)))
    return F.sha2(F.to_json(ordered, {"ignoreNullFields": "false"}), 256)


def next_review(as_of: Column, *dates: Column) -> Column:
    """The first date after ``as_of`` on which a verdict may change by itself; null if none."""
    return F.array_min(F.filter(F.array(*(d.cast("timestamp") for d in dates)), lambda d: d > as_of))


class Evaluations:
    """The judged candidates under a folder: their present state, and a row for every judgement.

    judge: facts (with ``candidate_id``) to ``candidate_id, state, reason, review_at``; version: of its rules.
    """

    def __init__(self, spark: SparkSession, root: str, judge: Callable[[DataFrame, Column], DataFrame], version: str):
        self.spark, self.root, self.judge, self.version = spark, root.rstrip("/"), judge, version
        self.table = VersionedTable(spark, f"{self.root}/state", _STATE)
        spark.createDataFrame([], _HISTORY).write.mode("append").parquet(f"{self.root}/history")

    def state(self) -> DataFrame:
        return self.table.read()

    def history(self) -> DataFrame:
        return self.spark.read.schema(_HISTORY).parquet(f"{self.root}/history")

    def due(self, facts: DataFrame, as_of: Column) -> DataFrame:
        """Facts of the candidates that must be judged, with ``facts_hash``."""
        hashed = facts.withColumn("facts_hash", facts_hash(facts, "candidate_id"))
        known = self.state().where((F.col("decision_version") == self.version) & (F.col("review_at").isNull() | (F.col("review_at") > as_of)))
        return hashed.join(known.select("candidate_id", "facts_hash"), ["candidate_id", "facts_hash"], "left_anti")

    def evaluate(self, facts: DataFrame, as_of: Column, everyone: bool = True) -> int:
        """Judge what is due and return how many candidates that were.

        facts: one row per candidate.  A published candidate that is verified no more is suppressed with the reason.
        With ``everyone``, the facts are those of all candidates, and one without facts loses its state's support: it
        is judged ``rejected`` for having no sources.
        """
        base, _, _ = self.table.latest()
        due = self.due(facts, as_of)
        verdicts = self.judge(due.drop("facts_hash"), as_of).join(due.select("candidate_id", "facts_hash"), "candidate_id")
        current = self.state()
        if everyone:
            gone = current.where("decision_reason <> 'no_linked_sources'").join(facts.select("candidate_id"), "candidate_id", "left_anti")
            verdicts = verdicts.unionByName(gone.select("candidate_id", F.lit("rejected").alias("state"), F.lit("no_linked_sources").alias("reason"),
                                                        F.lit(None).cast("timestamp").alias("review_at"), F.lit(None).cast("string").alias("facts_hash")))
        verdicts = written(verdicts, "verdicts")  # judged once: the state and the history read the same rows
        n = verdicts.count()
        if not n:
            return 0
        fresh = verdicts.select("candidate_id", F.struct("state", "reason", "review_at", "facts_hash").alias("v"))
        joined = current.join(fresh, "candidate_id", "full_outer")
        v, judged = F.col("v"), F.col("v").isNotNull()
        pick = lambda new, old: F.when(judged, new).otherwise(F.col(old)).alias(old)
        out = judged & (v["state"] != "verified") & (F.col("publication_state") == "published")
        new = joined.select(
            "candidate_id", pick(v["state"], "candidate_state"), pick(v["reason"], "decision_reason"), pick(F.lit(self.version), "decision_version"),
            pick(v["facts_hash"], "facts_hash"), pick(v["review_at"], "review_at"), pick(as_of, "evaluated_at"),
            F.when(out, "suppressed").otherwise(F.col("publication_state")).alias("publication_state"),
            F.when(out, v["reason"]).otherwise(F.col("publication_reason")).alias("publication_reason"))
        self.table.replace(new, base, f"evaluated {n}")
        verdicts.select("candidate_id", as_of.alias("evaluated_at"), F.col("state").alias("candidate_state"), F.col("reason").alias("decision_reason"),
                        F.lit(self.version).alias("decision_version"), "facts_hash").write.mode("append").parquet(f"{self.root}/history")
        return n

    def publish(self, limit: int, as_of: Column) -> int:
        """Publish verified candidates that are not, in order of judgement and id, at most ``limit``; returns how many."""
        base, _, _ = self.table.latest()
        state = self.state()
        ready = state.where("candidate_state = 'verified' AND coalesce(publication_state, '') <> 'published'").orderBy("evaluated_at", "candidate_id").limit(limit)
        chosen = ready.select("candidate_id", F.lit(True).alias("_now"))
        new = state.join(chosen, "candidate_id", "left").withColumn("publication_state", F.when(F.col("_now"), "published").otherwise(F.col("publication_state"))).withColumn(
            "publication_reason", F.when(F.col("_now"), F.concat(F.lit("all_hard_gates_passed:"), "decision_version")).otherwise(F.col("publication_reason")))
        n = chosen.count()
        if n:
            self.table.replace(new, base, f"published {n}")
        return n

    def refresh(self, facts: DataFrame, as_of: Column) -> DataFrame:
        """Judge some candidates now, and say what that did: ``candidate_id, state, reason, before, after, action``.

        One that had been published and is verified again is published anew (refreshed, or republished after a
        suppression); one never published stays so.
        """
        base, _, _ = self.table.latest()
        before = self.state().select("candidate_id", F.col("publication_state").alias("before"))
        self.evaluate(facts, as_of, everyone=False)
        base, _, _ = self.table.latest()
        asked = facts.select("candidate_id", F.lit(True).alias("_asked"))
        state = self.state()
        again = F.col("_asked") & (F.col("candidate_state") == "verified") & F.col("publication_state").isNotNull()
        self.table.replace(state.join(asked, "candidate_id", "left").withColumn(
            "publication_state", F.when(again, "published").otherwise(F.col("publication_state"))), base, "refreshed")
        now = self.state().join(asked, "candidate_id").join(before, "candidate_id", "left")
        action = (F.when((F.col("candidate_state") == "verified") & (F.col("before") == "published"), "refreshed")
                  .when((F.col("candidate_state") == "verified") & F.col("before").isNotNull(), "republished")
                  .when((F.col("before") == "published") & (F.col("publication_state") == "suppressed"), "suppressed").otherwise("unchanged"))
        return now.select("candidate_id", F.col("candidate_state").alias("state"), F.col("decision_reason").alias("reason"), "before",
                          F.col("publication_state").alias("after"), action.alias("action"))
