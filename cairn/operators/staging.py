"""All-or-nothing staging of source snapshots.

A snapshot and the state before it meet in one full outer join, whose result is
written once as the next version of the state; the same write counts what
happened, and only then the guard decides whether the version may hold.  A
refused or failed snapshot is never read.
"""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cairn.operators.snapshot import guard_size
from cairn.sources.versions import VersionedTable

COUNTERS = ("fetched", "created", "updated", "unchanged", "revived", "closed")
_RUN = ("source string, run_id string, mode string, status string, error string, release_id string, record_count long, "
        + ", ".join(f"{c} long" for c in COUNTERS))
_STATE = "source_record_id string, payload_hash string, source_status string, first_run string, last_seen_run string, changed_run string, retired_run string"
ERROR_LENGTH = 2000


def _observed(counts: Observation) -> dict[str, int]:
    """What an observation has counted; nothing where Spark left its part of the plan out, because it can have no rows."""
    try:
        return counts.get
    except Py4JJavaError:
        return {}


class SourceStage:
    """The staged records of one source, and the runs that staged them.

    fields: DDL of the record columns besides ``source_record_id`` and ``payload_hash``.
    """

    def __init__(self, spark: SparkSession, root: str, source: str, fields: str):
        self.spark, self.root, self.source = spark, root.rstrip("/"), source
        self.state = VersionedTable(spark, f"{self.root}/state", f"{_STATE}, {fields}" if fields else _STATE)
        self.fields = [c for c in self.state.read().columns if c not in spark.createDataFrame([], _STATE).columns]
        spark.createDataFrame([], _RUN).write.mode("append").parquet(f"{self.root}/runs")

    def runs(self) -> DataFrame:
        return self.spark.read.schema(_RUN).parquet(f"{self.root}/runs")

    def records(self) -> DataFrame:
        return self.state.read()

    def stage(self, records: DataFrame, run_id: str, mode: str = "full", scope: Column | None = None, release_id: str | None = None,
              allow_shrink: bool = False) -> dict[str, int]:
        """Stage one snapshot and return its counters; SnapshotRefused leaves the state as it was.

        records: ``source_record_id``, ``payload_hash`` and the fields.  ``scope`` tells which rows belong to the catalog;
        rows without id do not.  Of several rows of one id the one of the greatest hash counts.  Rows seen again are
        revived; after a full snapshot, rows not seen are retired; an increment may be small, but not empty.  Every run is logged, failed ones with their error.
        """
        if mode not in ("full", "incremental"):
            raise ValueError("a snapshot is full or incremental")
        base, _, before = self.state.latest()  # the note of a version is the number of rows of the last full snapshot
        counts = dict.fromkeys(COUNTERS, 0)
        try:
            seen, done = Observation(), Observation()
            rows = records.observe(seen, F.count(F.lit(1)).alias("fetched")).where(F.col("source_record_id").isNotNull())
            path = self.state.prepare(self._next(rows if scope is None else rows.where(scope), run_id, mode).observe(done, *(
                F.coalesce(F.count_if(F.col("_change") == c), F.lit(0)).alias(c) for c in ("created", "updated", "unchanged", "closed")),
                F.count_if(F.col("_revived")).alias("revived")))
            counts |= _observed(seen) | _observed(done)
            current = counts["created"] + counts["updated"] + counts["unchanged"]
            guard_size(int(before or 0), current, allow_shrink or mode == "incremental")
            self.state.enter(path, base, str(current) if mode == "full" else before)
        except Exception as error:
            self._log(run_id, mode, "failed", str(error)[:ERROR_LENGTH], release_id, None, counts)
            raise
        self._log(run_id, mode, "succeeded", None, release_id, current, counts)
        return counts

    def _next(self, rows: DataFrame, run_id: str, mode: str) -> DataFrame:
        run, gone = F.lit(run_id), F.lit(mode == "full")
        # of several rows of one id the greatest hash, whatever their order
        new = rows.groupBy("source_record_id").agg(F.max_by(F.struct("payload_hash", *self.fields), F.coalesce("payload_hash", F.lit(""))).alias("n"))
        old = self.state.read()
        old = old.select("source_record_id", F.struct(*(c for c in old.columns if c != "source_record_id")).alias("o"))
        n, o = F.col("n"), F.col("o")
        same = n["payload_hash"].eqNullSafe(o["payload_hash"])
        closes = n.isNull() & o["retired_run"].isNull() & gone
        change = F.when(o.isNull(), "created").when(n.isNull(), F.when(closes, "closed").otherwise("kept")).when(same, "unchanged").otherwise("updated")
        joined = old.join(new, "source_record_id", "full_outer").withColumn("_change", change).withColumn(
            "_revived", n.isNotNull() & o.isNotNull() & o["retired_run"].isNotNull())
        pick = lambda c: F.when(n.isNotNull(), n[c]).otherwise(o[c]).alias(c)
        return joined.select(
            "source_record_id", pick("payload_hash"),
            F.when(n.isNotNull(), "open").when(closes, "missing").otherwise(o["source_status"]).alias("source_status"),
            F.coalesce(o["first_run"], run).alias("first_run"), F.when(n.isNotNull(), run).otherwise(o["last_seen_run"]).alias("last_seen_run"),
            F.when(F.col("_change").isin("created", "updated"), run).otherwise(o["changed_run"]).alias("changed_run"),
            F.when(n.isNotNull(), F.lit(None)).when(closes, run).otherwise(o["retired_run"]).cast("string").alias("retired_run"),
            *(pick(c) for c in self.fields), "_change", "_revived")

    def _log(self, run_id: str, mode: str, status: str, error: str | None, release_id: str | None, record_count: int | None, counts: dict[str, int]) -> None:
        row = (self.source, run_id, mode, status, error, release_id, record_count, *(counts[c] for c in COUNTERS))
        self.spark.createDataFrame([row], _RUN).coalesce(1).write.mode("append").parquet(f"{self.root}/runs")

