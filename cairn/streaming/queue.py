"""Leased work queue as a replay of its event log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Seconds for which a claimed job is invisible to other workers.
VISIBILITY_SECONDS = 900
MOST_ATTEMPTS = 3


def replay(log: DataFrame, job: str, order: list[str], kind: str, ts: str, as_of: Column,
           visibility: int = VISIBILITY_SECONDS, attempts: int = MOST_ATTEMPTS) -> DataFrame:
    """State of each job after its log of enqueue, claim, renew, complete and fail events.

    The last event and the numbers of claims and failures decide: one aggregate
    per job.  A claim whose lease has run out is queued again, or dead after
    ``attempts`` claims.
    """
    last = F.max(F.struct(*order, F.col(kind).alias("kind"), F.col(ts).alias("at"))).alias("_last")
    jobs = log.groupBy(job).agg(last, F.count_if(F.col(kind) == "claim").alias("attempts"),
                                F.count_if(F.col(kind) == "fail").alias("failures"))
    kind_, at = F.col("_last.kind"), F.col("_last.at")
    expired = F.unix_timestamp(at) + visibility <= F.unix_timestamp(as_of)
    spent = F.col("attempts") >= attempts
    state = (F.when(kind_ == "complete", "succeeded").when(kind_.isin("claim", "renew") & ~expired, "leased")
             .when(kind_.isin("claim", "renew", "fail") & spent, "dead").otherwise("queued"))
    return jobs.select(job, state.alias("state"), "attempts", "failures")


_STATE = "struct<state:string,worker:string,until:bigint,attempts:int,next_at:bigint>"


def replay_leases(log: DataFrame, job: str, order: list[str], as_of: Column, visibility: int = VISIBILITY_SECONDS, attempts: int = MOST_ATTEMPTS) -> DataFrame:
    """State of each job after its log, event by event, with lease holders, stale-lease recovery and retry delays.

    log: job, order columns, kind, at (seconds), worker, retryable, delay (seconds).
    A claim takes a queued job whose retry time has come, or one whose lease has
    run out.  Only the holder of a lease in force renews, completes or fails it.
    A failure queues the job again after its delay, or ends it where it cannot be
    retried or all attempts are spent; a lease that runs out on the last attempt
    ends it too.  One job's events are folded in one row: jobs are short.
    """
    event = F.struct(*order, "kind", "at", "worker", "retryable", "delay")
    events = log.groupBy(job).agg(F.array_sort(F.collect_list(event)).alias("_e"))
    make = lambda state, worker, until, tries, next_at: F.struct(
        state.alias("state"), worker.cast("string").alias("worker"), until.cast("bigint").alias("until"), tries.cast("int").alias("attempts"),
        next_at.cast("bigint").alias("next_at"))
    none, zero = F.lit(None), F.lit(0)

    def step(s: Column, e: Column) -> Column:
        open_again = (s["state"] == "queued") & (s["next_at"] <= e["at"])
        stale = (s["state"] == "leased") & (s["until"] <= e["at"])
        held = (s["state"] == "leased") & (s["until"] > e["at"]) & (s["worker"] == e["worker"])
        spent = s["attempts"] >= attempts
        dead, again = make(F.lit("dead"), none, none, s["attempts"], none), make(F.lit("queued"), none, none, s["attempts"], e["at"] + e["delay"])
        return (F.when((e["kind"] == "enqueue") & (s["state"] == "new"), make(F.lit("queued"), none, none, zero, e["at"]))
                .when((e["kind"] == "claim") & stale & spent, dead)
                .when((e["kind"] == "claim") & (open_again | stale), make(F.lit("leased"), e["worker"], e["at"] + visibility, s["attempts"] + 1, none))
                .when((e["kind"] == "renew") & held, make(F.lit("leased"), e["worker"], e["at"] + visibility, s["attempts"], none))
                .when((e["kind"] == "complete") & held, make(F.lit("succeeded"), none, none, s["attempts"], none))
                .when((e["kind"] == "fail") & held & (spent | ~F.coalesce(e["retryable"], F.lit(False))), dead)
                .when((e["kind"] == "fail") & held, again).otherwise(s))

    start = make(F.lit("new"), none, none, zero, none)
    now = F.unix_timestamp(as_of)
    after = events.select(job, F.aggregate("_e", start.cast(_STATE), step).alias("s"))
    lost = (F.col("s.state") == "leased") & (F.col("s.until") <= now)
    state = F.when(lost & (F.col("s.attempts") >= attempts), "dead").when(lost, "queued").otherwise(F.col("s.state"))
    return after.select(job, state.alias("state"), F.when(~lost, F.col("s.worker")).alias("worker"), F.col("s.attempts").alias("attempts"), F.col("s.next_at").alias("next_at"))


def enqueue_new(requests: DataFrame, active: DataFrame, key: str) -> DataFrame:
    """Requests whose dedupe key no active job has, each once."""
    return requests.dropDuplicates([key]).join(active.select(key), key, "left_anti")


def expired(rows: DataFrame, expires: str, as_of: Column) -> DataFrame:
    """Rows whose time to live has run out (or that have none)."""
    return rows.where(F.col(expires).isNull() | (F.col(expires) <= as_of))


def ttl_fresh(fetched: Column, expires: Column, ttl_seconds: int, as_of: Column) -> Column:
    """Whether a cached value is usable: not expired, and its expiry no later than its time to live allows."""
    return (expires > as_of) & (F.unix_timestamp(expires) <= F.unix_timestamp(fetched) + ttl_seconds)
