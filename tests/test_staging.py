"""Guarded staging and incremental evaluation: what a refused, failed or repeated run leaves behind."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cairn.operators.evaluation import Evaluations, next_review
from cairn.operators.snapshot import SnapshotRefused
from cairn.operators.staging import SourceStage
from cairn.sources.shared import fresh_path
from cairn.sources.versions import Conflict, VersionedTable

ROW = "source_record_id string, payload_hash string, name string"


def stage_of(spark):
    return SourceStage(spark, fresh_path(spark, "test-stage"), "osm", "name string")


def rows(spark, *items):
    return spark.createDataFrame([(i, h, f"name {i}") for i, h in items], ROW)


def shown(stage):
    return {r.source_record_id: (r.payload_hash, r.source_status, r.first_run, r.last_seen_run, r.changed_run, r.retired_run) for r in stage.records().collect()}


def test_stage_revives_and_retires(spark):
    stage = stage_of(spark)
    assert stage.records().count() == 0
    first = stage.stage(rows(spark, ("a", "1"), ("b", "1"), ("b", "2"), (None, "9"), ("c", None)), "r1", scope=F.col("source_record_id") != "z")
    assert first == {"fetched": 5, "created": 3, "updated": 0, "unchanged": 0, "revived": 0, "closed": 0}
    assert stage.stage(rows(spark, ("a", "1"), ("z", "1")), "r2", scope=F.col("source_record_id") != "z")["closed"] == 2
    again = stage.stage(rows(spark, ("b", "2"), ("c", "3"), ("a", "2")), "r3")
    assert again == {"fetched": 3, "created": 0, "updated": 2, "unchanged": 1, "revived": 2, "closed": 0}
    stage.stage(rows(spark, ("a", "2")), "r4", mode="incremental")
    assert shown(stage) == {"a": ("2", "open", "r1", "r4", "r3", None), "b": ("2", "open", "r1", "r3", "r1", None), "c": ("3", "open", "r1", "r3", "r3", None)}
    assert [r.status for r in stage.runs().orderBy("run_id").collect()] == ["succeeded"] * 4


def test_refused_snapshot_is_never_read(spark):
    stage = stage_of(spark)
    stage.stage(rows(spark, *((str(i), "1") for i in range(40))), "r1")
    before = shown(stage)
    with pytest.raises(SnapshotRefused):
        stage.stage(rows(spark, *((str(i), "2") for i in range(19))), "r2")
    with pytest.raises(SnapshotRefused):
        stage.stage(rows(spark), "r3")
    with pytest.raises(SnapshotRefused):
        stage.stage(rows(spark, ("x", "1")), "r4", scope=F.col("source_record_id") == "nobody")
    with pytest.raises(SnapshotRefused):
        stage.stage(rows(spark), "r5", mode="incremental")
    assert shown(stage) == before
    log = {r.run_id: (r.status, r.fetched, r.record_count) for r in stage.runs().collect()}
    assert log == {"r1": ("succeeded", 40, 40), "r2": ("failed", 19, None), "r3": ("failed", 0, None), "r4": ("failed", 1, None), "r5": ("failed", 0, None)}
    stage.stage(rows(spark, *((str(i), "2") for i in range(19))), "r6", allow_shrink=True)
    assert sum(v[5] == "r6" for v in shown(stage).values()) == 21


def test_failed_job_leaves_the_state(spark):
    stage = stage_of(spark)
    stage.stage(rows(spark, ("a", "1")), "r1")
    broken = rows(spark, ("a", "2")).withColumn("name", F.raise_error(F.lit("the download broke off")).cast("string"))
    with pytest.raises(Exception, match="broke off"):
        stage.stage(broken, "r2")
    assert shown(stage)["a"][0] == "1"
    last = stage.runs().where("run_id = 'r2'").first()
    assert last.status == "failed" and "broke off" in last.error
    with pytest.raises(ValueError):
        stage.stage(rows(spark, ("a", "1")), "r3", mode="partial")


def test_two_writers(spark):
    table = VersionedTable(spark, fresh_path(spark, "test-versions"), "k int")
    base, _, _ = table.latest()
    mine, theirs = table.prepare(spark.range(1).selectExpr("1 AS k")), table.prepare(spark.range(1).selectExpr("2 AS k"))
    table.enter(theirs, base)
    with pytest.raises(Conflict):
        table.enter(mine, base)
    assert [r.k for r in table.read().collect()] == [2]


FACTS = "candidate_id long, links int, until timestamp"
DAY = dt.timedelta(days=1)
NOW = dt.datetime(2024, 5, 1)


def judge(facts, now):
    ok = (F.col("links") > 0) & (F.col("until").isNull() | (F.col("until") > now))
    return facts.select("candidate_id", F.when(ok, "verified").otherwise("needs_verification").alias("state"), F.when(ok, "ok").otherwise("no").alias("reason"),
                        next_review(now, F.col("until")).alias("review_at"))


@pytest.fixture
def evaluations(spark):
    return Evaluations(spark, fresh_path(spark, "test-evaluations"), judge, "v1")


def known(e):
    return {r.candidate_id: (r.candidate_state, r.publication_state) for r in e.state().collect()}


def facts(spark, *items):
    return spark.createDataFrame(list(items), FACTS)


def test_only_what_changed_is_judged(spark, evaluations):
    e, at = evaluations, lambda d: F.lit(NOW + d * DAY)
    base = [(1, 1, None), (2, 0, None), (3, 2, NOW + 10 * DAY), (4, 1, None)]
    assert e.evaluate(facts(spark, *base), at(0)) == 4
    assert e.publish(2, at(0)) == 2 and e.publish(9, at(0)) == 1 and e.publish(9, at(0)) == 0
    assert e.evaluate(facts(spark, *base), at(0)) == 0 and e.evaluate(facts(spark, *base), at(9)) == 0
    assert e.evaluate(facts(spark, *base), at(10)) == 1  # a lease is over
    assert known(e) == {1: ("verified", "published"), 2: ("needs_verification", None), 3: ("needs_verification", "suppressed"), 4: ("verified", "published")}
    assert e.evaluate(facts(spark, (1, 0, None), (2, 1, None), (3, 2, NOW + 10 * DAY), (5, 1, None)), at(11)) == 4  # two changed, one new, one gone
    assert known(e) == {1: ("needs_verification", "suppressed"), 2: ("verified", None), 3: ("needs_verification", "suppressed"), 4: ("rejected", "suppressed"), 5: ("verified", None)}
    assert e.evaluate(facts(spark, (1, 0, None), (2, 1, None), (3, 2, NOW + 10 * DAY), (5, 1, None)), at(12)) == 0
    assert {r.candidate_id: r["count"] for r in e.history().groupBy("candidate_id").count().collect()} == {1: 2, 2: 2, 3: 2, 4: 2, 5: 1}
    newer = Evaluations(spark, e.root, judge, "v2")  # other rules judge everyone anew
    assert newer.evaluate(facts(spark, (1, 0, None), (2, 1, None), (3, 2, NOW + 10 * DAY), (5, 1, None)), at(12)) == 4


def test_nothing_to_judge(spark, evaluations):
    assert evaluations.evaluate(facts(spark), F.lit(NOW)) == 0
    assert evaluations.publish(5, F.lit(NOW)) == 0
    assert known(evaluations) == {}


def test_refresh(spark, evaluations):
    e = evaluations
    e.evaluate(facts(spark, (1, 1, None), (2, 1, None), (3, 1, None), (4, 1, None)), F.lit(NOW))
    e.publish(3, F.lit(NOW))
    e.evaluate(facts(spark, (3, 0, None)), F.lit(NOW), everyone=False)
    got = {r.candidate_id: (r.before, r.after, r.action) for r in e.refresh(
        facts(spark, (1, 1, None), (2, 0, None), (3, 1, None), (4, 1, None), (9, 1, None)), F.lit(NOW + DAY)).collect()}
    assert got == {1: ("published", "published", "refreshed"), 2: ("published", "suppressed", "suppressed"), 3: ("suppressed", "published", "republished"),
                   4: (None, None, "unchanged"), 9: (None, None, "unchanged")}
