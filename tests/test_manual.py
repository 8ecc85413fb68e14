"""Manual decisions: which reviews settle a conflict, how long they stand, what they project."""

import datetime as dt

from pyspark.sql import functions as F

from cairn.operators import manual

T = dt.datetime(2024, 1, 1)
DAY = dt.timedelta(days=1)


def tables(spark):
    conflicts = spark.createDataFrame([(1, 10, "phone_e164", "pending", ["a", "b"]), (2, 10, "hours", "resolved", ["c"]), (3, 11, "website_url", "pending", ["d"]), (4, 11, "address", "pending", ["f"])],
                                      "conflict_id int, entity int, field string, state string, evidence_ids array<string>")
    observations = spark.createDataFrame([
        ("a", 10, "phone_e164", "+1", "asserted", None, .9, 1.0, 1.0), ("z", 10, "phone_e164", "+3", "asserted", T + 5 * DAY, 1.0, 1.0, 1.0), ("b", 10, "phone_e164", "+2", "asserted", T, .9, 1.0, 1.0),
        ("r", 10, "phone_e164", "+4", "retracted", None, .9, 1.0, 1.0), ("d", 11, "website_url", "https://x", "asserted", None, .5, .9, .5), ("f", 11, "address", "1 Main", "asserted", None, .5, .9, .5)],
        "evidence_id string, entity int, field string, value string, status string, expires_at timestamp, evidence_confidence double, identity_confidence double, authority double")
    return conflicts, observations


REVIEW = "conflict_id int, reviewed_at timestamp, reviewer string, notes string, evidence_id string"


def test_settle(spark):
    conflicts, observations = tables(spark)
    reviews = [(1, T, " ", "x", "a"), (1, T + DAY, "ann", "", "a"), (1, T + DAY, "ann", "n", "b"), (1, T + DAY, "ann", "n", "r"), (1, T + DAY, "ann", "n", "d"), (1, T + 2 * DAY, "ann", "n", "z"),
               (1, T + 3 * DAY, "bob", "n", "a"), (2, T, "ann", "n", None), (3, T, "ann", "n", None), (9, T, "ann", "n", None)]
    decisions, refused = manual.settle_conflicts(conflicts, spark.createDataFrame(reviews, REVIEW), observations, F.lit(T + DAY))
    got = {r.conflict_id: (r.status, r.value, r.confidence, r.evidence_ids, r.reason) for r in decisions.collect()}
    assert got == {1: ("selected", "+3", .99, ["a", "b", "z"], "human_evidence_review"), 3: ("unknown", None, None, ["d"], "human_review_unverified")}
    assert sorted((r.conflict_id, r.reviewer, r.problem) for r in refused.collect()) == [
        (1, " ", "reviewer_and_notes_required"), (1, "ann", "evidence_not_current"), (1, "ann", "evidence_not_current"), (1, "ann", "evidence_not_current"),
        (1, "ann", "reviewer_and_notes_required"), (1, "bob", "not_pending"), (2, "ann", "not_pending"), (9, "ann", "no_such_conflict")]


def test_standing_and_projection(spark):
    conflicts, observations = tables(spark)
    reviews = spark.createDataFrame([(1, T, "ann", "n", "a"), (3, T, "ann", "n", None), (4, T, "ann", "n", None)], REVIEW)
    decided, _ = manual.settle_conflicts(conflicts, reviews, observations, F.lit(T + DAY))
    auto = spark.createDataFrame([(10, "phone_e164", "conflicted", None, None), (11, "website_url", "selected", "https://x", .8), (12, "hours", "selected", "{}", .7)],
                                 "entity int, field string, status string, value string, confidence double")
    now = "entity int, field string, evidence_ids array<string>"
    row = ("id int, phone_e164 string, phone_source string, phone_confidence double, website_url string, website_source string, website_confidence double, neighborhood string, neighborhood_source string, "
           "neighborhood_confidence double, hours string, hours_source string, hours_confidence double, price_level smallint, price_source string, price_confidence double, address string, name string")
    entities = spark.createDataFrame([(i, "+9", "osm", .5, "https://x", "fsq", .8, "n", "s", .1, "{}", "fsq", .7, 2, "fsq", .6, "1 Main", "keep") for i in (10, 11, 12)], row)

    def projected(evidence):
        standing = manual.standing_decisions(auto, decided, spark.createDataFrame(evidence, now))
        return {r.id: r for r in manual.reapply_manual(entities, standing, "id").collect()}

    got = projected([(10, "phone_e164", ["a"]), (11, "website_url", ["d"]), (11, "address", ["f"]), (12, "hours", ["h"])])
    assert (got[10].phone_e164, got[10].phone_source, got[10].phone_confidence) == ("+1", "manual", .9)
    assert (got[11].website_url, got[11].website_source, got[11].website_confidence) == (None, None, None)
    assert got[11].address == "1 Main" and got[11].phone_e164 == "+9" and got[11].name == "keep" and got[12] == [r for r in entities.collect() if r.id == 12][0]
    got = projected([(10, "phone_e164", ["a", "new"]), (11, "website_url", []), (12, "hours", ["h"])])  # new evidence, and none at all
    assert got[10].phone_source == "osm" and got[11].website_source == "fsq"
