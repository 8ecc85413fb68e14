"""Readiness, reviews, providers, projections and source readers over the provided tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.functions import hours
from cairn.operators import discovery, materialize, providers, readiness, resolution, resolve, review, snapshot
from cairn.plans.fields import pick, sql_list, sql_pick
from cairn.plans.registry import Registry
from cairn.plans.relational import ORDERS_AS_OF, as_of
from cairn.sources import licences, pages, places
from cairn.sources.tables import table
from cairn.streaming import queue

R = Registry()
_AT = f"TIMESTAMP '{ORDERS_AS_OF}'"


def K() -> Column:
    return F.col("o_orderkey")


def C() -> Column:
    return F.col("o_custkey")


def S() -> Column:
    return F.col("s_suppkey")


def _at(column: str = "o_orderdate") -> Column:
    return F.col(column).cast("timestamp")


def _days(n) -> Column:
    return F.make_dt_interval(n if isinstance(n, Column) else F.lit(n))


def _orders(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    return table(spark, d, "orders", "o_orderkey", *columns)


# --- readiness ---------------------------------------------------------------

_ENTITIES = """
WITH e AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 3 = 0 THEN 'published' ELSE 'draft' END AS publication_state, CASE WHEN o_orderstatus = 'O' THEN 'open' ELSE 'closed' END AS status,
  CASE WHEN o_custkey % 7 <> 0 THEN o_orderdate + INTERVAL 1500 DAY END AS expires, CASE WHEN o_custkey % 5 <> 0 THEN 'v2' ELSE 'v1' END AS version, CASE WHEN o_custkey % 2 = 0 THEN 'r1' END AS release FROM orders)"""


def _entities(spark: SparkSession, d: str) -> DataFrame:
    return _orders(spark, d, "o_custkey", "o_orderstatus", "o_orderdate").select(
        K().alias("id"), F.when(K() % 3 == 0, "published").otherwise("draft").alias("publication_state"),
        F.when(F.col("o_orderstatus") == "O", "open").otherwise("closed").alias("status"), F.when(C() % 7 != 0, _at() + _days(1500)).alias("verification_expires_at"),
        F.when(C() % 5 != 0, "v2").otherwise("v1").alias("verification_version"), F.when(C() % 2 == 0, "r1").alias("expansion_release_id"))


@R.query(_ENTITIES + f"""
SELECT count(*) FILTER (WHERE publication_state = 'published' AND status = 'open') AS live,
  count(*) FILTER (WHERE publication_state = 'published' AND (expires IS NULL OR expires <= {_AT})) AS expired,
  count(*) FILTER (WHERE publication_state = 'published' AND version IS DISTINCT FROM 'v2') AS stale, count(*) FILTER (WHERE publication_state = 'published' AND release = 'r1') AS released FROM e""")
def publication_counts(spark: SparkSession, d: str) -> DataFrame:
    return readiness.publication_counts(_entities(spark, d), "v2", "r1", as_of(ORDERS_AS_OF))


@R.query(_ENTITIES + f""",
c AS (SELECT count(*) FILTER (WHERE publication_state = 'published' AND (expires IS NULL OR expires <= {_AT})) AS expired,
  count(*) FILTER (WHERE publication_state = 'published' AND version IS DISTINCT FROM 'v2') AS stale, count(*) FILTER (WHERE publication_state = 'published' AND release = 'r1') AS released FROM e),
w AS (SELECT count(DISTINCT date_trunc('week', o_orderdate)) AS weeks, max(o_orderdate) AS latest FROM orders WHERE o_orderstatus = 'F' AND o_custkey % 4 = 0 AND o_orderdate >= {_AT} - INTERVAL 2000 DAY)
SELECT 0 = 1 AS ready, 'authorization_expired' || CASE WHEN expired > 0 THEN ',published_verification_expired' ELSE '' END || CASE WHEN stale > 0 THEN ',published_decision_version_stale' ELSE '' END
  || CASE WHEN weeks < 4 THEN ',insufficient_healthy_refresh_weeks' ELSE '' END || CASE WHEN latest < {_AT} - INTERVAL 24 HOUR THEN ',latest_refresh_stale' ELSE '' END || ',source_stale:fsq,source_stale:osm' || CASE WHEN released >= 100 THEN ',release_capacity_exhausted' ELSE '' END AS blockers,
  greatest(100 - released, 0) AS available_slots FROM c, w""")
def release_readiness(spark: SparkSession, d: str) -> DataFrame:
    now = as_of(ORDERS_AS_OF)
    runs = _orders(spark, d, "o_custkey", "o_orderstatus", "o_orderdate").select(
        F.lit("catalog_refresh").alias("run_type"), F.when(F.col("o_orderstatus") == "F", "succeeded").otherwise("failed").alias("state"), F.lit(0).alias("dead_count"),
        F.when(C() % 4 == 0, 10).otherwise(1).alias("job_count"), F.lit("v2").alias("decision_version"), _at().alias("finished_at"))
    counts = readiness.publication_counts(_entities(spark, d), "v2", "r1", now)
    weeks = readiness.healthy_weeks(runs, F.lit(10), "v2", now, 2000)
    event = spark.range(1).select(F.lit("approved").alias("event_type"), as_of("1999-01-01 00:00:00").alias("effective_at"), as_of("1999-12-31 00:00:00").alias("expires_at"),
                                  F.lit(100).alias("maximum_new_publications"))
    stale = spark.createDataFrame([("osm",), ("fsq",)], "source string")
    found = readiness.release_state(counts, weeks, event, stale, 4, 24, now)
    return found.select("ready", F.array_join("blockers", ",").alias("blockers"), F.col("available_slots").cast("long").alias("available_slots"))


@R.query(f"""
WITH c AS (SELECT *, CASE WHEN o_orderkey % 3 = 0 THEN 'published' WHEN o_orderkey % 3 = 1 THEN 'verified' ELSE 'rejected' END AS s, {sql_pick('o_custkey', 'bar', 'brewery', 'winery')} AS kind FROM orders)
SELECT count(*) FILTER (WHERE s <> 'rejected' AND o_custkey % 5 = 0) AS stale_decision_version,
  count(*) FILTER (WHERE s <> 'rejected' AND (o_custkey % 7 = 0 OR o_orderdate + INTERVAL 1500 DAY <= {_AT})) AS expired_verified_state,
  count(*) FILTER (WHERE s <> 'rejected' AND kind IN ('brewery', 'winery') AND o_custkey % 4 <> 0) AS automated_generic_manufacturers,
  count(*) FILTER (WHERE s <> 'rejected' AND (o_custkey % 6 = 1 OR o_custkey % 6 = 2)) AS optional_fields_missing_provenance FROM c""")
def invariant_audit(spark: SparkSession, d: str) -> DataFrame:
    rows = _orders(spark, d, "o_custkey", "o_orderdate").select(
        F.when(K() % 3 == 0, "published").when(K() % 3 == 1, "verified").otherwise("rejected").alias("candidate_state"), F.when(C() % 5 != 0, "v2").alias("decision_version"),
        F.when(C() % 7 != 0, _at() + _days(1500)).alias("verification_expires_at"), pick(C(), "bar", "brewery", "winery").alias("primary_type"),
        F.when(C() % 4 == 0, "manual").alias("verification_tier"), F.when(C() % 6 == 1, "+1").alias("phone_e164"), F.lit(" ").alias("phone_source"),
        F.when(C() % 6 == 2, "https://x").alias("website_url"), F.lit(None).cast("string").alias("website_source"))
    return readiness.invariant_audit(rows, "v2", as_of(ORDERS_AS_OF))


@R.query("""
WITH n AS (SELECT count(DISTINCT r_name) AS k, count(*) AS n, count(DISTINCT lower(n_name)) AS d FROM nation JOIN region ON n_regionkey = r_regionkey)
SELECT unnest(list_filter([CASE WHEN k <> 9 THEN 'counties' END, CASE WHEN n <> 101 THEN 'cities' END, CASE WHEN d <> n THEN 'repeated' END], lambda x: x IS NOT NULL)) AS problem FROM n""")
def city_manifest(spark: SparkSession, d: str) -> DataFrame:
    cities = table(spark, d, "nation", "n_name", "n_regionkey").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("r_name").alias("county"), F.col("n_name").alias("city"))
    return readiness.manifest_problems(cities, 9, 101)


@R.query("""
WITH f AS (SELECT c_custkey, c_custkey % 3 <> 0 AS uuid, c_custkey % 5 <> 0 AS urls, c_custkey % 7 <> 0 AS lease FROM customer)
SELECT c_custkey, array_to_string(list_filter([CASE WHEN NOT uuid THEN 'candidate_id' END, CASE WHEN NOT urls THEN 'evidence_urls' END, CASE WHEN NOT lease THEN 'lease_days' END], lambda x: x IS NOT NULL), ',') AS problems
FROM f WHERE NOT (uuid AND urls AND lease)""")
def fact_manifest(spark: SparkSession, d: str) -> DataFrame:
    key = F.col("c_custkey")
    uuid = F.concat(F.lpad(key.cast("string"), 8, "0"), F.lit("-0000-4000-8000-0123456789ab"))
    facts = table(spark, d, "customer", "c_custkey").select(
        "c_custkey", F.when(key % 3 != 0, uuid).otherwise("x").alias("candidate_id"), F.array(F.when(key % 5 != 0, "https://a").otherwise("http://a")).alias("evidence_urls"),
        F.when(key % 7 != 0, 30).otherwise(366).alias("lease_days"), F.lit("ok").alias("note"))
    return readiness.fact_problems(facts).select("c_custkey", F.array_join("problems", ",").alias("problems"))


@R.query(f"""
SELECT o_orderkey, {sql_pick('o_orderkey', 'a', 'b')} = {sql_pick('o_custkey', 'a', 'b')} AS same_cities, CASE WHEN o_custkey % 2 = 0 THEN 'x,release_capacity_exhausted' ELSE 'x' END AS shown,
  CASE WHEN o_custkey % 2 = 0 THEN greatest(5 - o_orderkey % 9, 0) ELSE 0 END AS slots, CASE WHEN o_orderkey % 2 = 0 THEN 'complete_required_snapshots' WHEN o_orderkey % 3 = 0 THEN 'sweep_expired'
  WHEN o_orderkey % 5 = 0 THEN 'remove_unsafe_rows' WHEN o_orderkey % 7 = 0 THEN 'quarantine_legacy_rows' WHEN o_orderkey % 11 = 0 THEN 'restore_detail_routing' WHEN o_orderkey % 13 = 0 THEN 'keep_candidates_private'
  WHEN o_orderkey % 17 = 0 THEN 'review_identity_conflicts' WHEN o_orderkey % 19 = 0 THEN 'retry_provider_errors' ELSE 'none' END AS next FROM orders""")
def dashboard_rules(spark: SparkSession, d: str) -> DataFrame:
    cities = lambda c, *names: F.array(F.upper(pick(c, *names)), F.lit("z"))
    is0 = lambda n: (K() % n == 0).cast("int")
    action = readiness.next_action(K() % 2 != 0, is0(3), is0(5), is0(7), F.when(K() % 11 == 0, 0).otherwise(1), F.lit(1), is0(13), is0(17), is0(19))
    return _orders(spark, d, "o_custkey").select(
        "o_orderkey", readiness.same_scope(cities(K(), "a", "b"), F.array(F.lit("Z"), pick(C(), "a", "b"))).alias("same_cities"),
        F.array_join(readiness.shown_blockers(F.array(F.lit("x"), F.lit("release_capacity_exhausted")), C() % 2 == 0), ",").alias("shown"),
        readiness.available_slots(C() % 2 == 0, F.lit(5), K() % 9).cast("long").alias("slots"), action.alias("next"))


# --- reviews -----------------------------------------------------------------


@R.query("""
SELECT o_orderkey, CASE WHEN o_custkey % 2 = 0 AND 0.9 + (o_orderkey % 10) / 100.0 >= 0.96 THEN 'keep' WHEN o_orderkey % 3 = 0 AND o_custkey % 5 = 0 THEN 'reviewed' ELSE 'review' END AS outcome,
  CASE WHEN o_custkey % 2 = 0 AND 0.9 + (o_orderkey % 10) / 100.0 >= 0.96 THEN CAST(0.9 + (o_orderkey % 10) / 100.0 AS DOUBLE) WHEN o_orderkey % 3 = 0 AND o_custkey % 5 = 0 THEN 0.99::DOUBLE END AS identity_confidence FROM orders""")
def link_revalidation(spark: SparkSession, d: str) -> DataFrame:
    rows = _orders(spark, d, "o_custkey")
    links = rows.select("o_orderkey", F.when(C() % 2 == 0, "match").otherwise("review").alias("action"), F.round(0.9 + (K() % 10) / 100, 2).alias("score"), (C() % 5).alias("evidence_hash"))
    accepted = rows.where(K() % 3 == 0).select("o_orderkey", F.lit(0).cast("long").alias("evidence_hash"))
    return review.revalidate(links, accepted, ["o_orderkey"]).select("o_orderkey", "outcome", "identity_confidence")


@R.query("""
WITH f AS (SELECT o_custkey, o_orderkey % 4 AS h, max((o_totalprice, o_orderkey)) AS m FROM orders GROUP BY 1, 2),
g AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY m DESC) AS k FROM f WHERE NOT (o_custkey % 2 = 0 AND h = 1))
SELECT o_custkey, h AS evidence_hash FROM g WHERE k = 1""")
def review_queue(spark: SparkSession, d: str) -> DataFrame:
    found = _orders(spark, d, "o_custkey", "o_totalprice").select(
        "o_custkey", (K() % 4).alias("evidence_hash"), F.struct("o_totalprice", "o_orderkey").alias("score"), F.lit("name").alias("reason"))
    settled = found.where(C() % 2 == 0).select("o_custkey", F.lit(1).cast("long").alias("evidence_hash"), F.lit("resolved").alias("state")).distinct()
    return review.enqueue(found, settled, ["o_custkey"]).select("o_custkey", "evidence_hash")


@R.query("""
WITH r AS (SELECT o_orderkey, CASE WHEN o_custkey % 3 = 0 THEN 'resolved' ELSE 'pending' END AS state, o_custkey % 3 <> 0 AND o_orderkey % 2 = 0 AND o_custkey % 5 <> 0 AND o_custkey % 7 <> 0 AS applies FROM orders)
SELECT o_orderkey, CASE WHEN applies THEN 'resolved' ELSE state END AS state, CASE WHEN applies THEN 'same_place' END AS resolution, CASE WHEN applies THEN 'reviewer' END AS reviewer FROM r""")
def review_resolutions(spark: SparkSession, d: str) -> DataFrame:
    rows = _orders(spark, d, "o_custkey")
    reviews = rows.select("o_orderkey", F.lit("h").alias("evidence_hash"), F.when(C() % 3 == 0, "resolved").otherwise("pending").alias("state"))
    done = rows.where(K() % 2 == 0).select("o_orderkey", F.lit("h").alias("evidence_hash"), F.when(C() % 5 != 0, "same_place").otherwise("maybe").alias("resolution"), F.lit("n").alias("note"),
                                         F.when(C() % 7 != 0, "reviewer").otherwise("me").alias("reviewer"))
    return review.resolve(reviews, done, ["o_orderkey"]).select("o_orderkey", "state", "resolution", "reviewer")


@R.query("""
SELECT DISTINCT c_custkey FROM customer JOIN orders ON o_custkey = c_custkey WHERE o_orderstatus = 'O' AND o_orderkey % 2 = 0 AND o_orderkey % 3 <> 2""")
def blocking_reviews(spark: SparkSession, d: str) -> DataFrame:
    reviews = _orders(spark, d, "o_custkey", "o_orderstatus").select(
        C().alias("c_custkey"), F.when(F.col("o_orderstatus") == "O", "pending").otherwise("resolved").alias("state"), (K() % 2 == 0).alias("exact_address"),
        pick(K(), "a:same_location_name_conflict", "probable_identity_needs_review", "other").alias("reason"))
    return review.blocking(table(spark, d, "customer", "c_custkey"), reviews, "c_custkey")


@R.query(f"""
SELECT o_orderkey, o_orderkey % 4 = 1 AS conflict, strftime({_AT} + INTERVAL (least(o_custkey % 200, 60)) DAY, '%Y-%m-%d') AS expires FROM orders WHERE o_orderkey % 4 <> 0""")
def manual_observations(spark: SparkSession, d: str) -> DataFrame:
    observed = _orders(spark, d, "o_custkey").select(K().alias("idempotency_key"), "o_orderkey", C().alias("entity"), F.lit("name").alias("field_name"), F.lit("v").alias("value_text"),
                                                     (C() % 200).cast("int").alias("lease_days"))
    before = observed.where("o_orderkey % 4 < 2").withColumn("value_text", F.when(K() % 4 == 0, "v").otherwise("w"))
    empty = observed.limit(0).select("idempotency_key", F.lit("").alias("value_hash"))
    known = review.manual_observations(empty, before, as_of(ORDERS_AS_OF), 60).select("idempotency_key", "value_hash")
    return review.manual_observations(known, observed, as_of(ORDERS_AS_OF), 60).select("o_orderkey", "conflict", F.date_format("expires_at", "yyyy-MM-dd").alias("expires"))


@R.query(f"""
SELECT o_orderkey, strftime({_AT} + INTERVAL (CASE WHEN o_orderkey % 3 = 0 THEN 180 ELSE 90 END) DAY, '%Y-%m-%d') AS expires FROM orders WHERE o_custkey % 4 <> 3 AND (o_orderkey % 3 <> 0 OR o_custkey % 2 = 0)""")
def reviewable_contributions(spark: SparkSession, d: str) -> DataFrame:
    rows = _orders(spark, d, "o_custkey").select("o_orderkey", C().alias("user_id"), K().alias("entity"), F.when(K() % 3 == 0, "merchant").otherwise("user").alias("kind"), (C() % 4).alias("terms_version"))
    terms = spark.createDataFrame([(0, "active", "1990-01-01"), (1, "active", "1990-01-01"), (2, "active", "1990-01-01"), (3, "active", "2030-01-01"), (3, "retired", "1990-01-01")],
                                  "version long, state string, day string").withColumn("effective_from", F.col("day").cast("timestamp"))
    claims = rows.select("user_id", "entity", F.when(F.col("user_id") % 2 == 0, "verified").otherwise("pending").alias("state"))
    return review.contributions(rows, terms, claims, as_of(ORDERS_AS_OF)).select("o_orderkey", F.date_format("expires_at", "yyyy-MM-dd").alias("expires"))


@R.query("""
WITH r AS (SELECT *, o_orderkey % 3 AS a, o_custkey % 3 AS b FROM orders)
SELECT o_orderkey, a = 0 AND (b = 0 OR (b = 1 AND o_custkey % 2 = 0)) AS valid, o_custkey % 4 <> 0 AND a <= b AS covered, CASE WHEN a = 0 THEN 'type_conflict:x' ELSE 'x' END AS reason,
  CAST(round(least(0.99, 0.9 * 0.95 * (0.7 + 0.3 * b / 3.0)), 9) AS DOUBLE) AS confidence, CAST(CASE WHEN b = 0 THEN 0.7 ELSE least(0.995, 0.8 + least(0.06, 0.03 * greatest(0, a - 1))) END AS DOUBLE) AS type_confidence,
  a <> 0 OR b = 2 AS corroborated FROM r""")
def review_rules(spark: SparkSession, d: str) -> DataFrame:
    a, b = K() % 3, C() % 3
    state = lambda c: pick(c, "pending", "resolved", "void")
    upto = lambda n: F.sequence(F.lit(0).cast("long"), n)
    current = F.when(C() % 4 != 0, upto(a)).otherwise(F.array().cast("array<bigint>"))
    return _orders(spark, d, "o_custkey").select(
        "o_orderkey", review.valid_transition(state(a), state(b), C() % 2 == 0).alias("valid"), review.covered_by_review(current, upto(b)).alias("covered"),
        review.review_reason(a != 0, F.lit("x")).alias("reason"), F.round(resolve.review_confidence(F.lit(0.9), F.lit(0.95), b / 3), 9).alias("confidence"),
        F.round(resolve.type_confidence(b, F.lit(0.8), a, F.lit(0.9)), 9).alias("type_confidence"),
        resolve.corroborated(pick(a, "phone_e164", "hours", "name"), F.lit("fsq"), b).alias("corroborated"))


# --- providers ---------------------------------------------------------------

_CANDIDATES = f"""
WITH c AS (SELECT p_partkey, p_size, p_brand, CASE WHEN p_partkey % 29 = 0 THEN 'short' ELSE 'provider-' || p_partkey END AS id, p_partkey % 13 = 0 AS closed, CASE WHEN p_partkey % 11 <> 0 THEN p_size * 2.5 END AS meters,
  {sql_pick('p_partkey', '1', '0.86', '0.5')}::DOUBLE AS name, {sql_pick('(p_partkey // 3)', '0.97', '0.88', '0.2')}::DOUBLE AS address, p_partkey % 7 = 0 AS phone, p_partkey % 5 <> 0 AS category FROM part),
r AS (SELECT *, CASE WHEN id = 'short' THEN 'invalid_identity' WHEN closed THEN 'closed' WHEN meters IS NULL THEN 'missing_coordinates' WHEN meters > 100 THEN 'location_mismatch'
  WHEN NOT ((name >= 0.90 AND meters <= 75) OR (p_partkey % 2 = 0 AND (address >= 0.86 OR phone))) THEN 'name_mismatch' WHEN NOT category THEN 'type_mismatch' END AS rejection,
  CAST(CASE WHEN phone THEN 0.995 WHEN address >= 0.96 AND meters <= 50 THEN 0.99 WHEN name >= 0.90 AND meters <= 50 THEN 0.98 ELSE 0.97 END AS DOUBLE) AS confidence FROM c)"""


def _candidates(spark: SparkSession, d: str) -> DataFrame:
    p, size = F.col("p_partkey"), F.col("p_size")
    identity = F.when(p % 29 == 0, "short").otherwise(F.concat(F.lit("provider-"), p.cast("string")))
    meters = F.when(p % 11 != 0, size * 2.5)
    name, address = pick(p, "1", "0.86", "0.5").cast("double"), pick(F.floor(p / 3), "0.97", "0.88", "0.2").cast("double")
    shown = F.when(p % 2 == 0, "Red Fox").otherwise("Blue Owl")
    rejection = providers.candidate_rejection(identity, p % 13 == 0, meters, F.lit("The Red Fox"), shown, name, address, p % 7 == 0, p % 5 != 0)
    return table(spark, d, "part", "p_partkey", "p_size", "p_brand").select(
        "p_partkey", "p_brand", identity.alias("id"), rejection.alias("rejection"), providers.candidate_confidence(meters, name, address, p % 7 == 0).alias("confidence"))


@R.query(_CANDIDATES + " SELECT p_partkey, rejection, confidence FROM r")
def provider_candidates(spark: SparkSession, d: str) -> DataFrame:
    return _candidates(spark, d).select("p_partkey", "rejection", "confidence")


@R.query(_CANDIDATES + f""",
g AS (SELECT p_partkey // 4 AS entity, count(*) FILTER (WHERE rejection IS NULL) AS valid, list(DISTINCT rejection) FILTER (WHERE rejection IS NOT NULL) AS reasons,
  max(id) FILTER (WHERE rejection IS NULL) AS one FROM r GROUP BY 1)
SELECT entity, CASE WHEN valid = 1 THEN 'matched' WHEN valid > 1 THEN 'ambiguous' ELSE coalesce(list_filter({sql_list(*providers.REJECTION_PRIORITY)}, lambda x: list_contains(reasons, x))[1], 'not_found') END AS outcome,
  CASE WHEN valid = 1 THEN one END AS id FROM g""")
def provider_selection(spark: SparkSession, d: str) -> DataFrame:
    rows = _candidates(spark, d).withColumn("entity", F.floor(F.col("p_partkey") / 4))
    return providers.select_matches(rows, "entity", "rejection", "id", "confidence").select("entity", "outcome", "id")


@R.query(f"""
WITH p AS (SELECT p_partkey, p_size, CASE WHEN p_size % 6 = 0 THEN NULL ELSE p_size % 6 END AS veracity FROM part)
SELECT p_partkey, CASE WHEN p_partkey % 17 = 0 THEN 'identity_mismatch' WHEN veracity IS NULL OR veracity < 4 THEN 'low_veracity' WHEN p_partkey % 5 = 0 THEN 'closed' WHEN p_partkey % 7 = 0 THEN 'provider_warning'
  WHEN p_partkey % 11 = 0 THEN 'missing_coordinates' WHEN p_size * 3 > 100 THEN 'location_mismatch' WHEN p_partkey % 2 = 0 THEN 'name_mismatch' WHEN p_partkey % 3 = 0 THEN 'type_mismatch' END AS rejection,
  CASE WHEN p_partkey % 2 = 0 THEN '+14155550199' END AS phone_e164, CASE WHEN p_partkey % 4 <> 0 THEN 'https://a.example' END AS website_url, CASE WHEN p_size BETWEEN 1 AND 4 THEN CAST(p_size AS BIGINT) END AS price_level,
  CASE WHEN p_partkey % 3 = 0 THEN 'rooftop' ELSE '' END AS settings, p_partkey % 2 <> 0 AS missing_phone FROM p""")
def live_places(spark: SparkSession, d: str) -> DataFrame:
    p, size = F.col("p_partkey"), F.col("p_size")
    rejection = providers.place_rejection(
        F.when(p % 17 == 0, "other").otherwise("id"), F.lit("id"), F.when(size % 6 != 0, size % 6), F.when(p % 5 == 0, "2020-01-01"),
        F.when(p % 7 == 0, F.array(F.lit("delete"))).otherwise(F.array(F.lit("new"))), F.when(p % 11 != 0, size * 3), F.lit("Red Fox Inn"),
        F.when(p % 2 == 0, "Red Fox Tavern").otherwise("The Red Fox"), p % 3 != 0)
    asked = {"phone": F.lit(True), "website": p % 4 != 0, "price": F.lit(True), "settings": p % 3 == 0}
    fields = providers.live_projection(asked, F.when(p % 2 == 0, "(415) 555-0199").otherwise("12"), F.lit("https://a.example"), size.cast("string"), F.array(F.lit("rooftop")))
    rows = table(spark, d, "part", "p_partkey", "p_size").select("p_partkey", rejection.alias("rejection"), *fields)
    missing = providers.missing_fields({"phone": F.lit(True)}, {"phone": F.col("phone_e164")})[0].alias("missing_phone")
    return rows.select("p_partkey", "rejection", "phone_e164", "website_url", F.col("price_level").cast("long").alias("price_level"), F.array_join("setting_slugs", ",").alias("settings"), missing)


_CODES = (*providers.COOLDOWN_SECONDS, "other")
_LINKS = f"""
WITH l AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 3 <> 0 THEN 'p' || c_custkey END AS provider_id, CASE WHEN c_custkey % 4 <> 0 THEN {_AT} - INTERVAL (c_custkey % 30) DAY END AS attempted_at,
  CASE WHEN c_custkey % 5 = 0 THEN {_AT} + INTERVAL (c_custkey % 7 - 3) DAY END AS retry_after, CASE WHEN c_custkey % 6 = 0 THEN {_AT} + INTERVAL (c_custkey % 5 - 2) HOUR END AS lease_until FROM customer)"""


def _links(spark: SparkSession, d: str) -> DataFrame:
    key, now = F.col("c_custkey"), as_of(ORDERS_AS_OF)
    return table(spark, d, "customer", "c_custkey").select(
        key.alias("id"), F.when(key % 3 != 0, F.concat(F.lit("p"), key.cast("string"))).alias("provider_id"), F.when(key % 4 != 0, now - _days((key % 30).cast("int"))).alias("attempted_at"),
        F.when(key % 5 == 0, now + _days((key % 7 - 3).cast("int"))).alias("retry_after"),
        F.when(key % 6 == 0, now + F.make_dt_interval(hours=(key % 5 - 2).cast("int"))).alias("lease_until"), F.concat(F.lit("f"), (key % 9).cast("string")).alias("fingerprint"))


@R.query(_LINKS + f"""
SELECT id FROM l WHERE (lease_until IS NULL OR lease_until <= {_AT}) AND (retry_after IS NULL OR retry_after <= {_AT})
ORDER BY provider_id IS NOT NULL, attempted_at NULLS FIRST, retry_after NULLS FIRST, id LIMIT 40""")
def provider_due(spark: SparkSession, d: str) -> DataFrame:
    return providers.due(_links(spark, d), as_of(ORDERS_AS_OF), 40).select("id")


@R.query(_LINKS + f""",
o AS (SELECT *, id % 2 = 0 AND id % 9 < 8 AS valid, id % 10 = 0 AS error, {sql_pick('(id // 10)', *_CODES)} AS code FROM l)
SELECT id, CASE WHEN valid AND NOT error THEN 'new' ELSE provider_id END AS provider_id, strftime(CASE WHEN valid THEN {_AT} ELSE attempted_at END, '%Y-%m-%d') AS attempted,
  strftime(CASE WHEN valid THEN CASE WHEN error THEN {_AT} + to_seconds(CASE code WHEN 'unauthorized' THEN 3600 WHEN 'forbidden' THEN 3600 WHEN 'invalid_request' THEN 86400 WHEN 'rate_limited' THEN 900
    WHEN 'invalid_payload' THEN 1800 ELSE 300 END) END ELSE retry_after END, '%Y-%m-%d %H:%M:%S') AS retry, strftime(CASE WHEN NOT valid THEN lease_until END, '%Y-%m-%d %H') AS lease FROM o""")
def provider_sync_state(spark: SparkSession, d: str) -> DataFrame:
    links, key = _links(spark, d), F.col("id")
    outcomes = links.where(key % 2 == 0).select(
        "id", F.when(key % 10 == 0, "error").otherwise("matched").alias("outcome"), F.lit("new").alias("provider_id"), pick(F.floor(key / 10), *_CODES).alias("code"),
        F.when(key % 9 < 8, F.col("fingerprint")).otherwise("stale").alias("fingerprint"))
    done = providers.after_sync(links, outcomes, as_of(ORDERS_AS_OF))
    shown = lambda c, f: F.date_format(c, f)
    return done.select("id", "provider_id", shown("attempted_at", "yyyy-MM-dd").alias("attempted"), shown("retry_after", "yyyy-MM-dd HH:mm:ss").alias("retry"), shown("lease_until", "yyyy-MM-dd HH").alias("lease"))


@R.query("""
SELECT o_orderkey, greatest(60, least(7776000, o_orderkey * 1000)) AS clamped FROM (
  SELECT *, lag(o_orderpriority) OVER w AS was, row_number() OVER w AS n FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)) WHERE n > 1 AND was IS DISTINCT FROM o_orderpriority""")
def cache_invalidations(spark: SparkSession, d: str) -> DataFrame:
    history = _orders(spark, d, "o_custkey", "o_orderdate", "o_orderpriority").withColumn("at", F.struct("o_orderdate", "o_orderkey"))
    return providers.invalidated(history, "o_custkey", "at", "o_orderpriority").select("o_orderkey", providers.clamp_interval(K() * 1000).cast("long").alias("clamped"))


# --- projections -------------------------------------------------------------


@R.query("""
WITH d AS (SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN 'phone_e164' ELSE 'hours' END AS field, 'new' AS v, CASE s_suppkey % 3 WHEN 0 THEN 'selected' WHEN 1 THEN 'conflicted' ELSE 'insufficient' END AS status,
  CASE WHEN s_suppkey % 5 = 0 THEN 'manual' ELSE 'fsq' END AS source, s_suppkey % 4 AS n FROM supplier),
j AS (SELECT *, status = 'selected' AND (field <> 'phone_e164' OR source = 'manual' OR n >= 2) AS ok FROM d)
SELECT s_suppkey, CASE WHEN field = 'phone_e164' THEN CASE WHEN ok THEN v END ELSE 'old' END AS phone_e164, CASE WHEN field = 'hours' THEN CASE WHEN ok THEN v END ELSE 'old' END AS hours,
  CASE WHEN ok THEN 'selected' WHEN status = 'conflicted' THEN 'conflicted' ELSE 'insufficient' END AS decided, CASE WHEN n = 0 THEN 'mine' ELSE 'theirs' END AS projected,
  CASE WHEN n > 1 THEN CAST(coalesce(CASE WHEN n = 2 THEN 0.8 END, 0.95) AS DOUBLE) END AS confidence, CAST(CASE WHEN field = 'hours' THEN 0.58 ELSE 0.68 END AS DOUBLE) AS least, n = 1 AND s_suppkey % 2 = 0 AS promoted FROM j""")
def candidate_overlay(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "supplier", "s_suppkey")
    n, field = S() % 4, F.when(S() % 2 == 0, "phone_e164").otherwise("hours")
    decisions = rows.select("s_suppkey", field.alias("field"), F.lit("new").alias("selected_value"), pick(S(), "selected", "conflicted", "insufficient").alias("status"),
                            F.when(S() % 5 == 0, "manual").otherwise("fsq").alias("source"), n.alias("origin_count"))
    shown = rows.select("s_suppkey", F.lit("old").alias("phone_e164"), F.lit("old").alias("hours"))
    over = materialize.overlay_candidates(shown, decisions, "s_suppkey", ["phone_e164", "hours"])
    return over.select("s_suppkey", "phone_e164", "hours", F.coalesce("phone_e164_status", "hours_status").alias("decided"),
                       materialize.projection_overlay(n == 0, F.lit("mine"), F.lit("theirs")).alias("projected"),
                       materialize.default_confidence(F.when(n > 1, F.lit("x")), F.when(n == 2, 0.8)).alias("confidence"), materialize.minimum_score(field).alias("least"),
                       materialize.promote_anchor(F.when(n == 1, "osm").otherwise("fsq"), F.when(S() % 2 == 0, "fsq").otherwise("osm")).alias("promoted"))


@R.query("""
WITH c AS (SELECT s_suppkey, s_suppkey AS provider_id, TIMESTAMP '1999-01-01' AS m, TIMESTAMP '1999-01-01' AS v FROM supplier WHERE s_suppkey % 3 <> 0),
e AS (SELECT l_suppkey, max((l_extendedprice, l_partkey)) AS b, min(l_shipdate) AS m, max(l_shipdate) AS v FROM lineitem WHERE l_suppkey % 4 <> 0 GROUP BY 1)
SELECT coalesce(s_suppkey, l_suppkey) AS s_suppkey, coalesce(b[2], provider_id) AS provider_id, strftime(least(coalesce(c.m, e.m), coalesce(e.m, c.m)), '%Y-%m-%d') AS matched,
  strftime(greatest(coalesce(c.v, e.v), coalesce(e.v, c.v)), '%Y-%m-%d') AS validated, b IS NULL AS retired FROM c FULL JOIN e ON s_suppkey = l_suppkey""")
def provider_link_state(spark: SparkSession, d: str) -> DataFrame:
    then = as_of("1999-01-01 00:00:00")
    current = table(spark, d, "supplier", "s_suppkey").where(S() % 3 != 0).select("s_suppkey", S().alias("provider_id"), then.alias("matched_at"), then.alias("validated_at"))
    eligible = table(spark, d, "lineitem", "l_suppkey", "l_partkey", "l_extendedprice", "l_shipdate").where("l_suppkey % 4 <> 0").select(
        F.col("l_suppkey").alias("s_suppkey"), F.col("l_extendedprice").alias("confidence"), F.col("l_partkey").alias("provider_id"), _at("l_shipdate").alias("matched_at"), _at("l_shipdate").alias("validated_at"))
    return materialize.provider_links(current, eligible, ["s_suppkey"]).select(
        "s_suppkey", "provider_id", F.date_format("matched_at", "yyyy-MM-dd").alias("matched"), F.date_format("validated_at", "yyyy-MM-dd").alias("validated"), "retired")


@R.query(_ENTITIES + f"""
SELECT id, CASE WHEN publication_state = 'published' AND (expires IS NULL OR expires <= {_AT}) THEN 'suppressed' ELSE publication_state END AS publication_state,
  CASE WHEN publication_state = 'published' AND (expires IS NULL OR expires <= {_AT}) THEN 'needs_verification' ELSE 'verified' END AS candidate_state FROM e""")
def expiry_withdrawal(spark: SparkSession, d: str) -> DataFrame:
    rows = _entities(spark, d).withColumn("candidate_state", F.lit("verified"))
    return materialize.withdraw_expired(rows, as_of(ORDERS_AS_OF)).select("id", "publication_state", "candidate_state")


@R.query("""
SELECT o_orderkey AS id FROM orders WHERE o_orderstatus = 'O' ORDER BY o_orderdate, o_orderkey LIMIT 25""")
def publish_batch(spark: SparkSession, d: str) -> DataFrame:
    rows = _orders(spark, d, "o_orderstatus", "o_orderdate").select(
        K().alias("id"), F.when(F.col("o_orderstatus") == "O", "verified").otherwise("draft").alias("candidate_state"), F.col("o_orderdate").alias("verified_at"))
    return materialize.publish(rows, 40, 15, True).select("id")


@R.query("""
SELECT count(*) AS entities, count(*) FILTER (WHERE trim(c_name) <> '') AS c_name, count(*) FILTER (WHERE trim(CASE WHEN c_custkey % 3 = 0 THEN ' ' ELSE c_mktsegment END) <> '') AS segment FROM customer""")
def field_coverage(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "customer", "c_custkey", "c_name", "c_mktsegment").select("c_name", F.when(F.col("c_custkey") % 3 == 0, " ").otherwise(F.col("c_mktsegment")).alias("segment"))
    return materialize.field_coverage(rows, ["c_name", "segment"])


@R.query("""
WITH u AS (SELECT page_id % 20 AS entity, regexp_extract(url, '://([^/?#]*)', 1) AS host, url FROM pages), a AS (SELECT entity, min(host) AS host FROM u GROUP BY 1)
SELECT entity, min(url) AS url FROM u JOIN a USING (entity, host) GROUP BY 1""")
def corroborated_websites(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "pages", "page_id", "url").select((F.col("page_id") % 20).alias("entity"), F.regexp_extract("url", "://([^/?#]*)", 1).alias("host"), "url")
    agreed = rows.groupBy("entity").agg(F.min("host").alias("value"))
    return materialize.corroborated_website(rows, agreed, "entity", "host", "url")


# --- sources -----------------------------------------------------------------


@R.query("""
SELECT CAST(c_custkey AS VARCHAR) AS source_record_id, CASE WHEN c_custkey % 4 = 0 THEN c_mktsegment ELSE c_name END AS name, CASE WHEN c_custkey % 3 = 0 OR c_custkey % 5 = 0 THEN 'closed' ELSE 'open' END AS source_status,
  CASE WHEN c_custkey % 2 = 0 THEN 'brewery' END AS primary_type FROM customer""")
def registry_records(spark: SparkSession, d: str) -> DataFrame:
    key = F.col("c_custkey")
    rows = table(spark, d, "customer", "c_custkey", "c_name", "c_mktsegment").select(
        key.cast("string").alias("uniqueid"), F.lit("c").alias("certificate_number"), F.when(key % 4 == 0, " ").otherwise(F.col("c_name")).alias("dba_name"), F.col("c_mktsegment").alias("ownership_name"),
        F.lit("1 Main").alias("full_business_address"), F.lit("SF").alias("city"), F.when(key % 3 == 0, "2020-01-01").alias("location_end_date"),
        F.when(key % 5 == 0, "true").alias("administratively_closed"), F.when(key % 2 == 0, "312120").otherwise("999").alias("naics_code"))
    return places.map_registry(rows).select("source_record_id", "name", "source_status", "primary_type")


@R.query("""
SELECT 'way/' || s_suppkey AS source_record_id, s_name AS name, CASE WHEN s_suppkey % 2 = 0 THEN '7 Main' ELSE 'Main' END AS address, CASE WHEN s_suppkey % 3 = 0 THEN 1.5 ELSE 2.5 END::DOUBLE AS latitude,
  CASE WHEN s_suppkey % 5 = 0 THEN '55' END AS phone, CASE WHEN s_suppkey % 2 = 0 THEN 'outdoor' ELSE '' END AS settings FROM supplier""")
def map_element_records(spark: SparkSession, d: str) -> DataFrame:
    tags = F.map_from_entries(F.array_compact(F.array(
        F.struct(F.lit("name:en").alias("k"), F.col("s_name").alias("v")), F.struct(F.lit("addr:street").alias("k"), F.lit("Main").alias("v")),
        F.when(S() % 2 == 0, F.struct(F.lit("addr:housenumber").alias("k"), F.lit("7").alias("v"))), F.when(S() % 2 == 0, F.struct(F.lit("outdoor_seating").alias("k"), F.lit("yes").alias("v"))),
        F.when(S() % 5 == 0, F.struct(F.lit("contact:phone").alias("k"), F.lit("55").alias("v"))))))
    rows = table(spark, d, "supplier", "s_suppkey", "s_name").select(
        F.lit("way").alias("type"), S().alias("id"), F.when(S() % 3 == 0, 1.5).alias("lat"), F.lit(None).cast("double").alias("lon"),
        F.struct(F.lit(2.5).alias("lat"), F.lit(3.5).alias("lon")).alias("center"), F.lit("2024-01-01T00:00:00Z").alias("timestamp"), tags.alias("tags"))
    return places.map_elements(rows).select("source_record_id", "name", "address", "latitude", "phone", F.array_join("settings", ",").alias("settings"))


@R.query("""
WITH b AS (SELECT l_partkey AS item, l_orderkey * 10 + l_linenumber AS pos, l_discount FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY pos) = 1)
SELECT 'Q' || item AS source_record_id, 'n' || pos AS name, CASE WHEN pos % 2 = 0 THEN 37.5::DOUBLE END AS latitude, least(0.88, CAST(0.85 + l_discount AS DOUBLE)) AS confidence FROM b""")
def query_binding_records(spark: SparkSession, d: str) -> DataFrame:
    pos = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    fields = F.create_map(F.lit("item"), F.concat(F.lit("Q"), F.col("l_partkey").cast("string")), F.lit("itemLabel"), F.concat(F.lit("n"), pos.cast("string")),
                          F.lit("coord"), F.when(pos % 2 == 0, "Point(-122.0 37.5)").otherwise("none"), F.lit("confidence"), (0.85 + F.col("l_discount")).cast("string"))
    rows = table(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_discount").select(pos.alias("pos"), fields.alias("binding"))
    return places.map_bindings(rows, "pos").select("source_record_id", "name", "latitude", F.col("classification_confidence").alias("confidence"))


@R.query("""
SELECT CAST(c_custkey AS VARCHAR) AS key, CAST(c_custkey % 80 AS DOUBLE) AS latitude, CAST(-(c_custkey % 170) AS DOUBLE) AS longitude FROM customer WHERE c_custkey % 3 <> 0 AND c_custkey % 5 <> 0 AND c_custkey % 7 <> 0""")
def geocode_round_trip(spark: SparkSession, d: str) -> DataFrame:
    key = F.col("c_custkey")
    rows = table(spark, d, "customer", "c_custkey").select(
        "c_custkey", F.when(key % 7 == 0, 1.0).alias("latitude"), F.lit("1 Main, Apt 2").alias("address"), F.lit("SF").alias("city"), F.lit("CA").alias("region"), F.lit("9").alias("postal_code"))
    sent = places.geocode_requests(rows, "c_custkey").select(F.regexp_extract("value", "^([0-9]+),", 1).cast("long").alias("k"))
    k = F.col("k")
    point = F.concat((-(k % 170)).cast("string"), F.lit(","), F.when(k % 5 == 0, "x").otherwise((k % 80).cast("string")))
    line = F.concat(F.lit('"'), k.cast("string"), F.lit('","a","Match","'), F.when(k % 3 == 0, "Non_Exact").otherwise("Exact"), F.lit('","m","'), point, F.lit('"'))
    return places.parse_geocodes(sent.select(k.alias("o"), line.alias("value")), "o")


@R.query("""
SELECT o_orderkey, substr(o_orderpriority, 1, 1) AS level, nullif(trim(substr(rpad(o_orderpriority, 20, ' '), 3, 10)), '') AS word FROM orders""")
def fixed_width_fields(spark: SparkSession, d: str) -> DataFrame:
    lines = _orders(spark, d, "o_orderpriority").select(F.concat(F.lpad(K().cast("string"), 12, "0"), F.rpad("o_orderpriority", 20, " ")).alias("value"))
    cut = licences.slice_fixed_width(lines, [("o_orderkey", 1, 12), ("level", 13, 1), ("word", 15, 10)])
    return cut.select(F.col("o_orderkey").cast("long").alias("o_orderkey"), "level", "word")


@R.query("""
WITH h AS (SELECT page_id, regexp_extract_all(html || '<a href="/y/b.zip">z</a>', '(?i)href\\s*=\\s*["'']([^"'']+\\.(?:csv|zip|txt|xlsx?))["'']', 1) AS l FROM pages)
SELECT page_id, array_to_string(list_concat(list_filter(l, lambda x: contains(lower(x), 'csv')), list_filter(l, lambda x: NOT contains(lower(x), 'csv'))), ' ') AS links FROM h""")
def export_links(spark: SparkSession, d: str) -> DataFrame:
    html = F.concat("html", F.lit('<a href="/y/b.zip">z</a>'))
    return table(spark, d, "pages", "page_id", "html").select("page_id", F.array_join(licences.export_links(html), " ").alias("links"))


@R.query("""
SELECT max(strftime(o_orderdate, '%Y-%m-%d')) || '.' || max(o_custkey % 12) FILTER (WHERE o_orderdate = m) AS release FROM (SELECT *, max(CAST(o_orderdate AS DATE)) OVER () AS m FROM orders)""")
def latest_release(spark: SparkSession, d: str) -> DataFrame:
    at = F.date_format(_at(), "yyyy-MM-dd")
    index = _orders(spark, d, "o_custkey", "o_orderdate").select(F.concat(F.lit("<Prefix>release/"), at, F.lit("."), (C() % 12).cast("string"), F.lit("/</Prefix>")).alias("value"))
    return places.latest_release(index)


# --- snapshots and the queue -------------------------------------------------


@R.query("""
SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 1.0 WHEN o_custkey % 3 <> 0 THEN 2.0 END::DOUBLE AS latitude FROM orders""")
def geocode_carry_over(spark: SparkSession, d: str) -> DataFrame:
    point = snapshot.carry_point(F.when(K() % 2 == 0, 1.0), F.when(K() % 2 == 0, 1.0), F.lit(2.0), F.lit(2.0), C() % 3 == 0)
    return _orders(spark, d, "o_custkey").select("o_orderkey", point["lat"].alias("latitude"))


@R.query(f"""
SELECT o_orderkey FROM orders WHERE o_custkey % 4 = 0 OR o_orderdate <= TIMESTAMP '1996-01-01 00:00:00'""")
def expired_leases(spark: SparkSession, d: str) -> DataFrame:
    rows = _orders(spark, d, "o_custkey", "o_orderdate").select("o_orderkey", F.when(C() % 4 != 0, _at()).alias("expires"))
    return queue.expired(rows, "expires", as_of("1996-01-01 00:00:00")).select("o_orderkey")


@R.query("""
WITH o AS (SELECT * FROM orders WHERE o_orderkey % 3 <> 0), n AS (SELECT o_orderkey, CASE WHEN o_custkey % 2 = 0 THEN 'X' ELSE o_orderstatus END AS s, CASE WHEN o_custkey % 5 = 0 THEN NULL ELSE o_orderpriority END AS p FROM orders)
SELECT o_orderkey, array_to_string(list_filter([CASE WHEN o_orderstatus IS DISTINCT FROM s THEN 'o_orderstatus' END, CASE WHEN o_orderpriority IS DISTINCT FROM p THEN 'o_orderpriority' END], lambda x: x IS NOT NULL), ',') AS changed
FROM o JOIN n USING (o_orderkey) WHERE o_orderstatus IS DISTINCT FROM s OR o_orderpriority IS DISTINCT FROM p""")
def changed_columns(spark: SparkSession, d: str) -> DataFrame:
    rows = _orders(spark, d, "o_custkey", "o_orderstatus", "o_orderpriority")
    new = rows.select("o_orderkey", F.when(C() % 2 == 0, "X").otherwise(F.col("o_orderstatus")).alias("o_orderstatus"), F.when(C() % 5 != 0, F.col("o_orderpriority")).alias("o_orderpriority"))
    found = snapshot.changed_columns(rows.where(K() % 3 != 0), new, ["o_orderkey"], ["o_orderstatus", "o_orderpriority"])
    return found.select("o_orderkey", F.array_join("changed", ",").alias("changed"))


# --- discovery ---------------------------------------------------------------

_PAIRS = """
WITH RECURSIVE a AS (SELECT p_partkey AS id, row_number() OVER (ORDER BY p_size DESC, p_partkey) AS i FROM part),
raw AS (SELECT id AS anchor_id, i, unnest([0, 1, 2, 3]) AS j FROM a),
pairs AS (SELECT anchor_id, i, j, (anchor_id * 7 + j * j * 31) % (SELECT count(*) FROM part) AS record_id, CASE WHEN j < 2 THEN 'osm' WHEN j = 2 THEN 'ca_abc' ELSE 'overture' END AS source,
  CASE WHEN (anchor_id + j) % 9 = 0 THEN 'review' WHEN (anchor_id + j) % 7 = 0 THEN 'distinct' ELSE 'match' END AS action, (anchor_id + j) % 11 <> 0 AS compatible,
  ((anchor_id * 13 + j * 5) % 8 + 40) / 50.0 AS score FROM raw),
m AS (SELECT *, action = 'match' AND compatible AS m FROM pairs),
k AS (SELECT *, row_number() OVER w AS k, lead(score) OVER w AS next FROM m WINDOW w AS (PARTITION BY anchor_id, source, m ORDER BY score DESC, record_id)),
c AS (SELECT *, m AND (source = 'ca_abc' OR (k = 1 AND (next IS NULL OR score - next >= 0.03::DOUBLE))) AS chosen FROM k),
s AS (SELECT a.id, a.i, list(record_id) FILTER (WHERE chosen AND record_id <> a.id) AS sel FROM a LEFT JOIN c ON c.anchor_id = a.id GROUP BY 1, 2),
step AS (SELECT 0::BIGINT AS i, NULL::BIGINT AS id, false AS active, []::BIGINT[] AS claimed UNION ALL
  SELECT s.i, s.id, NOT list_contains(claimed, s.id), CASE WHEN list_contains(claimed, s.id) THEN claimed ELSE list_distinct(list_concat(claimed, [s.id], coalesce(s.sel, []))) END FROM step JOIN s ON s.i = step.i + 1),
offered AS (SELECT st.id AS candidate_id, st.i, c.record_id, c.score FROM step st JOIN c ON c.anchor_id = st.id WHERE active AND chosen UNION ALL SELECT id, i, id, 1.0 FROM step WHERE active)"""


@R.query(_PAIRS + """,
firsts AS (SELECT record_id, min_by(candidate_id, i) AS owner FROM offered GROUP BY 1)
SELECT candidate_id, record_id, CASE WHEN owner = candidate_id THEN 'linked' ELSE 'taken' END AS outcome, score FROM offered JOIN firsts USING (record_id) UNION ALL
SELECT anchor_id, record_id, 'review', score FROM c JOIN step st ON st.id = anchor_id AND active WHERE NOT chosen AND (action = 'review' OR (action = 'match' AND compatible))""")
def discovery_links(spark: SparkSession, d: str) -> DataFrame:
    key = F.col("p_partkey")
    parts = table(spark, d, "part", "p_partkey", "p_size")
    everything = parts.count()
    anchors = parts.select(key.alias("id"), F.struct(-F.col("p_size"), "p_partkey").alias("rank"))
    a, j = F.col("anchor_id"), F.col("j")
    raw = parts.select(key.alias("anchor_id"), F.explode(F.sequence(F.lit(0), F.lit(3))).alias("j"))
    pairs = raw.select(
        "anchor_id", ((a * 7 + j * j * 31) % everything).alias("record_id"), F.when(j < 2, "osm").when(j == 2, "ca_abc").otherwise("overture").alias("source"),
        F.when((a + j) % 9 == 0, "review").when((a + j) % 7 == 0, "distinct").otherwise("match").alias("action"), ((a + j) % 11 != 0).alias("compatible"),
        (((a * 13 + j * 5) % 8 + 40) / 50).alias("score"), F.lit("rule").alias("reason"))
    _, links, reviews = discovery.discover(anchors, pairs)
    taken = F.when(F.col("reason") == discovery.TAKEN, "taken").otherwise("review").alias("outcome")
    return links.select("candidate_id", "record_id", F.lit("linked").alias("outcome"), "score").unionByName(reviews.select("candidate_id", "record_id", taken, "score"))


# --- leases, preferences, pages ----------------------------------------------

_LOG = """
WITH RECURSIVE e AS (SELECT user_id AS job, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i, CASE WHEN event_id % 2 = 0 THEN 'claim' ELSE ['renew', 'complete', 'fail'][event_id % 3 + 1] END AS kind,
  CAST(floor(epoch(ts)) AS BIGINT) AS at, 'w' || event_id % 2 AS worker, event_id % 5 <> 0 AS retryable, 3600 AS delay FROM events),
s AS (SELECT job, 0::BIGINT AS i, 'queued' AS state, NULL::VARCHAR AS worker, NULL::BIGINT AS until, 0 AS attempts, 0::BIGINT AS next_at FROM (SELECT DISTINCT job FROM e) UNION ALL
  SELECT s.job, e.i, CASE WHEN claim AND stale AND s.attempts >= 3 THEN 'dead' WHEN claim AND (free OR stale) THEN 'leased' WHEN held AND e.kind = 'complete' THEN 'succeeded'
      WHEN held AND e.kind = 'fail' AND (s.attempts >= 3 OR NOT e.retryable) THEN 'dead' WHEN held AND e.kind = 'fail' THEN 'queued' ELSE s.state END,
    CASE WHEN claim AND stale AND s.attempts >= 3 THEN NULL WHEN claim AND (free OR stale) THEN e.worker WHEN held AND e.kind IN ('complete', 'fail') THEN NULL ELSE s.worker END,
    CASE WHEN claim AND stale AND s.attempts >= 3 THEN NULL WHEN (claim AND (free OR stale)) OR (held AND e.kind = 'renew') THEN e.at + 86400 WHEN held AND e.kind IN ('complete', 'fail') THEN NULL ELSE s.until END,
    CASE WHEN claim AND (free OR stale) AND NOT (stale AND s.attempts >= 3) THEN s.attempts + 1 ELSE s.attempts END,
    CASE WHEN claim AND (free OR stale) THEN NULL WHEN held AND e.kind = 'fail' AND s.attempts < 3 AND e.retryable THEN e.at + e.delay ELSE s.next_at END
  FROM s JOIN e ON e.job = s.job AND e.i = s.i + 1, LATERAL (SELECT e.kind = 'claim' AS claim, s.state = 'queued' AND s.next_at <= e.at AS free, s.state = 'leased' AND s.until <= e.at AS stale,
    s.state = 'leased' AND s.until > e.at AND s.worker = e.worker AS held) AS f),
l AS (SELECT *, state = 'leased' AND until <= epoch(TIMESTAMP '2024-01-30 00:00:00') AS lost FROM s QUALIFY row_number() OVER (PARTITION BY job ORDER BY i DESC) = 1)"""


@R.query(_LOG + """
SELECT job, CASE WHEN lost AND attempts >= 3 THEN 'dead' WHEN lost THEN 'queued' ELSE state END AS state, CASE WHEN NOT lost THEN worker END AS worker, attempts, next_at FROM l""")
def lease_replay(spark: SparkSession, d: str) -> DataFrame:
    key = F.col("event_id")
    kind = F.when(key % 2 == 0, "claim").otherwise(pick(key, "renew", "complete", "fail"))
    log = table(spark, d, "events", "user_id", "ts", "event_id").select(
        F.col("user_id").alias("job"), F.col("ts").cast("timestamp").alias("t"), "event_id", kind.alias("kind"), F.unix_timestamp(F.col("ts").cast("timestamp")).alias("at"),
        F.concat(F.lit("w"), (key % 2).cast("string")).alias("worker"), (key % 5 != 0).alias("retryable"), F.lit(3600).cast("long").alias("delay"))
    first = log.select("job").distinct().select(
        "job", as_of("1970-01-01 00:00:00").alias("t"), F.lit(-1).cast("long").alias("event_id"), F.lit("enqueue").alias("kind"), F.lit(0).cast("long").alias("at"), F.lit("").alias("worker"),
        F.lit(False).alias("retryable"), F.lit(0).cast("long").alias("delay"))
    return queue.replay_leases(log.unionByName(first), "job", ["t", "event_id"], as_of("2024-01-30 00:00:00"), visibility=86400)


@R.query(f"""
WITH e AS (SELECT event_id, user_id AS entity, {sql_pick('event_id', 'neighborhood', 'hours')} AS field, CASE WHEN user_id % 3 = 0 THEN {sql_pick('(event_id // 2)', 'overture_divisions', 'fsq')}
  WHEN user_id % 3 = 1 THEN {sql_pick('(event_id // 2)', 'datasf_neighborhoods', 'overture_divisions', 'fsq')} ELSE 'fsq' END AS source FROM events),
r AS (SELECT *, CASE source WHEN 'datasf_neighborhoods' THEN 1 WHEN 'overture_divisions' THEN 2 ELSE 3 END AS k FROM e),
b AS (SELECT entity, min(k) AS b FROM r WHERE field = 'neighborhood' GROUP BY 1)
SELECT event_id FROM r LEFT JOIN b USING (entity) WHERE field <> 'neighborhood' OR k = b""")
def neighborhood_preference(spark: SparkSession, d: str) -> DataFrame:
    key, user, half = F.col("event_id"), F.col("user_id"), F.floor(F.col("event_id") / 2)
    source = F.when(user % 3 == 0, pick(half, "overture_divisions", "fsq")).when(user % 3 == 1, pick(half, "datasf_neighborhoods", "overture_divisions", "fsq")).otherwise("fsq")
    rows = table(spark, d, "events", "event_id", "user_id").select("event_id", user.alias("entity"), pick(key, "neighborhood", "hours").alias("field"), source.alias("source"))
    return resolve.preferred_evidence(rows).select("event_id")


# --- record resolution -------------------------------------------------------

_KINDS = ("bar", "pub", "brewery", "taproom", None)


def _record_sql(k: str) -> str:
    return f"""{{'status': {sql_pick(k, 'open', 'open', 'closed', 'unknown')}, 'kind': {sql_pick(f'({k} // 4)', *_KINDS)}, 'consumer': {k} % 3 <> 0,
    'lat': CASE WHEN {k} % 7 <> 0 THEN {k} * 1.0::DOUBLE END, 'phone': {sql_pick(k, '', '+1', None)}, 'conf': ({k} % 11) / 10.0, 'dup': {k} % 13 = 0}}"""


def _record(k: Column) -> Column:
    flags = F.when(k % 13 == 0, F.array(F.lit("duplicate"))).otherwise(F.array().cast("array<string>"))
    return F.struct(
        F.lit("fsq").alias("source"), pick(k, "open", "open", "closed", "unknown").alias("source_status"), pick(F.floor(k / 4), *_KINDS).alias("primary_type"),
        (k % 3 != 0).alias("consumer_facing"), F.when(k % 7 != 0, k * 1.0).alias("latitude"), F.lit(1.0).alias("longitude"), pick(k, "", "+1", None).alias("phone"),
        F.lit(None).cast("string").alias("website_url"), ((k % 11) / 10).alias("classification_confidence"), F.lit("consumer_poi").alias("source_family"),
        F.lit("walk_in").alias("public_access"), flags.alias("quality_flags"))


@R.query(f"""
WITH r AS (SELECT p_partkey, {_record_sql('p_partkey')} AS a, CASE WHEN p_partkey % 2 = 0 THEN {_record_sql('(p_partkey + 5)')} END AS b, {sql_pick('(p_partkey // 3)', 'auto_match', 'review', 'distinct', 'distinct', 'distinct')} AS action FROM part),
k AS (SELECT *, list_contains({sql_list('bar', 'pub')}, coalesce(a.kind, '')) AND list_contains({sql_list('bar', 'pub')}, coalesce(b.kind, '')) AS bars FROM r),
t AS (SELECT *, CASE WHEN b IS NULL THEN NULL WHEN a.kind IS NOT DISTINCT FROM b.kind THEN a.kind WHEN a.kind IS NULL THEN b.kind WHEN b.kind IS NULL THEN a.kind WHEN bars AND a.consumer AND a.kind <> 'bar' THEN a.kind
  WHEN bars AND b.consumer AND b.kind <> 'bar' THEN b.kind WHEN bars THEN 'bar' WHEN list_sort([a.kind, b.kind]) = ['brewery', 'taproom'] THEN 'taproom' END AS kind,
  CASE WHEN a.consumer THEN a WHEN b.consumer THEN b END AS "lead" FROM k),
l AS (SELECT *, CASE WHEN "lead".lat IS NOT NULL THEN "lead" WHEN a.lat IS NOT NULL THEN a ELSE b END AS placed FROM t),
f AS (SELECT *, b IS NOT NULL AND NOT ((a.status = 'closed' OR b.status = 'closed') AND (a.status = 'open' OR b.status = 'open')) AND kind IS NOT NULL AND "lead" IS NOT NULL AND placed.lat IS NOT NULL AS fits,
  least(0.99::DOUBLE, 0.65::DOUBLE * greatest(a.conf, coalesce(b.conf, 0)) + 0.35::DOUBLE * 0.95::DOUBLE + CASE WHEN a.kind = b.kind THEN 0.03::DOUBLE ELSE 0 END) AS quality FROM l),
s AS (SELECT *, fits AND (a.status = 'open' OR b.status = 'open') AND kind IN ('bar', 'pub', 'taproom') AND NOT "lead".dup AND quality >= 0.85::DOUBLE AS pair,
  a.status = 'open' AND a.lat IS NOT NULL AND a.kind IN ('bar', 'pub', 'taproom') AND a.consumer AND NOT a.dup AND a.conf >= 0.85::DOUBLE AS alone FROM f)
SELECT p_partkey, CASE WHEN action = 'auto_match' THEN 'link' WHEN action = 'review' THEN 'review' WHEN b IS NOT NULL AND NOT fits THEN 'review' WHEN pair AND p_partkey % 5 = 0 THEN 'link' WHEN pair OR alone THEN 'create'
    WHEN a.conf >= 0.78 THEN 'review' ELSE 'staged' END AS state,
  CASE WHEN action <> 'distinct' THEN 'rule' WHEN b IS NOT NULL AND NOT fits THEN 'source_conflict' WHEN pair AND p_partkey % 5 = 0 THEN 'linked_source_corroboration' WHEN pair THEN 'cross_source_corroboration'
    WHEN alone THEN 'high_confidence_new' WHEN a.conf >= 0.78 THEN 'needs_type_or_location_corroboration' END AS reason,
  CASE WHEN fits THEN kind END AS combined_type, CASE WHEN fits THEN CASE WHEN a.status = 'open' OR b.status = 'open' THEN 'open' ELSE "lead".status END END AS combined_status,
  CASE WHEN fits THEN coalesce(nullif("lead".phone, ''), nullif(placed.phone, '')) END AS combined_phone FROM s""")
def record_resolution(spark: SparkSession, d: str) -> DataFrame:
    p = F.col("p_partkey")
    action = pick(F.floor(p / 3), "auto_match", "review", "distinct", "distinct", "distinct")
    rows = table(spark, d, "part", "p_partkey").select("p_partkey", action.alias("action"), _record(p).alias("a"), F.when(p % 2 == 0, _record(p + 5)).alias("b")).withColumn(
        "both", F.when(F.col("b").isNotNull(), resolution.combine(F.col("a"), F.col("b"))))
    routed = resolution.route_record(F.col("a"), F.col("action"), F.lit("rule"), F.lit(1), F.col("b"), F.col("both"), F.lit(0.95), p % 5 == 0)
    return rows.select("p_partkey", routed.alias("r"), "both").select(
        "p_partkey", "r.state", "r.reason", F.col("both.primary_type").alias("combined_type"), F.col("both.source_status").alias("combined_status"), F.col("both.phone").alias("combined_phone"))
