"""Duplicate guard, duplicates and drift among the parts as places."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.operators import audit_export as export
from cairn.operators import duplicates, manual
from cairn.plans.matching import _GRAMS, _SIMILAR
from cairn.plans.registry import Registry
from cairn.plans.relational import as_of
from cairn.sources.tables import table

R = Registry()

_PLACES = f"""
x AS (SELECT p_partkey AS id, p_brand, p_type, p_name AS name, split_part(p_name, ' ', 2) || ' street ' || (p_size // 10) AS address, p_type AS kind, 37 + p_size / 2000.0::DOUBLE AS lat,
  -122 + p_retailprice / 100000 AS lon, {_GRAMS.format(c='p_name')} AS g FROM part),
d AS (SELECT a.id AS a, b.id AS b, a.p_brand = b.p_brand AS same_brand, a.p_type AS ta, b.p_type AS tb, a.address = b.address AS same, {_SIMILAR.format(a='a.g', b='b.g')} AS s,
  2 * 6371000.0 * asin(sqrt(pow(sin(radians(b.lat - a.lat) / 2), 2) + cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin(radians(b.lon - a.lon) / 2), 2))) AS m
  FROM x a JOIN x b ON a.id <> b.id AND (a.address = b.address OR (a.lat = b.lat AND a.p_brand = b.p_brand)))"""


def _places(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part", "p_partkey", "p_brand", "p_type", "p_name", "p_size", "p_retailprice")
    address = F.concat(F.element_at(F.split("p_name", " "), 2), F.lit(" street "), F.floor(F.col("p_size") / 10).cast("string"))
    return p.select(F.col("p_partkey").alias("id"), "p_brand", "p_type", F.col("p_name").alias("name"), address.alias("address"), F.col("p_type").alias("primary_type"),
                    (37 + F.col("p_size") / 2000.0).alias("lat"), (-122 + F.col("p_retailprice") / 100000).alias("lon"), "p_size", "p_retailprice")


@R.query(f"""
WITH {_PLACES.strip()}
SELECT a AS id, min(b) AS duplicate_of FROM d WHERE ta NOT IN ('PROMO', 'LARGE') AND tb IN ('PROMO', 'LARGE') AND same AND s >= 0.95 AND m <= 25 GROUP BY 1""")
def public_duplicate_guard(spark: SparkSession, d: str) -> DataFrame:
    p = _places(spark, d)
    public = F.col("p_type").isin("PROMO", "LARGE")
    return duplicates.public_duplicates(p.where(~public), p.where(public))


@R.query(f"""
WITH {_PLACES.strip()}
SELECT a, b FROM d WHERE a < b AND same_brand AND ((same AND s >= 0.75) OR (m <= 20 AND s >= 0.92))""")
def probable_duplicates(spark: SparkSession, d: str) -> DataFrame:
    return duplicates.probable_duplicates(_places(spark, d), ["p_brand"])


@R.query("""
WITH c AS (SELECT p_partkey AS id, p_size, CAST(round(p_retailprice * 10) AS BIGINT) AS price FROM part)
SELECT id FROM c WHERE p_size = 7 OR price % 11 = 0 OR price % 13 = 0 OR price % 17 = 0""")
def anchor_drift(spark: SparkSession, d: str) -> DataFrame:
    """Anchors of some sizes are gone; others have lost their type, moved by some metres, or changed their name."""
    p, price = _places(spark, d), F.round(F.col("p_retailprice") * 10).cast("long")
    anchors = p.where("p_size <> 7").select(
        "id", "address", F.when(price % 11 != 0, F.col("primary_type")).alias("primary_type"), F.when(price % 13 == 0, F.col("lat") + 0.0001).otherwise(F.col("lat")).alias("lat"), "lon",
        F.when(price % 17 == 0, F.concat("name", F.lit(" new"))).otherwise(F.col("name")).alias("name"))
    return duplicates.anchor_drift(p, anchors)


_SOURCE = "CASE o_orderpriority WHEN '1-URGENT' THEN 'ca_abc' WHEN '2-HIGH' THEN 'osm' WHEN '3-MEDIUM' THEN 'overture' ELSE 'fsq' END"


@R.query(f"""
WITH rec AS (SELECT o_orderkey AS record_id, {_SOURCE} AS source, o_custkey, o_orderpriority AS name, o_orderstatus, o_totalprice FROM orders),
cand AS (SELECT c_custkey, c_acctbal, c_mktsegment, min(o_orderkey) AS anchor FROM customer JOIN orders ON o_custkey = c_custkey WHERE c_acctbal > 1000 GROUP BY ALL),
lic AS (SELECT o_custkey AS k, to_json(list({{'record_id': record_id, 'name': name, 'license_type': o_orderstatus, 'type_status': NULL::VARCHAR, 'identity_confidence': 0.97::DOUBLE}} ORDER BY record_id)) AS j
  FROM rec WHERE source = 'ca_abc' AND o_orderstatus <> 'P' GROUP BY 1),
src AS (SELECT o_custkey AS k, to_json(list(DISTINCT source ORDER BY source)) AS j FROM rec WHERE o_orderstatus <> 'P' GROUP BY 1),
rev AS (SELECT o_custkey AS k, count(*) AS n, to_json(list({{'review_id': record_id, 'source': source, 'name': name, 'reason': 'type_conflict:same_location_name_conflict', 'score': o_totalprice}} ORDER BY o_totalprice DESC, source, record_id)) AS j,
  count(*) FILTER (o_totalprice < 100000 AND name LIKE '%O%') AS b FROM rec WHERE o_orderstatus = 'P' GROUP BY 1)
SELECT c_custkey AS candidate_id, o.o_orderpriority AS anchor_name, 0.9::DOUBLE AS classification_confidence,
  to_json({{'phone': c_acctbal > 5000, 'website': false, 'hours': c_acctbal > 8000, 'price': c_acctbal > 2000, 'settings': c_mktsegment = 'BUILDING'}})::VARCHAR AS optional_field_coverage,
  coalesce(lic.j::VARCHAR, '[]') AS licences, coalesce(src.j::VARCHAR, '[]') AS linked_sources, coalesce(n, 0) AS pending_review_items, coalesce(rev.j::VARCHAR, '[]') AS reviews, coalesce(b, 0) AS blocking_exact_address_conflicts
FROM cand JOIN orders o ON o.o_orderkey = anchor LEFT JOIN lic ON lic.k = c_custkey LEFT JOIN src ON src.k = c_custkey LEFT JOIN rev ON rev.k = c_custkey""")
def audit_export(spark: SparkSession, d: str) -> DataFrame:
    """Customers as candidates with their first order as anchor; orders in hand are pending reviews, the others links."""
    o = table(spark, d, "orders", "o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus", "o_totalprice")
    priority = F.col("o_orderpriority")
    source = F.when(priority == "1-URGENT", "ca_abc").when(priority == "2-HIGH", "osm").when(priority == "3-MEDIUM", "overture").otherwise("fsq")
    rows = o.withColumn("source", source).withColumn("record_id", F.col("o_orderkey"))
    records = rows.select(
        "source", "record_id", priority.alias("name"), F.when(priority.contains("O"), "same").otherwise("other").alias("normalized_address"), F.col("o_orderstatus").alias("license_type"),
        F.lit(None).cast("string").alias("type_status"), F.lit("open").alias("status"), F.when(F.col("o_totalprice") >= 100000, "2024").alias("retired_at"),
        F.lit(None).cast("array<string>").alias("flags"), F.lit(0.9).alias("classification_confidence"))
    links = rows.where("o_orderstatus <> 'P'").select(F.col("o_custkey").alias("candidate_id"), "source", "record_id", F.lit(0.97).alias("identity_confidence"))
    reviews = rows.where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("candidate_id"), F.col("o_orderkey").alias("review_id"), "source", "record_id", F.lit("pending").alias("state"),
                                                      F.lit("type_conflict:same_location_name_conflict").alias("reason"), F.col("o_totalprice").alias("score"))
    first = rows.groupBy("o_custkey").agg(F.min_by(F.struct("source", "record_id"), "record_id").alias("a"))
    balance = F.col("c_acctbal")
    candidates = table(spark, d, "customer", "c_custkey", "c_acctbal", "c_mktsegment").join(first, F.col("c_custkey") == F.col("o_custkey")).select(
        F.col("c_custkey").alias("candidate_id"), F.when(balance > 5000, "published").otherwise("verified").alias("candidate_state"), F.lit("v7").alias("decision_version"),
        F.when(balance > 1000, as_of("2030-01-01 00:00:00")).otherwise(as_of("2020-01-01 00:00:00")).alias("verification_expires_at"), F.col("a.source").alias("anchor_source"),
        F.col("a.record_id").alias("anchor_record_id"), F.lit("same").alias("normalized_address"), F.when(balance > 5000, "+1415").alias("phone_e164"), F.lit(" ").alias("website_url"),
        F.when(balance > 8000, '{"mon": []}').otherwise("{}").alias("hours"), F.when(balance > 2000, 2).alias("price_level"),
        F.when(F.col("c_mktsegment") == "BUILDING", F.array(F.lit("rooftop"))).otherwise(F.array().cast("array<string>")).alias("setting_slugs"))
    return export.audit_export(candidates, records, links, reviews, "v7", as_of("2024-06-01 00:00:00"))


_FIELDS = ("phone_e164", "website_url", "neighborhood", "hours", "price_level")
_FIELD = "CASE o_orderpriority WHEN '1-URGENT' THEN 'phone_e164' WHEN '2-HIGH' THEN 'website_url' WHEN '3-MEDIUM' THEN 'neighborhood' WHEN '5-LOW' THEN 'hours' ELSE 'price_level' END"


@R.query(f"""
WITH lines AS (SELECT l_orderkey AS o, l_linenumber AS n, max(l_partkey)::VARCHAR AS v, min(l_linestatus) AS st, min(l_returnflag) AS f FROM lineitem GROUP BY 1, 2),
ev AS (SELECT o || '-' || n AS id, o, v, st, f, o_custkey AS e, {_FIELD} AS field, o_orderdate AS day, o_orderstatus FROM lines JOIN orders ON o = o_orderkey),
per AS (SELECT o, e, field, day, o_orderstatus, list(id ORDER BY id) AS ids, min(id) FILTER (f = 'A') AS pick, list(id ORDER BY id) FILTER (st = 'O') AS live FROM ev GROUP BY ALL),
dec AS (SELECT p.o, p.e, p.field, p.day, ids, CASE WHEN pick IS NULL THEN 'unknown' ELSE 'selected' END AS status, x.v FROM per p LEFT JOIN ev x ON x.id = pick WHERE p.o_orderstatus <> 'F' AND (pick IS NULL OR x.st = 'O')),
man AS (SELECT * FROM dec QUALIFY row_number() OVER (PARTITION BY e, field ORDER BY day DESC, o DESC) = 1),
now AS (SELECT e, field, coalesce(live, []) AS live FROM per QUALIFY row_number() OVER (PARTITION BY e, field ORDER BY day DESC, o DESC) = 1)
SELECT n.e AS entity, n.field, CASE WHEN stands THEN m.status ELSE 'selected' END AS status, CASE WHEN stands THEN m.v ELSE 'auto' END AS value, CASE WHEN stands THEN 'manual' ELSE 'resolver' END AS source
FROM now n LEFT JOIN man m ON m.e = n.e AND m.field = n.field, LATERAL (SELECT m.o IS NOT NULL AND len(live) > 0 AND len(list_filter(live, lambda i: NOT list_contains(m.ids, i))) = 0 AS stands) s""")
def manual_precedence(spark: SparkSession, d: str) -> DataFrame:
    """Orders as conflicts, their lines as evidence; a review picks the first returned line, or none."""
    o = table(spark, d, "orders", "o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus", "o_orderdate")
    priority = F.col("o_orderpriority")
    field = F.when(priority == "1-URGENT", _FIELDS[0]).when(priority == "2-HIGH", _FIELDS[1]).when(priority == "3-MEDIUM", _FIELDS[2]).when(priority == "5-LOW", _FIELDS[3]).otherwise(_FIELDS[4])
    lines = table(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_linestatus", "l_returnflag").groupBy("l_orderkey", "l_linenumber").agg(
        F.max("l_partkey").cast("string").alias("value"), F.min("l_linestatus").alias("st"), F.min("l_returnflag").alias("flag"))
    ev = lines.join(o, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("evidence_id"), F.col("o_orderkey").alias("conflict_id"), F.col("o_custkey").alias("entity"),
        field.alias("field"), "value", "st", "flag", "o_orderstatus", F.col("o_orderdate").cast("timestamp").alias("at"))
    per = ev.groupBy("conflict_id", "entity", "field", "at", "o_orderstatus").agg(
        F.sort_array(F.collect_list("evidence_id")).alias("evidence_ids"), F.min(F.when(F.col("flag") == "A", F.col("evidence_id"))).alias("pick"),
        F.collect_list(F.when(F.col("st") == "O", F.col("evidence_id"))).alias("live"))
    conflicts = per.withColumn("state", F.when(F.col("o_orderstatus") == "F", "resolved").otherwise("pending"))
    reviews = per.select("conflict_id", F.col("at").alias("reviewed_at"), F.lit("ann").alias("reviewer"), F.lit("seen").alias("notes"), F.col("pick").alias("evidence_id"))
    observations = ev.select("evidence_id", "entity", "field", "value", F.when(F.col("st") == "O", "asserted").otherwise("retracted").alias("status"), F.lit(None).cast("timestamp").alias("expires_at"),
                             F.lit(0.9).alias("evidence_confidence"), F.lit(1.0).alias("identity_confidence"), F.lit(1.0).alias("authority"))
    decisions, _ = manual.settle_conflicts(conflicts, reviews, observations, as_of("2024-01-01 00:00:00"))
    last = per.groupBy("entity", "field").agg(F.max_by("live", F.struct("at", "conflict_id")).alias("evidence_ids"))
    automatic = last.select("entity", "field", F.lit("selected").alias("status"), F.lit("auto").alias("value"), F.lit(0.5).alias("confidence"))
    return manual.standing_decisions(automatic, decisions, last).select("entity", "field", "status", "value", "source")
