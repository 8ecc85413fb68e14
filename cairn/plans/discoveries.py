"""Discovery from raw records: the parts as places of several sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.operators import classify, discovery
from cairn.plans.matching import _GRAMS, _LCS, _SIMILAR
from cairn.plans.registry import Registry
from cairn.sources.tables import spread, table

R = Registry()

_SOURCES = {"PROMO": "fsq", "ECONOMY": "fsq", "STANDARD": "ca_abc", "LARGE": "overture"}
_TYPES = ("bar", "pub", "brewery", "taproom", None)
_quoted = lambda words: ", ".join(f"'{w}'" for w in words)

_RECORDS = f"""
raw AS (SELECT p_partkey AS id, CASE p_type {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in _SOURCES.items())} ELSE 'osm' END AS source, lower(p_name) AS name,
  lower(p_size || ' ' || split_part(p_name, ' ', 2) || ' st') AS address, lower(p_brand) AS city, CAST(round(p_retailprice * 10) AS BIGINT) AS price,
  37 + p_size / 2000.0::DOUBLE AS lat, -122 + p_retailprice / 100000 AS lon, p_retailprice, p_size FROM part),
live AS (SELECT *, '+1415555' || lpad((price % 10000)::VARCHAR, 4, '0') AS phone, replace(name, ' ', '-') || '.example.com' AS host,
  [{', '.join('NULL' if t is None else repr(t) for t in _TYPES)}][price % 5 + 1] AS kind, {_GRAMS.format(c='name')} AS ng, {_GRAMS.format(c='address')} AS ag
  FROM raw WHERE p_size < 50 AND price % 17 <> 0),
met AS (SELECT a.id AS anchor_id, r.id AS record_id, r.source, a.name AS an, r.name AS rn, a.address AS aa, r.address AS ra, a.phone = r.phone AS phone, a.host = r.host AS host,
    a.source = 'ca_abc' OR r.source = 'ca_abc' AS licensed, a.kind IS NULL OR r.kind IS NULL OR a.kind = r.kind OR (a.kind IN ({_quoted(classify.BAR_TYPES)}) AND r.kind IN ({_quoted(classify.BAR_TYPES)}))
    OR list_contains([{_quoted('|'.join(sorted(p)) for p in classify.COMPATIBLE_TYPES)}], least(a.kind, r.kind) || '|' || greatest(a.kind, r.kind)) AS compatible,
    {_SIMILAR.format(a='a.ng', b='r.ng')} AS n, {_SIMILAR.format(a='a.ag', b='r.ag')} AS t,
    pow(sin(radians(r.lat - a.lat) / 2), 2) + cos(radians(a.lat)) * cos(radians(r.lat)) * pow(sin(radians(r.lon - a.lon) / 2), 2) AS h
  FROM live a JOIN live r ON a.city = r.city AND a.id <> r.id WHERE a.source = 'fsq'),
near AS (SELECT *, 2 * 6371000.0 * atan2(sqrt(h), sqrt(1 - h)) AS meters FROM met),
kept AS (SELECT * FROM near WHERE n > 0.3 OR t > 0.3 OR meters <= 100 QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY greatest(n, t) DESC, record_id) <= 50),
names AS (SELECT x, y, 2.0 * {_LCS.format(a='x', b='y')} / (length(x) + length(y)) AS ratio FROM (SELECT DISTINCT an AS x, rn AS y FROM kept UNION SELECT DISTINCT aa, ra FROM kept)),
scored AS (SELECT k.*, a.ratio AS name, b.ratio AS address FROM kept k JOIN names a ON a.x = an AND a.y = rn JOIN names b ON b.x = aa AND b.y = ra),
ruled AS (SELECT *, CASE WHEN phone AND (address >= 0.985 OR meters <= 25) AND name >= 0.55 THEN 'exact_phone_same_location'
  WHEN host AND (address >= 0.94 OR meters <= 25) AND name >= 0.65 THEN 'exact_website_same_location'
  WHEN address >= 0.985 AND name >= 0.90 THEN 'exact_address_strong_name' WHEN meters <= 25 AND name >= 0.94 THEN 'same_door_strong_name'
  WHEN meters <= 50 AND address >= 0.96 AND name >= 0.92 THEN 'nearby_address_and_name' WHEN licensed AND address >= 0.985 AND name >= 0.84 THEN 'licensed_exact_premise_name'
  WHEN address >= 0.985 AND name < 0.84 THEN 'same_location_name_conflict' WHEN meters <= 15 AND name < 0.75 THEN 'same_location_name_conflict'
  WHEN address >= 0.95 AND name >= 0.78 THEN 'probable_identity_needs_review' ELSE 'insufficient_identity_evidence' END AS rule FROM scored),
judged AS (SELECT *, CASE rule WHEN 'exact_phone_same_location' THEN 0.995 WHEN 'exact_website_same_location' THEN 0.99 WHEN 'exact_address_strong_name' THEN 0.985
    WHEN 'same_door_strong_name' THEN 0.975 WHEN 'nearby_address_and_name' THEN 0.97 WHEN 'licensed_exact_premise_name' THEN 0.965 WHEN 'same_location_name_conflict' THEN 0.85
    WHEN 'probable_identity_needs_review' THEN 0.84 ELSE 0 END::DOUBLE AS score,
  CASE WHEN rule LIKE '%conflict' OR rule LIKE '%review' THEN 'review' WHEN rule LIKE 'insufficient%' THEN 'distinct' ELSE 'match' END AS decided FROM ruled),
pairs AS (SELECT anchor_id, record_id, source, score, compatible, CASE WHEN compatible THEN rule ELSE 'type_conflict:' || rule END AS reason,
  CASE WHEN NOT compatible AND decided <> 'distinct' THEN 'review' ELSE decided END AS action FROM judged)"""

_CLAIMS = """
a AS (SELECT id, row_number() OVER (ORDER BY p_retailprice DESC, id) AS i FROM live WHERE source = 'fsq'),
m AS (SELECT *, action = 'match' AND compatible AS m FROM pairs),
k AS (SELECT *, row_number() OVER w AS k, lead(score) OVER w AS next FROM m WINDOW w AS (PARTITION BY anchor_id, source, m ORDER BY score DESC, record_id)),
c AS (SELECT *, m AND (source = 'ca_abc' OR (k = 1 AND (next IS NULL OR score - next >= 0.03::DOUBLE))) AS chosen FROM k),
s AS (SELECT a.id, a.i, list(record_id) FILTER (WHERE chosen) AS sel FROM a LEFT JOIN c ON c.anchor_id = a.id GROUP BY 1, 2),
step AS (SELECT 0::BIGINT AS i, NULL::BIGINT AS id, false AS active, []::BIGINT[] AS claimed UNION ALL
  SELECT s.i, s.id, NOT list_contains(claimed, s.id), CASE WHEN list_contains(claimed, s.id) THEN claimed ELSE list_distinct(list_concat(claimed, [s.id], coalesce(s.sel, []))) END FROM step JOIN s ON s.i = step.i + 1),
offered AS (SELECT st.id AS candidate_id, st.i, c.record_id, c.score, c.reason FROM step st JOIN c ON c.anchor_id = st.id WHERE active AND chosen UNION ALL SELECT id, i, id, 1.0, 'anchor_source_id' FROM step WHERE active),
firsts AS (SELECT record_id, min_by(candidate_id, i) AS owner FROM offered GROUP BY 1)"""


@R.query(f"""
WITH RECURSIVE {_RECORDS.strip()}, {_CLAIMS.strip()}
SELECT candidate_id, record_id, CASE WHEN owner = candidate_id THEN 'linked' ELSE 'review' END AS outcome, score,
  CASE WHEN owner = candidate_id THEN reason ELSE 'source_already_linked_to_another_candidate' END AS reason FROM offered JOIN firsts USING (record_id) UNION ALL
SELECT anchor_id, record_id, 'review', score, reason FROM c JOIN step st ON st.id = anchor_id AND active WHERE NOT chosen AND (action = 'review' OR (action = 'match' AND compatible))""")
def discovery_from_records(spark: SparkSession, d: str) -> DataFrame:
    p = spread(table(spark, d, "part", "p_partkey", "p_type", "p_name", "p_size", "p_brand", "p_retailprice"), "p_partkey")
    price = F.round(F.col("p_retailprice") * 10).cast("long")
    chain = F
    for kind, source in _SOURCES.items():
        chain = chain.when(F.col("p_type") == kind, source)
    records = p.select(
        F.col("p_partkey").alias("id"), chain.otherwise("osm").alias("source"), F.col("p_name").alias("name"), F.col("p_brand").alias("city"), F.lit("US").alias("country"),
        F.concat_ws(" ", F.col("p_size").cast("string"), F.element_at(F.split("p_name", " "), 2), F.lit("Street")).alias("address"),
        F.concat(F.lit("(415) 555-"), F.lpad((price % 10000).cast("string"), 4, "0")).alias("phone"), F.concat(F.lit("http://www."), F.replace("p_name", F.lit(" "), F.lit("-")), F.lit(".example.com/x")).alias("website"),
        (37 + F.col("p_size") / 2000.0).alias("lat"), (-122 + F.col("p_retailprice") / 100000).alias("lon"), F.get(F.array(*map(F.lit, _TYPES)), (price % 5).cast("int")).alias("primary_type"),
        F.lit("open").alias("status"), F.when(F.col("p_size") >= 50, F.lit("2024-01-01")).alias("retired_at"), F.when(price % 17 == 0, F.array(F.lit("stale"))).alias("flags"), "p_retailprice")
    _, links, reviews = discovery.correlate(records, ["fsq"], -F.col("p_retailprice"))
    return links.select("candidate_id", "record_id", F.lit("linked").alias("outcome"), "score", F.col("method").alias("reason")).unionByName(
        reviews.select("candidate_id", "record_id", F.lit("review").alias("outcome"), "score", "reason"))
