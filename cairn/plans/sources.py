"""Sources as their files hold them: suppliers and parts written in a source's form and read back as source records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.plans.registry import Registry
from cairn.plans.relational import ORDERS_AS_OF, as_of
from cairn.sources import licences, places
from cairn.sources.shared import fresh_path
from cairn.sources.tables import in_box, table

R = Registry()

_KINDS = ("brewery", "wine_bar", "winery", "shop")
_KIND = "[" + ", ".join(f"'{k}'" for k in _KINDS) + "]"


@R.query(f"""
WITH s AS (SELECT s_suppkey AS k, s_name, s_acctbal AS a, n_name, r_name, {_KIND}[s_nationkey % 4 + 1] AS kind FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
SELECT 's' || k AS source_record_id, s_name AS name, CASE WHEN a > 0 THEN n_name ELSE '1 Rue' END AS address, CASE WHEN a > 0 THEN r_name ELSE 'Paris' END AS city,
  CASE WHEN a > 0 THEN 'US' ELSE 'FR' END AS country_code, 37 + a / 100000 AS latitude, -122 + a / 200000 AS longitude, kind AS primary_type,
  CASE WHEN a > 5000 THEN 'open' WHEN a > 2000 THEN 'temporarily_closed' ELSE 'closed' END AS source_status, CASE WHEN a > 1000 THEN 'https://' || lower(replace(s_name, '#', '-')) || '.example' END AS website_url
FROM s WHERE kind <> 'shop' AND (a > 0 OR a < -500)""")
def feature_sequence_records(spark: SparkSession, d: str) -> DataFrame:
    """A GeoJSON text sequence written by all tasks and read back; complete US addresses come before others, incomplete ones never."""
    near = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    s, a = table(spark, d, "supplier").join(near, F.col("s_nationkey") == F.col("n_nationkey")), F.col("s_acctbal")
    place = lambda free, town, country: F.struct(free.alias("freeform"), town.alias("locality"), F.lit(country).alias("country"))
    abroad, half, home = place(F.lit("1 Rue"), F.lit("Paris"), "FR"), place(F.lit("2 Rue"), F.lit(" "), "US"), place(F.col("n_name"), F.col("r_name"), "US")
    addresses = F.when(a > 0, F.array(half, abroad, home)).when(a < -500, F.array(half, abroad)).otherwise(F.array(half))
    site = F.when(a > 1000, F.array(F.lit(""), F.concat(F.lit("https://"), F.lower(F.replace("s_name", F.lit("#"), F.lit("-"))), F.lit(".example"))))
    feature = F.struct(
        F.struct(F.lit("Point").alias("type"), F.array(-122 + a / 200000, 37 + a / 100000).alias("coordinates")).alias("geometry"),
        F.struct(F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("id"), F.struct(F.col("s_name").alias("primary")).alias("names"), addresses.alias("addresses"),
                 F.struct(F.get(F.array(*map(F.lit, _KINDS)), (F.col("s_nationkey") % 4).cast("int")).alias("primary")).alias("categories"), F.lit(0.9).alias("confidence"), site.alias("websites"),
                 F.when(a > 5000, "Open").when(a > 2000, "temporarily closed").otherwise("permanently_closed").alias("operating_status")).alias("properties"))
    path = fresh_path(spark, "features")
    places.write_geojson_sequence(s.select(feature.alias("feature")), path)
    return places.map_features(places.read_geojson_sequence(spark, path)).select(
        "source_record_id", "name", "address", "city", "country_code", "latitude", "longitude", "primary_type", "source_status", "website_url")


@R.query(f"""
WITH p AS (SELECT *, p_size % 5 AS m, {_KIND}[p_size % 4 + 1] AS kind, TIMESTAMP '{ORDERS_AS_OF}' - INTERVAL (p_size * 10) DAY AS at FROM part)
SELECT 'f' || p_partkey AS source_record_id, p_name AS name, p_brand AS city, 37 + p_size / 1000.0::DOUBLE AS latitude, p_retailprice AS longitude, kind AS primary_type,
  CASE WHEN m = 1 THEN 'closed' WHEN p_size * 10 > 365 THEN 'unknown' ELSE 'open' END AS source_status,
  CASE WHEN m = 1 THEN 'closed' ELSE '' END || CASE WHEN m = 1 AND p_size * 10 > 365 THEN ',' ELSE '' END || CASE WHEN p_size * 10 > 365 THEN 'stale' ELSE '' END AS quality_flags
FROM p WHERE kind NOT IN ('shop') AND p_size % 7 <> 0""")
def open_place_records(spark: SparkSession, d: str) -> DataFrame:
    p, size = table(spark, d, "part", "p_partkey", "p_name", "p_brand", "p_size", "p_retailprice"), F.col("p_size")
    kind = F.get(F.array(*map(F.lit, _KINDS)), (size % 4).cast("int"))
    rows = p.select(
        F.concat(F.lit("f"), F.col("p_partkey").cast("string")).alias("fsq_place_id"), F.concat(F.lit(" "), "p_name").alias("name"), F.concat(size.cast("string"), F.lit(" Main")).alias("address"),
        F.when(size % 7 != 0, F.col("p_brand")).otherwise(" ").alias("locality"), F.lit(None).cast("string").alias("region"), F.lit("").alias("postcode"), F.lit("us").alias("country"),
        (37 + size / 1000.0).cast("string").alias("latitude"), F.col("p_retailprice").cast("string").alias("longitude"), F.lit(None).cast("string").alias("tel"), F.lit(None).cast("string").alias("website"),
        F.array(F.initcap(F.replace(kind, F.lit("_"), F.lit(" ")))).alias("fsq_category_labels"), F.when(size % 5 == 1, F.array(F.lit("closed"))).alias("unresolved_flags"),
        F.lit(None).cast("string").alias("date_closed"), F.date_format(as_of(ORDERS_AS_OF) - F.make_dt_interval((size * 10).cast("int")), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("date_refreshed"))
    found = places.map_open_places(rows, as_of(ORDERS_AS_OF))
    return found.select("source_record_id", "name", "city", "latitude", "longitude", "primary_type", "source_status", F.array_join("quality_flags", ",").alias("quality_flags"))


@R.query("""
SELECT s_suppkey::VARCHAR AS source_record_id, s_name AS name, n_name || ' Suite ' || s_nationkey AS address, r_name AS city,
  CASE WHEN s_acctbal > 5000 THEN 'open' WHEN s_acctbal > 2000 THEN 'closed' ELSE 'unknown' END AS source_status, CASE s_nationkey % 3 WHEN 0 THEN 'bar' WHEN 1 THEN 'brewery' END AS primary_type
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE s_nationkey <> 5""")
def licence_records(spark: SparkSession, d: str) -> DataFrame:
    near = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    s, a, n = table(spark, d, "supplier").join(near, F.col("s_nationkey") == F.col("n_nationkey")), F.col("s_acctbal"), F.col("s_nationkey")
    rows = s.select(
        F.col("s_suppkey").cast("string").alias("File Number"), F.when(n % 2 == 0, F.col("s_name")).otherwise(" ").alias("DBA Name"), F.when(n != 5, F.col("s_name")).alias("Primary Name"),
        F.col("n_name").alias("Premise Street Address 1"), F.concat(F.lit("Suite "), n.cast("string")).alias("Premise Street Address 2"), F.col("r_name").alias("Premise City"),
        F.lit("CA").alias("Premise State"), F.lit("").alias("Premise Zip"), F.when(a > 5000, "ACTIVE").when(a > 2000, "revoked").otherwise("PENDING").alias("Type Status"), F.lit("LIC").alias("License or Application"),
        F.when(n % 3 == 0, "48").when(n % 3 == 1, "023").otherwise("21").alias("License Type"), F.lit("01-JAN-2020").alias("Type Original Issue Date(s)"), F.lit("31-DEC-2024").alias("Expiration Date(s)"))
    named = licences.canonical_headers(rows)
    named = named.withColumnsRenamed({c: c.replace("date_s", "dates") for c in named.columns})
    return licences.map_licences(named).select("source_record_id", "name", "address", "city", "source_status", "primary_type")


@R.query("""
SELECT vec_id, 37 + CAST(embedding[1] AS DOUBLE) / 10 AS lat, -122 + CAST(embedding[2] AS DOUBLE) / 10 AS lon FROM embeddings
WHERE CAST(embedding[1] AS DOUBLE) / 10 BETWEEN -0.01 AND 0.02 AND CAST(embedding[2] AS DOUBLE) / 10 BETWEEN -0.02 AND 0.01""")
def points_in_box(spark: SparkSession, d: str) -> DataFrame:
    at = lambda i: F.get("embedding", F.lit(i)).cast("double") / 10
    points = table(spark, d, "embeddings", "vec_id", "embedding").select("vec_id", (37 + at(0)).alias("lat"), (-122 + at(1)).alias("lon"))
    return in_box(points, "lat", "lon", (-122.02, 36.99, -121.99, 37.02))
