"""Readers and row mappers of open place data: GeoJSON sequences, place tables, map elements, queries and geocoders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cairn.functions.payload import field_provenance, origin_keys, quality_flags, settings_of_labels, settings_of_tokens, strings
from cairn.functions.text import blank_to_null, first_filled, join_filled
from cairn.functions.values import finite, latest_timestamp, parse_timestamp, wkt_point
from cairn.operators.classify import ACCESS_TYPES, CONSUMER_TYPES, classify_naics, classify_tokens, supports_consumer_identity
from cairn.sources.licences import token_slugs

PLACE_FEATURE = (
    "struct<geometry:struct<type:string,coordinates:array<double>>,properties:struct<id:string,version:int,"
    "names:struct<primary:string>,basic_category:string,"
    "taxonomy:struct<primary:string,hierarchy:array<string>,alternates:array<string>,alternate:array<string>>,"
    "categories:struct<primary:string,alternate:array<string>,alternates:array<string>>,"
    "confidence:double,websites:array<string>,phones:array<string>,"
    "addresses:array<struct<freeform:string,locality:string,postcode:string,region:string,country:string>>,operating_status:string,"
    "sources:array<struct<dataset:string,record_id:string,property:string,license:string,update_time:string>>>>")
#: Days without refresh after which an open place is stale, and the confidence that its categories carry (fixed values).
STALE_DAYS = 365
OPEN_PLACE_CONFIDENCE = 0.94
#: Flags that close a place (fixed values).
CLOSED_FLAGS = ("closed", "delete", "doesnt_exist", "does_not_exist")


_SOURCES = "array<struct<dataset:string,record_id:string,property:string,license:string,update_time:string>>"


def read_geojson_sequence(spark: SparkSession, path: str, schema: str = PLACE_FEATURE) -> DataFrame:
    """``feature``: one row per line of a GeoJSON text sequence; record separators are dropped, bad lines too."""
    lines = spark.read.text(path).select(F.regexp_replace("value", "^\\u001e", "").alias("value"))
    return lines.select(F.from_json("value", schema).alias("feature")).where(
        "feature IS NOT NULL AND feature.properties IS NOT NULL")


def read_feature_collection(spark: SparkSession, path: str) -> DataFrame:
    """``id, name, rings`` of the named polygons of a GeoJSON feature collection.

    rings are the exterior rings as arrays of (x, y); a polygon without id gets its name as id.
    """
    spec = ("struct<type:string,features:array<struct<id:string,properties:map<string,string>,"
            "geometry:struct<type:string,coordinates:string>>>>")
    whole = spark.read.text(path, wholetext=True).select(F.from_json("value", spec).alias("c")).where("c.type = 'FeatureCollection'")
    f = whole.select(F.explode("c.features").alias("f"))
    kind, text = F.col("f.geometry.type"), F.col("f.geometry.coordinates")
    point = lambda p: F.struct(F.get(p, F.lit(0)).alias("x"), F.get(p, F.lit(1)).alias("y"))
    ring = lambda r: F.transform(r, point)
    polygon = F.array(ring(F.get(F.from_json(text, "array<array<array<double>>>"), F.lit(0))))
    multi = F.transform(F.from_json(text, "array<array<array<array<double>>>>"), lambda p: ring(F.get(p, F.lit(0))))
    name = F.element_at("f.properties", "name")
    return f.select(F.coalesce("f.id", F.element_at("f.properties", "id"), name).alias("id"), name.alias("name"),
                    F.when(kind == "Polygon", polygon).when(kind == "MultiPolygon", multi).alias("rings")).where(
        "name IS NOT NULL AND rings IS NOT NULL")


def category_tokens(*categories: Column) -> Column:
    """Distinct filled tokens of single categories and lists of them, in order."""
    return F.array_distinct(F.filter(F.concat(*(F.coalesce(c, F.array().cast("array<string>")) for c in categories)),
                                     lambda t: F.coalesce(t, F.lit("")) != ""))


def best_address(addresses: Column) -> Column:
    """The first complete address, US ones first; order is otherwise kept."""
    complete = F.filter(addresses, lambda a: first_filled(a["freeform"]).isNotNull() & first_filled(a["locality"]).isNotNull())
    in_us = F.filter(complete, lambda a: a["country"] == "US")
    return F.coalesce(F.get(in_us, F.lit(0)), F.get(complete, F.lit(0)))


def operating_status(text: Column) -> Column:
    """temporarily_closed, closed or open; null where the text says none."""
    t = F.lower(text)
    return F.when(t.contains("tempor") & t.contains("closed"), "temporarily_closed").when(t.contains("closed"), "closed").when(
        t.contains("open"), "open")


def public_access(consumer: Column, private: Column | None = None) -> Column:
    chain = F if private is None else F.when(private, "members_or_private")
    return chain.when(consumer, "walk_in").otherwise("unknown")


def map_features(features: DataFrame) -> DataFrame:
    """Source records of place features with their provenance by field.

    A record needs an id, a name, a complete address, a point and categories in scope.
    """
    p, g = F.col("feature.properties"), F.col("feature.geometry")
    addr = best_address(p["addresses"])
    tax, old = p["taxonomy"], p["categories"]
    tokens = category_tokens(F.array(p["basic_category"]), F.array(tax["primary"]), tax["hierarchy"], tax["alternates"], tax["alternate"],
                             F.array(old["primary"]), old["alternate"], old["alternates"])
    rows = features.select("feature", tokens.alias("_t"), addr.alias("_a")).withColumn("_k", classify_tokens(p["names"]["primary"], F.col("_t"), p["confidence"]))
    kind, addr = F.col("_k"), F.col("_a")
    consumer = F.coalesce(kind["type"].isin(*ACCESS_TYPES), F.lit(False))
    filled = lambda v: F.get(F.filter(v, lambda x: F.coalesce(x, F.lit("")) != ""), F.lit(0))
    return rows.where(kind["eligible"]).select(
        F.lit("overture").alias("source"), F.nullif(p["id"], F.lit("")).alias("source_record_id"), F.trim(F.nullif(p["names"]["primary"], F.lit(""))).alias("name"),
        addr["freeform"].alias("address"), addr["locality"].alias("city"), F.nullif(addr["region"], F.lit("")).alias("region"),
        F.nullif(addr["postcode"], F.lit("")).alias("postal_code"), F.coalesce(F.nullif(addr["country"], F.lit("")), F.lit("US")).alias("country_code"),
        F.get(g["coordinates"], F.lit(1)).alias("latitude"), F.get(g["coordinates"], F.lit(0)).alias("longitude"),
        filled(p["phones"]).alias("phone"), filled(p["websites"]).alias("website_url"), settings_of_tokens(F.col("_t")).alias("setting_slugs"),
        operating_status(p["operating_status"]).alias("source_status"), kind["type"].alias("primary_type"),
        kind["confidence"].alias("classification_confidence"), kind["reason"].alias("classification_reason"), F.lit("consumer_poi").alias("source_family"),
        consumer.alias("consumer_facing"), public_access(consumer).alias("public_access"),
        origin_keys(F.transform(p["sources"], lambda s: s["dataset"])).alias("origin_keys"), F.lit("Overture-source-licenses").alias("data_license"),
        latest_timestamp(F.transform(p["sources"], lambda s: s["update_time"])).alias("source_updated_at"),
        field_provenance(F.coalesce(p["sources"], F.array().cast(_SOURCES))).alias("field_provenance"),
    ).where("source_record_id IS NOT NULL AND name IS NOT NULL AND address IS NOT NULL AND latitude IS NOT NULL AND longitude IS NOT NULL")


def map_open_places(rows: DataFrame, as_of: Column) -> DataFrame:
    """Source records of an open-places table; a record needs an id, name, address, city, point and categories in scope.

    A place is closed by its date or a flag, of unknown status if it is stale.
    Only published fields are read: no hours, prices or outdoor seats.
    """
    labels = F.coalesce(strings(F.col("fsq_category_labels")), F.array().cast("array<string>"))
    refreshed = parse_timestamp(F.col("date_refreshed").cast("string"))
    given = lambda c: blank_to_null(F.col(c).cast("string"))
    r = rows.withColumn("_l", labels).withColumn("_t", token_slugs(F.col("_l"))).withColumn(
        "_k", classify_tokens(F.trim("name"), F.col("_t"), F.lit(OPEN_PLACE_CONFIDENCE))).withColumn("_f", quality_flags(F.col("unresolved_flags"))).withColumn(
        "_r", refreshed).withColumn("_s", F.col("_r").isNull() | (F.col("_r") < as_of - F.make_dt_interval(F.lit(STALE_DAYS))))
    kind = F.col("_k")
    consumer = supports_consumer_identity(F.trim("name"), F.col("_t"), kind["type"], kind["reason"])
    conflict = F.coalesce(kind["type"].isin(*CONSUMER_TYPES), F.lit(False)) & ~consumer
    more = F.array_compact(F.array(F.when(F.col("_s"), F.lit("stale")), F.when(conflict, F.lit("consumer_identity_conflict"))))
    closed = F.col("date_closed").isNotNull() | F.arrays_overlap("_f", F.array(*(F.lit(f) for f in CLOSED_FLAGS)))
    private = F.arrays_overlap("_f", F.array(F.lit("privatevenue"), F.lit("private_venue")))
    return r.where(kind["eligible"]).select(
        F.lit("fsq").alias("source"), given("fsq_place_id").alias("source_record_id"), given("name").alias("name"), given("address").alias("address"),
        given("locality").alias("city"), given("region").alias("region"), given("postcode").alias("postal_code"),
        F.upper(F.coalesce(given("country"), F.lit("US"))).alias("country_code"), F.col("latitude").try_cast("double").alias("latitude"),
        F.col("longitude").try_cast("double").alias("longitude"), given("tel").alias("phone"), given("website").alias("website_url"),
        settings_of_labels(F.col("_l"), F.lit(False)).alias("setting_slugs"),
        F.when(closed, "closed").when(F.col("_s"), "unknown").otherwise("open").alias("source_status"), F.col("_r").alias("source_updated_at"),
        kind["type"].alias("primary_type"), kind["confidence"].alias("classification_confidence"), kind["reason"].alias("classification_reason"),
        F.lit("consumer_poi").alias("source_family"), consumer.alias("consumer_facing"), public_access(consumer, private).alias("public_access"),
        F.array_sort(F.array_union("_f", more)).alias("quality_flags"), F.array(F.lit("foursquare")).alias("origin_keys"), F.lit("Apache-2.0").alias("data_license"),
    ).where("source_record_id IS NOT NULL AND name IS NOT NULL AND address IS NOT NULL AND city IS NOT NULL AND latitude IS NOT NULL AND longitude IS NOT NULL")


def map_registry(rows: DataFrame) -> DataFrame:
    """Source records of a business registry; an end date or an administrative closure closes."""
    kind = classify_naics(F.col("dba_name"), F.col("naics_code"))
    return rows.select(
        F.lit("datasf").alias("source"), first_filled(F.col("uniqueid"), F.col("certificate_number")).alias("source_record_id"),
        first_filled(F.col("dba_name"), F.col("ownership_name")).alias("name"), first_filled(F.col("full_business_address")).alias("address"),
        first_filled(F.col("city")).alias("city"), F.when(
            F.col("location_end_date").isNotNull() | F.coalesce(F.col("administratively_closed"), F.lit("")).isin("true", "Y", "1"), "closed"
        ).otherwise("open").alias("source_status"), kind["type"].alias("primary_type"), kind["eligible"].alias("eligible"))


def map_elements(elements: DataFrame) -> DataFrame:
    """Records of map elements (nodes with a point, ways with a center) with tag fallbacks and objective setting tags."""
    tag = lambda *names: first_filled(*(F.element_at("tags", n) for n in names))
    settings = F.array_compact(F.array(
        F.when(tag("outdoor_seating") == "yes", F.lit("outdoor")), F.when(tag("rooftop") == "yes", F.lit("rooftop")),
        F.when(tag("tourism") == "hotel", F.lit("hotel"))))
    return elements.select(
        F.lit("osm").alias("source"), F.concat_ws("/", "type", F.col("id").cast("string")).alias("source_record_id"),
        tag("name", "name:en").alias("name"), join_filled(tag("addr:housenumber"), tag("addr:street")).alias("address"),
        tag("addr:city").alias("city"), F.coalesce("lat", "center.lat").alias("latitude"), F.coalesce("lon", "center.lon").alias("longitude"),
        tag("phone", "contact:phone").alias("phone"), tag("website", "contact:website", "url").alias("website_url"),
        tag("opening_hours").alias("hours_text"), settings.alias("settings"), parse_timestamp(F.col("timestamp")).alias("source_updated_at"))


def map_bindings(bindings: DataFrame, order: str) -> DataFrame:
    """Records of query bindings (maps of values): the first row of each item, with its point; confidence at most .88."""
    value = lambda k: F.element_at("binding", k)
    lat, lon = wkt_point(value("coord"))
    first = Window.partitionBy("source_record_id").orderBy(order)
    return bindings.select(
        F.lit("wikidata").alias("source"), value("item").alias("source_record_id"), value("itemLabel").alias("name"),
        lat.alias("latitude"), lon.alias("longitude"), F.least(F.coalesce(value("confidence").try_cast("double"), F.lit(0.88)), F.lit(0.88)).alias(
            "classification_confidence"), order).withColumn("_k", F.row_number().over(first)).where("_k = 1").drop("_k")


def geocode_requests(rows: DataFrame, key: str) -> DataFrame:
    """Rows without a point and with an address, as lines of the headerless request."""
    return rows.where("latitude IS NULL AND trim(coalesce(address, '')) <> ''").select(
        F.to_csv(F.struct(F.col(key).cast("string"), "address", "city", "region", "postal_code")).alias("value"))


def parse_geocodes(lines: DataFrame, order: str, value: str = "value") -> DataFrame:
    """``key, latitude, longitude`` of exact matches; bad coordinates are no match; of equal keys the last line counts."""
    spec = "key string, input string, match string, type string, matched string, point string"
    r = lines.select(F.col(order).alias("_o"), F.from_csv(value, spec).alias("r")).select("_o", "r.*")
    xy = F.split("point", ",")
    good = r.where("match = 'Match' AND type = 'Exact'").select(
        "_o", "key", finite(F.get(xy, F.lit(1))).alias("latitude"), finite(F.get(xy, F.lit(0))).alias("longitude"))
    good = good.where("latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180")
    return good.groupBy("key").agg(F.max(F.struct("_o", "latitude", "longitude")).alias("b")).select("key", "b.latitude", "b.longitude")


def latest_release(index: DataFrame, xml: str = "value") -> DataFrame:
    """The largest release (date, minor) named in a bucket index."""
    found = index.select(F.explode(F.regexp_extract_all(F.col(xml), F.lit(r"release/(\d{4}-\d{2}-\d{2}\.\d+)/"), F.lit(1))).alias("r"))
    return found.agg(F.max(F.struct(F.substring_index("r", ".", 1).alias("date"), F.substring_index("r", ".", -1).cast("int").alias("minor"))).alias("m")).select(
        F.concat_ws(".", "m.date", F.col("m.minor").cast("string")).alias("release"))


def write_geojson_sequence(features: DataFrame, path: str) -> None:
    """Write a column ``feature`` as a GeoJSON text sequence: one feature a line after a record separator, in as many files as there are tasks."""
    features.select(F.concat(F.lit("\u001e"), F.to_json("feature")).alias("value")).write.text(path)
