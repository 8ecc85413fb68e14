"""Payload, text, value, hours, status and category rules over the provided tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.functions import hours, payload, text, values
from cairn.operators import classify, gate
from cairn.plans.registry import Registry
from cairn.sources import licences, places
from cairn.sources.tables import spread, table

R = Registry()


def pick(key: Column, *options: str | None) -> Column:
    """The option at the key's remainder."""
    return F.element_at(F.array(*(F.lit(o).cast("string") for o in options)), (key % len(options) + 1).cast("int"))


def sql_list(*options: str | None) -> str:
    return "[" + ", ".join("NULL" if o is None else "'" + o.replace("'", "''") + "'" for o in options) + "]"


def sql_pick(key: str, *options: str | None) -> str:
    return f"{sql_list(*options)}[CAST({key} % {len(options)} AS BIGINT) + 1]"


def _parts(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    return table(spark, d, "part", "p_partkey", *columns)


def K() -> Column:
    return F.col("p_partkey")


_DATASETS = ("meta", "Facebook", "Foursquare", "fsq_os", "Microsoft", "bing maps", "OpenStreetMap", "osm", "cosmos", "AllThePlaces", "overturemaps", "Krick", None)
_PROPERTIES = ("/phones/0", None, "/websites/0", "/geometry", "/taxonomy/primary", "/names/primary", "/other")
_ORIGIN = """CASE WHEN lower({d}) LIKE '%foursquare%' OR lower({d}) LIKE 'fsq%' THEN 'foursquare' WHEN lower({d}) LIKE '%facebook%' OR lower({d}) LIKE '%meta%' THEN 'meta'
  WHEN lower({d}) LIKE '%microsoft%' OR lower({d}) LIKE '%bing%' THEN 'microsoft' WHEN lower({d}) LIKE '%openstreetmap%' OR lower({d}) = 'osm' THEN 'openstreetmap'
  ELSE 'overture:' || lower({d}) END"""
_LICENSE = """CASE WHEN lower({d}) LIKE '%foursquare%' OR lower({d}) LIKE 'fsq%' THEN 'Apache-2.0' WHEN lower({d}) LIKE '%alltheplaces%' OR lower({d}) IN ('overture', 'overturemaps') THEN 'CC0-1.0'
  WHEN regexp_matches(lower({d}), 'brightquery|dac|krick|meta|microsoft|pinmeto|renderseo') THEN 'CDLA-Permissive-2.0' ELSE 'unknown' END"""
_ITEMS = f"""
WITH raw AS (SELECT p_partkey, p_size, unnest([0, 1, 2]) AS i FROM part),
items AS (SELECT p_partkey, {sql_pick('(p_partkey + 5 * i)', *_DATASETS)} AS dataset, {sql_pick('(p_partkey + i)', *_PROPERTIES)} AS property,
  CASE WHEN (p_size + i) % 4 = 0 THEN 'ODbL-1.0' END AS license FROM raw)"""


def _items() -> Column:
    return F.array(*(F.struct(
        pick(K() + 5 * i, *_DATASETS).alias("dataset"), F.lit(None).cast("string").alias("record_id"), pick(K() + i, *_PROPERTIES).alias("property"),
        F.when((F.col("p_size") + i) % 4 == 0, "ODbL-1.0").alias("license"), F.lit("").alias("update_time")) for i in range(3)))


@R.query(_ITEMS + f"""
SELECT p_partkey, coalesce(array_to_string(list_sort(list(DISTINCT {_ORIGIN.format(d='dataset')}) FILTER (WHERE dataset IS NOT NULL)), ','), 'overture:unknown') AS origins
FROM items GROUP BY 1""")
def origin_lineage(spark: SparkSession, d: str) -> DataFrame:
    datasets = F.transform(_items(), lambda i: i["dataset"])
    return _parts(spark, d, "p_size").select("p_partkey", F.array_join(payload.origin_keys(datasets), ",").alias("origins"))


_PATHS = "(VALUES " + ", ".join(f"('{f}', '{p}')" for f, paths in payload.FIELD_PATHS.items() for p in paths) + ") AS t(field, path)"


@R.query(_ITEMS + f""",
hits AS (SELECT DISTINCT p_partkey, field, dataset, property, coalesce(license, {_LICENSE.format(d='dataset')}) AS license, i FROM (
  SELECT *, row_number() OVER (PARTITION BY p_partkey) AS i FROM items WHERE dataset IS NOT NULL) x, {_PATHS} WHERE property IS NULL OR starts_with(property, path))
SELECT p_partkey, field, array_to_string(list_sort(list(DISTINCT {_ORIGIN.format(d='dataset')})), ',') AS origins, array_to_string(list_sort(list(DISTINCT license)), ',') AS licences,
  count(*) AS items FROM hits GROUP BY 1, 2""")
def field_provenance(spark: SparkSession, d: str) -> DataFrame:
    rows = spread(_parts(spark, d, "p_size"), "p_partkey").select("p_partkey", F.explode(payload.field_provenance(_items())).alias("field", "v"))
    return rows.select("p_partkey", "field", F.array_join("v.origin_keys", ",").alias("origins"), F.array_join("v.license_ids", ",").alias("licences"),
                       F.size("v.source_items").cast("long").alias("items"))


_TOKENS = ("hotel_bar", "hotel", "rooftop_lounge", "brewpub", "rooftop", "hotel_lounge")


@R.query(f"""
WITH t AS (SELECT p_partkey, p_size, [{sql_pick('p_partkey', *_TOKENS)}, {sql_pick('(p_partkey // 6)', *_TOKENS)}] AS t, ['The ' || p_name, CASE WHEN p_size % 3 = 0 THEN 'Hotel Bar' ELSE 'Rooftop Deck' END] AS l FROM part)
SELECT p_partkey, array_to_string(list_sort(list_filter([CASE WHEN list_has_any(t, ['hotel_bar', 'hotel_lounge']) THEN 'hotel' END, CASE WHEN list_has_any(t, ['rooftop_bar', 'rooftop_lounge']) THEN 'rooftop' END,
  CASE WHEN list_contains(t, 'brewpub') THEN 'production_premises' END, CASE WHEN list_contains(t, 'brewpub') THEN 'restaurant_attached' END], lambda x: x IS NOT NULL)), ',') AS by_tokens,
  array_to_string(list_filter([CASE WHEN p_size % 3 = 0 THEN 'hotel' END, CASE WHEN p_size % 2 = 0 THEN 'outdoor_patio' END, CASE WHEN p_size % 3 <> 0 THEN 'rooftop' END], lambda x: x IS NOT NULL), ',') AS by_labels FROM t""")
def setting_tags(spark: SparkSession, d: str) -> DataFrame:
    size = F.col("p_size")
    tokens = F.array(pick(K(), *_TOKENS), pick(F.floor(K() / 6), *_TOKENS))
    labels = F.array(F.concat(F.lit("The "), "p_name"), F.when(size % 3 == 0, "Hotel Bar").otherwise("Rooftop Deck"))
    return _parts(spark, d, "p_name", "p_size").select(
        "p_partkey", F.array_join(payload.settings_of_tokens(tokens), ",").alias("by_tokens"),
        F.array_join(payload.settings_of_labels(labels, size % 2 == 0), ",").alias("by_labels"))


_FLAGS = ("Doesn't Exist", "privateVenue", " ", "Private Venue", "duplicate", None, "does-not-exist", "CLOSED")


@R.query(f"""
WITH f AS (SELECT p_partkey, list_filter([{sql_pick('p_partkey', *_FLAGS)}, {sql_pick('(p_partkey + p_size)', *_FLAGS)}], lambda x: x IS NOT NULL AND trim(x) <> '') AS f FROM part),
s AS (SELECT p_partkey, f, [trim(regexp_replace(lower(x), '[^a-z0-9]+', '_', 'g'), '_') for x in f] AS s FROM f)
SELECT p_partkey, array_to_string(list_sort(list_distinct([CASE replace(x, '_', '') WHEN 'doesntexist' THEN 'doesnt_exist' WHEN 'doesnotexist' THEN 'does_not_exist' WHEN 'privatevenue' THEN 'privatevenue' ELSE x END
  for x in s])), ',') AS flags, trim(f[1]) AS first FROM s""")
def quality_flag_names(spark: SparkSession, d: str) -> DataFrame:
    raw = F.array(pick(K(), *_FLAGS), pick(K() + F.col("p_size"), *_FLAGS))
    return _parts(spark, d, "p_size").select("p_partkey", F.array_join(payload.quality_flags(raw), ",").alias("flags"), payload.first_string(raw).alias("first"))


_KINDS = ("bar", "pub", "taproom", "brewery", "cafe")
_CATEGORIES = ("wine_store", "greek_restaurant", "coffee_shop", "music_venue", "grocery_store", "post_office", "theater_district")


@R.query(f"""
WITH t AS (SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN p_name || ' Lounge' ELSE p_name END AS name, {sql_pick('p_partkey', *_KINDS)} AS kind, [{sql_pick('p_size', *_CATEGORIES)}] AS t FROM part),
c AS (SELECT *, len(list_filter(t, lambda x: regexp_matches(x, '^(.*_)?({'|'.join(classify.HARD_CONFLICTS)})$'))) > 0 AS hard,
  len(list_filter(t, lambda x: regexp_matches(x, '^(.*_)?restaurant$'))) > 0 AS food, len(list_filter(t, lambda x: regexp_matches(x, '^(.*_)?({'|'.join(classify.BAR_RETAIL_CONFLICTS)})$'))) > 0 AS shop FROM t)
SELECT p_partkey, kind <> 'cafe' AND NOT hard AND (kind = 'taproom' OR NOT food) AND (kind NOT IN ('bar', 'pub') OR NOT shop) AND (kind <> 'bar' OR name LIKE '% Lounge') AS supported FROM c""")
def consumer_identity(spark: SparkSession, d: str) -> DataFrame:
    kind = pick(K(), *_KINDS)
    name = F.when(K() % 2 == 0, F.concat("p_name", F.lit(" Lounge"))).otherwise(F.col("p_name"))
    reason = F.when(kind == "bar", "taxonomy:generic_bar").otherwise("taxonomy:exact")
    supported = classify.supports_consumer_identity(name, F.array(pick(F.col("p_size"), *_CATEGORIES)), kind, reason)
    return _parts(spark, d, "p_name", "p_size").select("p_partkey", supported.alias("supported"))


_ODD_TEXTS = ("  ", "$$", " https://a.example/x ", "+1 (415) 555-1234", None, "null", "{}", "$$$$$", "ftp://b.example", "Ünï  code & Co.")


@R.query(f"""
WITH t AS (SELECT p_partkey, p_name, {sql_pick('p_partkey', *_ODD_TEXTS)} AS t, {sql_pick('(p_partkey // 10)', *_ODD_TEXTS)} AS u FROM part)
SELECT p_partkey, nullif(trim(t), '') IS NULL AS blank, coalesce(trim(t) IN ('null', '{{}}', '[]', ''), true) AS json_empty, coalesce(nullif(trim(t), ''), nullif(trim(u), ''), p_name) AS filled,
  array_to_string(list_filter([nullif(trim(t), ''), nullif(trim(u), '')], lambda x: x IS NOT NULL), ' ') AS joined, CASE WHEN regexp_matches(t, '^\\${{1,4}}$') THEN CAST(length(t) AS BIGINT) END AS price,
  coalesce(regexp_matches(regexp_replace(t, '[\\s().-]', '', 'g'), '^\\+[1-9][0-9]{{7,14}}$'), false) AS e164, coalesce(regexp_matches(t, '^https?://[^/?#]+', 'i'), false) AS safe,
  trim(regexp_replace(lower(trim(t)), '[^a-z0-9]+', '_', 'g'), '_') AS slug, t IS NOT NULL AND lower(trim(t)) IN ('1', 'true', 'yes', 'y', 't') AS truthy FROM t""")
def text_rules(spark: SparkSession, d: str) -> DataFrame:
    t, u = F.col("t"), F.col("u")
    rows = _parts(spark, d, "p_name").withColumns({"t": pick(K(), *_ODD_TEXTS), "u": pick(F.floor(K() / 10), *_ODD_TEXTS)})
    return rows.select(
        "p_partkey", text.blank_to_null(t).isNull().alias("blank"), values.json_is_empty(t).alias("json_empty"), text.first_filled(t, u, F.col("p_name")).alias("filled"),
        text.join_filled(t, u).alias("joined"), text.price_symbols(t).cast("long").alias("price"), text.is_e164(t).alias("e164"), text.safe_url(t).alias("safe"),
        text.slug(t).alias("slug"), values.truthy(t).alias("truthy"))


@R.query("""
WITH t AS (SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day, CASE WHEN o_orderkey % 4 = 0 THEN 'bad' ELSE strftime(o_orderdate, '%Y-%m-%dT') || '10:30:00Z' END AS a,
  strftime(o_orderdate, '%Y-%m-%dT') || '23:30:00-02:00' AS b, o_totalprice FROM orders)
SELECT o_orderkey, CASE WHEN o_orderkey % 4 <> 0 THEN day || ' 10:30:00' END AS parsed, strftime(CAST(day AS DATE) + INTERVAL 1 DAY, '%Y-%m-%d') || ' 01:30:00' AS latest,
  CASE WHEN o_orderkey % 3 <> 0 THEN 37.25 END AS lat, CASE WHEN o_orderkey % 3 <> 0 THEN CAST(-(o_orderkey % 100) - 0.5 AS DOUBLE) END AS lon, printf('%.4f', o_totalprice) AS coordinate_key,
  CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_totalprice END AS finite, ['government_regulator', 'consumer_poi', 'other'][CAST(o_orderkey % 3 AS BIGINT) + 1] AS family,
  'x [redacted]' AS redacted FROM t""")
def time_and_place_texts(spark: SparkSession, d: str) -> DataFrame:
    key, at = F.col("o_orderkey"), F.col("o_orderdate").cast("timestamp")
    day = F.date_format(at, "yyyy-MM-dd")
    a = F.when(key % 4 == 0, "bad").otherwise(F.concat(day, F.lit("T10:30:00Z")))
    b = F.concat(day, F.lit("T23:30:00-02:00"))
    lat, lon = values.wkt_point(F.when(key % 3 != 0, F.concat(F.lit("Point( -"), (key % 100).cast("string"), F.lit(".5 37.25)"))).otherwise("LINE(1 2)"))
    shown = lambda t: F.date_format(t, "yyyy-MM-dd HH:mm:ss")
    price = F.when(key % 5 == 0, F.lit("Infinity")).otherwise(F.col("o_totalprice").cast("string"))
    return table(spark, d, "orders", "o_orderkey", "o_orderdate", "o_totalprice").select(
        "o_orderkey", shown(values.parse_timestamp(a)).alias("parsed"), shown(values.latest_timestamp(F.array(a, b))).alias("latest"), lat.alias("lat"), lon.alias("lon"),
        values.coordinate_key(F.col("o_totalprice")).alias("coordinate_key"), values.finite(price).alias("finite"),
        values.source_family(pick(key, "ca_abc", "fsq", "other")).alias("family"), values.redact_error(F.lit("x postgres://u:p@h/d")).alias("redacted"))


@R.query("""
SELECT p_partkey, 'v1:' || sha256('=' || p_name || chr(31) || '=' || (floor(p_retailprice * 100000 + 0.5) / 100000) || chr(31) || '-') AS fingerprint FROM part""")
def request_fingerprints(spark: SparkSession, d: str) -> DataFrame:
    return _parts(spark, d, "p_name", "p_retailprice").select(
        "p_partkey", values.request_fingerprint(F.col("p_name"), F.col("p_retailprice"), F.lit(None).cast("double")).alias("fingerprint"))


@R.query("""
WITH h AS (SELECT s_suppkey, s_suppkey % 9 AS day, s_suppkey % 3 AS next, lpad(CAST(s_suppkey % 26 AS VARCHAR), 2, '0') || ':15' AS opens, '01:00' AS closes FROM supplier)
SELECT s_suppkey, day BETWEEN 1 AND 7 AND next IN (0, 1) AND opens < '24' AS valid, day > 4 AS has_hours, CASE WHEN s_suppkey % 2 = 0 THEN '+' ELSE '' END || replace(opens, ':', '')[1:2] || ':15' AS colon,
  CASE WHEN opens < '24' THEN CASE WHEN CAST(opens[1:2] AS INTEGER) % 12 = 0 THEN '12' ELSE CAST(CAST(opens[1:2] AS INTEGER) % 12 AS VARCHAR) END || ':15' || CASE WHEN opens < '12' THEN ' AM' ELSE ' PM' END END AS twelve,
  CASE WHEN s_suppkey % 5 = 0 OR (opens >= '24' AND s_suppkey % 4 <> 0) THEN NULL WHEN s_suppkey % 4 = 0 THEN '2024-07-04 closed' ELSE '2024-07-04 ' || opens || '-01:00+' || CASE WHEN '01:00' <= opens THEN '1' ELSE '0' END END AS special,
  'Tuesday: 4 PM - 2 AM' AS weekday FROM h""")
def hours_rules(spark: SparkSession, d: str) -> DataFrame:
    key = F.col("s_suppkey")
    opens = F.concat(F.lpad((key % 26).cast("string"), 2, "0"), F.lit(":15"))
    interval = lambda day, o, c, n: F.array(F.struct(day.cast("int").alias("day"), o.alias("opens"), c.alias("closes"), n.cast("int").alias("closes_day_offset")))
    week = interval(key % 9, opens, F.lit("01:00"), key % 3)
    dated = hours.special_interval(F.when(key % 5 == 0, "2024-02-31").otherwise("2024-07-04"), key % 4 == 0, opens, F.lit("01:00"))
    shown = F.when(dated["closed"], F.concat(dated["date"].cast("string"), F.lit(" closed"))).otherwise(F.concat(
        dated["date"].cast("string"), F.lit(" "), dated["opens"], F.lit("-"), dated["closes"], F.lit("+"), dated["closes_day_offset"].cast("string")))
    raw = F.concat(F.when(key % 2 == 0, "+").otherwise(""), F.regexp_replace(opens, ":", ""))
    return table(spark, d, "supplier", "s_suppkey").select(
        "s_suppkey", hours.weekly_valid(week).alias("valid"), hours.has_hours(F.when(key % 9 > 4, week)).alias("has_hours"), hours.hhmm(raw).alias("colon"),
        F.when(hours.clock(opens).isNotNull(), hours.twelve_hour(opens)).alias("twelve"), F.when(dated.isNotNull(), shown).alias("special"),
        F.get(hours.weekday_text(interval(F.lit(2), F.lit("16:00"), F.lit("02:00"), F.lit(1))), F.lit(0)).alias("weekday"))


_STATUS = ("Active", " REVOKED ", "Temporarily Closed", "open", "permanently closed", None, "pending")


@R.query(f"""
WITH s AS (SELECT p_partkey, {sql_pick('p_partkey', *_STATUS)} AS s, {sql_pick('(p_partkey // 7)', 'LIC', 'APP')} AS k FROM part)
SELECT p_partkey, CASE WHEN k = 'APP' THEN 'unknown' WHEN upper(trim(s)) = 'ACTIVE' THEN 'open' WHEN upper(trim(s)) = 'REVOKED' THEN 'closed' ELSE 'unknown' END AS licence,
  CASE WHEN s LIKE 'Temp%' THEN 'temporarily_closed' WHEN s LIKE '%closed' THEN 'closed' WHEN s = 'open' THEN 'open' END AS operating FROM s""")
def status_rules(spark: SparkSession, d: str) -> DataFrame:
    status = pick(K(), *_STATUS)
    return _parts(spark, d).select("p_partkey", licences.license_status(status, pick(F.floor(K() / 7), "LIC", "APP")).alias("licence"),
                                   places.operating_status(status).alias("operating"))


@R.query("""
WITH t AS (SELECT p_partkey, string_split(p_name, ' ') AS w, p_brand, p_type FROM part)
SELECT p_partkey, array_to_string(list_filter(['dining', trim(regexp_replace(lower(w[1]), '[^a-z0-9]+', '_', 'g'), '_'), trim(regexp_replace(lower(p_brand), '[^a-z0-9]+', '_', 'g'), '_')], lambda x: x <> ''), ',') AS breadcrumb,
  array_to_string([p_brand, p_type, w[1]], ',') AS taxonomy, array_to_string([p_brand, w[1], p_type], ',') AS labels, ends_with(p_brand, '3') OR ends_with(p_brand, '_x') AS conflict FROM t""")
def category_fields(spark: SparkSession, d: str) -> DataFrame:
    first, brand, kind = F.get(F.split("p_name", " "), F.lit(0)), F.col("p_brand"), F.col("p_type")
    last = F.regexp_replace(brand, "(.)$", "_$1")
    return _parts(spark, d, "p_name", "p_brand", "p_type").select(
        "p_partkey", F.array_join(licences.token_slugs(F.array(F.concat(F.lit("Dining > "), first, F.lit(" / "), brand))), ",").alias("breadcrumb"),
        F.array_join(places.category_tokens(F.array(brand), F.array(kind, F.lit("")), F.array(brand, first)), ",").alias("taxonomy"),
        F.array_join(payload.category_labels(F.array(brand, F.lit(" ")), F.array(first), F.array(kind, brand)), ",").alias("labels"),
        classify.conflicts_with(F.array(last), ("3", "x")).alias("conflict"))


_NUMBERS = ("1", "4", "2.5", "6", "x", "", None, "3")


@R.query(f"""
WITH n AS (SELECT p_partkey, p_size, {sql_pick('p_partkey', *_NUMBERS)} AS a, {sql_pick('(p_partkey // 8)', *_NUMBERS)} AS b FROM part),
v AS (SELECT *, TRY_CAST(a AS DOUBLE) AS x, TRY_CAST(b AS DOUBLE) AS y FROM n)
SELECT p_partkey, CASE WHEN x BETWEEN 1 AND 5 AND x = floor(x) THEN CAST(x AS BIGINT) END AS veracity, coalesce(x, y) AS coordinate, CASE WHEN x IS NOT NULL AND y IS NOT NULL THEN x END AS lat,
  CASE WHEN x BETWEEN 1 AND 4 AND x = floor(x) THEN CAST(CAST(x AS BIGINT) AS VARCHAR) END AS manual_price, CASE WHEN p_size % 2 = 0 THEN 'rooftop' END AS manual_setting, nullif(trim(b), '') AS manual_text,
  'outdoorseating=' || coalesce(b, '') AS attribute FROM v""")
def payload_fields(spark: SparkSession, d: str) -> DataFrame:
    a, b = F.col("a"), F.col("b")
    rows = _parts(spark, d, "p_size").withColumns({"a": pick(K(), *_NUMBERS), "b": pick(F.floor(K() / 8), *_NUMBERS)})
    entries = F.array(F.struct(F.lit("Outdoor Seating").alias("name"), a.alias("value")), F.struct(F.lit("outdoor_seating").alias("name"), b.alias("value")))
    setting = F.when(F.col("p_size") % 2 == 0, "Rooftop").otherwise("moon")
    return rows.select(
        "p_partkey", payload.veracity(a).cast("long").alias("veracity"), payload.nested_or_flat(a, b).alias("coordinate"),
        payload.point_of(F.lit(None).cast("array<double>"), a, b)["lat"].alias("lat"), payload.manual_value(F.lit("price_level"), a, []).alias("manual_price"),
        payload.manual_value(F.lit("setting_slug"), setting, ["rooftop"]).alias("manual_setting"), payload.manual_value(F.lit("name"), b, []).alias("manual_text"),
        F.concat(F.lit("outdoorseating="), F.coalesce(F.element_at(payload.attributes(entries), "outdoorseating"), F.lit(""))).alias("attribute"))


_TYPES = ("bar", "brewery", "taproom", "wine_bar", None, "winery", "tasting_room")
_BARS = sql_list(*classify.BAR_TYPES)


@R.query(f"""
WITH t AS (SELECT p_partkey, p_size, {sql_pick('p_partkey', *_TYPES)} AS a, {sql_pick('(p_partkey // 7)', *_TYPES)} AS b, {sql_pick('p_size', '312120', '722410', '999999')} AS naics,
  CASE WHEN p_partkey % 4 = 0 THEN p_name || ' Saloon' ELSE p_name END AS name FROM part),
f AS (SELECT *, list_contains({_BARS}, coalesce(a, '')) AND list_contains({_BARS}, coalesce(b, '')) AS bars, list_sort([coalesce(a, ''), coalesce(b, '')]) AS p FROM t)
SELECT p_partkey, a IS NULL OR b IS NULL OR a = b OR bars OR p IN (['brewery', 'taproom'], ['brewery', 'brewpub'], ['tasting_room', 'winery'], ['distillery', 'tasting_room']) AS compatible,
  CASE WHEN a IS NOT DISTINCT FROM b THEN a WHEN a IS NULL THEN b WHEN b IS NULL THEN a WHEN bars AND a <> 'bar' THEN a WHEN bars AND b <> 'bar' THEN 'bar' WHEN bars THEN 'bar'
    WHEN p = ['brewery', 'taproom'] THEN 'taproom' WHEN p = ['tasting_room', 'winery'] THEN 'tasting_room' END AS merged,
  CASE naics WHEN '312120' THEN 'brewery' ELSE CASE WHEN p_partkey % 4 = 0 THEN 'bar' END END AS by_naics,
  CAST(CASE WHEN naics = '312120' THEN 0.94 WHEN naics = '722410' THEN CASE WHEN p_partkey % 4 = 0 THEN 0.92 ELSE 0.78 END WHEN p_partkey % 4 = 0 THEN 0.9 ELSE 0 END AS DOUBLE) AS confidence FROM f""")
def type_rules(spark: SparkSession, d: str) -> DataFrame:
    a, b = pick(K(), *_TYPES), pick(F.floor(K() / 7), *_TYPES)
    name = F.when(K() % 4 == 0, F.concat("p_name", F.lit(" Saloon"))).otherwise(F.col("p_name"))
    by_code = classify.classify_naics(name, pick(F.col("p_size"), "312120", "722410", "999999"))
    return _parts(spark, d, "p_name", "p_size").select(
        "p_partkey", classify.types_compatible(a, b).alias("compatible"), classify.merged_type(a, F.lit(True), b, F.lit(False)).alias("merged"),
        by_code["type"].alias("by_naics"), by_code["confidence"].alias("confidence"))


@R.query("""
WITH q AS (SELECT p_partkey, p_size, p_retailprice / 2500 AS quality, p_partkey % 2 = 0 AS open, p_partkey % 3 <> 0 AS placed, p_partkey % 5 <> 0 AS consumer, p_partkey % 7 = 0 AS flagged FROM part)
SELECT p_partkey, open AND placed AND consumer AND NOT flagged AND quality >= 0.5 + 0.35 AS safe,
  round(least(0.99, 0.65 * greatest(quality, 0) + 0.35 * (p_size / 50.0) + CASE WHEN open THEN 0.03 ELSE 0 END), 9) AS combined FROM q""")
def creation_rules(spark: SparkSession, d: str) -> DataFrame:
    quality, is_open = F.col("p_retailprice") / 2500, K() % 2 == 0
    safe = gate.safe_to_create(
        F.lit("consumer_poi"), F.when(is_open, "open").otherwise("closed"), F.when(K() % 3 != 0, 1.0), F.lit(2.0), F.lit("pub"), K() % 5 != 0, F.lit("walk_in"),
        F.when(K() % 7 == 0, F.array(F.lit("duplicate"))).otherwise(F.array(F.lit("inappropriate"))), quality, classify.ACCESS_TYPES)
    combined = gate.combined_quality(quality, F.lit(None).cast("double"), is_open, F.col("p_size") / 50.0)
    return _parts(spark, d, "p_size", "p_retailprice").select("p_partkey", safe.alias("safe"), F.round(combined, 9).alias("combined"))
