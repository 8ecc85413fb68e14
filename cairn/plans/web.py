"""Places and their own sites, over the given pages.

Every host is a place: its websites are its first and its last page, and what
its last page's title says stands for city, postal code and address.  A page is
also known under the words of its title, so that links lead to pages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.functions import hours, text
from cairn.operators import official_web
from cairn.plans.matching import _ADDRESS, _CLEAN
from cairn.plans.registry import Registry
from cairn.sources import pages as web
from cairn.sources.shared import written
from cairn.sources.tables import table

R = Registry()

_DECODED = "replace(replace(replace(replace({c}, '&copy;', '©'), '&middot;', '·'), '&quot;', chr(34)), '&amp;', '&')"
_FLAT = _DECODED.format(c="regexp_replace(regexp_replace(html, '<[^>]*>', ' ', 'g'), '\\s+', ' ', 'g')")
_TITLE = f"trim(regexp_replace({_DECODED.format(c=chr(114) + 'egexp_extract(html, ' + chr(39) + '(?is)<title[^>]*>(.*?)</title>' + chr(39) + ', 1)')}, '\\s+', ' ', 'g'))"
_ZONES = ("America/Los_Angeles", "UTC", "Mars/Base")

_PLACES = rf"""
pg AS (SELECT page_id, url, lower({_FLAT}) AS low, {_TITLE} AS title, html, regexp_extract(url, '^([A-Za-z]+://[^/?#]*)', 1) AS site,
  regexp_replace(lower(regexp_extract(url, '://([^/?#]*)', 1)), '^www\.', '') AS host FROM pages WHERE html IS NOT NULL AND url IS NOT NULL),
named AS (SELECT *, list_filter(string_split(title, ' '), lambda w: regexp_full_match(w, '\p{{L}}+')) AS tokens, [lower(w) for w in tokens] AS t FROM pg),
place AS (SELECT host, min(page_id) AS first_page, max(page_id) AS last_page, arg_max(coalesce(t[1], ''), page_id) AS city, arg_max(coalesce(t[2], ''), page_id) AS postal,
  arg_max(trim('0 ' || array_to_string(t[3:8], ' ')), page_id) AS address, arg_max(regexp_extract(low, '[0-9]{{7,}}'), page_id) AS phone FROM named GROUP BY host),
norm AS (SELECT *, {_ADDRESS.format(c=_CLEAN.format(c='address'))} AS addr FROM place),
support AS (SELECT page_id, p.host, round(least(1.0,
    CASE WHEN phone <> '' AND contains(regexp_replace(low, '[^0-9]', '', 'g'), right(phone, 10)) THEN {web.PHONE_WEIGHT} ELSE 0 END
  + CASE WHEN contains(low, regexp_extract(addr, '\b[0-9]+\b')) AND len(list_filter(list_filter(string_split(addr, ' '), lambda w: length(w) >= 4 AND NOT regexp_full_match(w, '[0-9]+'))[1:3],
      lambda w: contains(low, w))) > 0 THEN {web.ADDRESS_WEIGHT} ELSE 0 END
  + CASE WHEN postal <> '' AND contains(low, postal) THEN {web.POSTAL_WEIGHT} ELSE 0 END + CASE WHEN city <> '' AND contains(low, city) THEN {web.CITY_WEIGHT} ELSE 0 END), 6) AS identity
  FROM pg p JOIN norm ON norm.host = p.host)"""


def _pages(spark: SparkSession, d: str) -> DataFrame:
    """Parsed pages with the words of their titles, written once."""
    p = table(spark, d, "pages", "page_id", "url", "html").where("html IS NOT NULL AND url IS NOT NULL")
    parsed = web.parsed_pages(p.select("page_id", "url", text.website_host(F.col("url")).alias("host"), "html"), "title", "links", "names", "everything")
    tokens = F.filter(F.split(F.coalesce("title", F.lit("")), " "), lambda w: w.rlike(r"^\p{L}+$"))
    return written(parsed.select("page_id", "url", "host", F.col("everything").alias("text"), "links", "names", tokens.alias("tokens")), "pages")


def _places(pages: DataFrame) -> DataFrame:
    at = lambda i: F.lower(F.get("tokens", F.lit(i)))
    last = lambda c: F.max_by(c, "page_id")
    address = F.trim(F.concat(F.lit("0 "), F.lower(F.array_join(F.slice("tokens", 3, 6), " "))))
    phone = F.regexp_extract("text", "[0-9]{7,}", 0)
    return pages.groupBy("host").agg(
        F.array(F.min_by("url", "page_id"), last(F.col("url"))).alias("websites"), last(at(0)).alias("city"), last(at(1)).alias("postal_code"),
        last(address).alias("address"), last(F.array(phone)).alias("phones"))


def _identity() -> Column:
    return F.round(web.identity_score(F.col("text"), F.col("phones"), F.col("address"), F.col("postal_code"), F.col("city")), 6)


@R.query(rf"""
WITH {_PLACES.strip()}
SELECT page_id, CAST(identity AS DOUBLE) AS score, page_id % 4 < 2 AS timezone FROM support""")
def page_identity(spark: SparkSession, d: str) -> DataFrame:
    pages = _pages(spark, d)
    about = _places(pages).withColumn("address", text.normalize_address(F.col("address")))
    zone = F.get(F.array(*map(F.lit, _ZONES)), (F.col("page_id") % 4).cast("int"))
    return pages.join(about, "host").select("page_id", _identity().alias("score"), hours.valid_timezone(zone).alias("timezone"))


_ROUND = """
{front}_links AS (SELECT f.start, f.turn AS of, generate_subscripts(hrefs, 1) AS at, unnest(hrefs) AS href, site, host, city FROM {source} f JOIN (
    SELECT page_id, site, host, regexp_extract_all(html, '(?i)<a [^>]*href="([^"]*)"', 1) AS hrefs FROM pg) USING (page_id) JOIN (SELECT DISTINCT host, city FROM norm) USING (host)),
{front}_met AS (SELECT l.start, k.page_id, min((l.of, l.at)) AS met FROM {front}_links l JOIN keys k
    ON k.key = l.host || regexp_replace(regexp_extract(DECODED, '^[^?#]*'), '/+$', '')
  WHERE len(list_filter(list_concat([city], ['location', 'locations', 'taproom', 'visit', 'contact']), lambda w: w <> '' AND contains(lower(site || DECODED), w))) > 0
    AND NOT EXISTS (SELECT 1 FROM {before} r WHERE r.start = l.start AND r.page_id = k.page_id) GROUP BY 1, 2),
{front} AS (SELECT m.start, page_id, n + k - 1 AS turn FROM (SELECT *, row_number() OVER (PARTITION BY start ORDER BY met, page_id) AS k FROM {front}_met) m
  JOIN (SELECT start, count(*) AS n FROM {before} GROUP BY 1) c USING (start) WHERE n + k <= 4),
{after} AS (SELECT * FROM {before} UNION ALL SELECT * FROM {front})""".replace("DECODED", _DECODED.format(c="href"))


@R.query(rf"""
WITH {_PLACES.strip()},
own AS (SELECT page_id, host || regexp_replace(regexp_extract(url, '^[^:/?#]+://[^/?#]*([^?#]*)', 1), '/+$', '') || (
  CASE WHEN kept = '' THEN '' ELSE '?' || kept END) AS key FROM (SELECT *, array_to_string([q for q in string_split(regexp_extract(url, '\?([^#]*)', 1), '&')
    IF strpos(q, '=') > 0 AND length(split_part(q, '=', 2)) > 0 AND NOT regexp_matches(split_part(q, '=', 1), '^(utm_|y_source$|fbclid$|gclid$)', 'i')], '&') AS kept FROM pg)),
keys AS (SELECT key, min(page_id) AS page_id FROM (SELECT key, page_id FROM own UNION ALL SELECT host || '/' || unnest(tokens), page_id FROM named) GROUP BY key),
begun AS (SELECT host, n AS start_no, key AS start FROM (SELECT host, 0 AS n, first_page AS page_id FROM place UNION ALL SELECT host, 1, last_page FROM place) JOIN own USING (page_id)
  QUALIFY row_number() OVER (PARTITION BY host, key ORDER BY n) = 1),
r0 AS (SELECT DISTINCT start, page_id, 0 AS turn FROM begun JOIN keys ON keys.key = begun.start),
{_ROUND.format(front='f1', source='r0', before='r0', after='r1').strip()},
{_ROUND.format(front='f2', source='f1', before='r1', after='r2').strip()},
claims AS (SELECT b.host, start_no, page_id, turn, identity, trim(regexp_replace(title, '\s+[|–—-]\s+.*$', '')) AS name, {web.TITLE_NAME} AS confidence
  FROM begun b JOIN r2 USING (start) JOIN support s USING (page_id) JOIN pg USING (page_id) WHERE s.host = b.host AND identity >= 0.75)
SELECT host, name, page_id, CAST(identity AS DOUBLE) AS identity, CAST(confidence AS DOUBLE) AS confidence FROM claims WHERE length(name) BETWEEN 2 AND 100
QUALIFY row_number() OVER (PARTITION BY host ORDER BY start_no, identity DESC, turn) = 1""")
def official_web_names(spark: SparkSession, d: str) -> DataFrame:
    pages = _pages(spark, d)
    own = pages.select(official_web.page_key(F.col("url")).alias("key"), F.col("page_id").alias("page"), "url")
    titled = pages.select(F.explode("tokens").alias("w"), "host", F.col("page_id").alias("page"), "url").select(F.concat("host", F.lit("/"), "w").alias("key"), "page", "url")
    keys = own.unionByName(titled).groupBy("key").agg(F.min("page").alias("page"), F.min_by("url", "page").alias("url"))
    links = pages.select(F.col("page_id").alias("page"), F.posexplode("links").alias("at", "href"))
    contents = pages.select(F.col("page_id").alias("page"), "text", "names")
    found = official_web.official_names(_places(pages), written(keys, "keys"), links, contents, "host", hops=2)
    return found.select("host", "name", F.col("page").alias("page_id"), F.round("identity", 6).alias("identity"), "confidence")
