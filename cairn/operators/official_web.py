"""Official-web check: names that a place's own site states, from pages that speak of the place.

A site is opened at each of a place's websites in turn.  From a start page the
frontier follows links of the same host that look like pages about locations,
at most a few pages a site; what is walked is one (start, city) however many
places share it.  Pages are a table of what was fetched, by URL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cairn.functions.text import normalize_address, normalize_url, resolve_url, website_host
from cairn.sources.pages import identity_score
from cairn.sources.shared import written

# Websites tried for a place, pages of a site, least identity of a page that may name a place, and what a followed link says.
MOST_STARTS = 3
MOST_PAGES = 4
LEAST_IDENTITY = 0.75
LINK_WORDS = ("location", "locations", "taproom", "visit", "contact")


def page_key(url: Column) -> Column:
    """A normalized URL without its scheme: what pages and links meet by."""
    return F.regexp_replace(normalize_url(url), "^[a-z][a-z0-9+.-]*://", "")


def candidate_starts(places: DataFrame, entity: str, websites: str) -> DataFrame:
    """``entity, start_no`` (from 0) and ``start`` (page key): the first distinct websites of each place, in order."""
    keys = F.array_distinct(F.filter(F.transform(websites, page_key), lambda k: k.isNotNull()))
    return places.select(entity, F.posexplode(F.slice(keys, 1, MOST_STARTS)).alias("start_no", "start"))


def walk_sites(starts: DataFrame, pages: DataFrame, links: DataFrame, hops: int = 1, most: int = MOST_PAGES) -> DataFrame:
    """``start, city, page, turn`` (from 0): the pages of each site in the order in which they are met.

    starts: ``start`` (page key), ``city``; pages: ``key``, ``page``, ``url``, where several keys may lead to one
    page; links: ``page``, ``at``, ``href``.  A link is followed if it stays on its page's host and its URL holds a
    word of the city or of ``LINK_WORDS``; links go in the order of their pages and places, each page is
    taken once, and a site ends with ``most`` pages or after ``hops`` rounds.  Each round joins what the
    last one found with its links.
    """
    sites = starts.select("start", "city").distinct()
    first = sites.join(pages.select(F.col("key").alias("start"), "page", "url"), "start").withColumn("turn", F.lit(0).cast("long"))
    reached, front = written(first, "sites"), None
    for _ in range(hops):
        front = reached if front is None else front
        followed = front.join(links, "page").withColumn("to", resolve_url(F.col("url"), F.col("href")))
        low = F.lower("to")
        words = F.filter(F.split(F.concat_ws(" ", F.lower("city"), *map(F.lit, LINK_WORDS)), r"\s+"), lambda w: w != "")
        followed = followed.where(website_host(F.col("to")) == website_host(F.col("url"))).where(F.exists(words, lambda w: low.contains(w)))
        found = followed.select("start", "city", F.col("turn").alias("of"), "at", page_key(F.col("to")).alias("key")).join(pages, "key")
        earliest = found.groupBy("start", "city", "page").agg(F.min(F.struct("of", "at")).alias("met"), F.first("url").alias("url"))
        fresh = earliest.join(reached.select("start", F.col("city").alias("_c"), "page"), (
            (earliest["start"] == reached["start"]) & earliest["city"].eqNullSafe(F.col("_c")) & (earliest["page"] == reached["page"])), "left_anti")
        full = reached.groupBy("start", "city").agg(F.count("*").alias("n"))
        w = Window.partitionBy("start", "city").orderBy("met", "page")
        ranked = fresh.withColumn("k", F.row_number().over(w)).where(F.col("k") < most).alias("f").join(
            full.alias("s"), (F.col("f.start") == F.col("s.start")) & F.col("f.city").eqNullSafe(F.col("s.city"))).select("f.*", "n")
        front = written(ranked.where(F.col("n") + F.col("k") <= most).select(
            "start", "city", "page", "url", (F.col("n") + F.col("k") - 1).alias("turn")), "front")
        if front.isEmpty():
            break
        reached = written(reached.unionByName(front), "sites")
    return reached.select("start", "city", "page", "turn")


def official_names(places: DataFrame, pages: DataFrame, links: DataFrame, contents: DataFrame, entity: str, hops: int = 1) -> DataFrame:
    """``entity, name, page, start_no, identity, confidence``: the best name of the first site that states one.

    places: ``entity``, ``city``, ``address``, ``postal_code``, ``phones``, ``websites``; pages and links as in ``walk_sites``;
    contents: ``page``, ``text``, ``names`` (array of name, confidence).  A page names a place only from an identity of
    ``LEAST_IDENTITY`` on; of a site's names the one of the greatest product of both wins, ties going to the
    earlier page and the earlier name.  Places without a usable site have no row.
    """
    starts = candidate_starts(places, entity, "websites")
    about = places.select(entity, "city", "phones", normalize_address(F.col("address")).alias("address"), "postal_code")
    wanted = written(starts.join(about, entity), "starts")
    walked = walk_sites(wanted, pages, links, hops).alias("w")
    pairs = wanted.alias("p").join(walked, (F.col("p.start") == F.col("w.start")) & F.col("p.city").eqNullSafe(F.col("w.city"))).select("p.*", "w.page", "w.turn")
    read = pairs.join(contents, "page").withColumn("identity", identity_score(
        F.col("text"), F.col("phones"), F.col("address"), F.col("postal_code"), F.col("city")))
    claims = read.where(F.col("identity") >= LEAST_IDENTITY).select(entity, "start_no", "page", "turn", "identity", F.posexplode("names").alias("at", "c"))
    order = F.struct((F.col("c.confidence") * F.col("identity")).alias("product"), (-F.col("turn")).alias("turn"), (-F.col("at")).alias("at"))
    best = claims.groupBy(entity, "start_no").agg(F.max_by(F.struct(F.col("c.name").alias("name"), "page", "start_no", "identity", F.col("c.confidence").alias("confidence")), order).alias("b"))
    return best.groupBy(entity).agg(F.min_by("b", "start_no").alias("b")).select(entity, "b.*")
