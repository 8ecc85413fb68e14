"""Web pages: titles, links and name claims."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType, StructField, StructType

from cairn.functions.text import normalize_name

# Reliability of a name by where a page states it, types of structured data that are places, meta entries that name the site,
# weights of what a page's text supports, and what parts a site's name from the rest of a title.
JSON_LD_PLACE, JSON_LD_OTHER, META_NAME, TITLE_NAME = 0.99, 0.92, 0.90, 0.76
PLACE_TYPES = ("localbusiness", "restaurant", "barorpub", "foodestablishment", "brewery", "winery", "nightclub")
META_KEYS = ("og:site_name", "application-name")
PHONE_WEIGHT, ADDRESS_WEIGHT, POSTAL_WEIGHT, CITY_WEIGHT = 0.68, 0.62, 0.18, 0.10
TITLE_PARTS = r"\s+[|\u2013\u2014-]\s+"

PAGE = StructType([
    StructField("title", StringType()), StructField("meta", ArrayType(StructType([StructField("name", StringType()), StructField("content", StringType())]))),
    StructField("links", ArrayType(StringType())), StructField("text", StringType()),
    StructField("names", ArrayType(StructType([StructField("name", StringType()), StructField("confidence", DoubleType()), StructField("origin", StringType())]))),
    StructField("everything", StringType())])
_TEXT = pa.string()
_PAGE_ARROW = pa.struct([
    ("title", _TEXT), ("meta", pa.list_(pa.struct([("name", _TEXT), ("content", _TEXT)]))), ("links", pa.list_(_TEXT)), ("text", _TEXT),
    ("names", pa.list_(pa.struct([("name", _TEXT), ("confidence", pa.float64()), ("origin", _TEXT)]))), ("everything", _TEXT)])
#: Bytes and number of pages that are parsed before their parts are handed on.
PIECE_BYTES, PIECE_PAGES = 4_000_000, 512


class _Page(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.title, self.text, self.links, self.meta, self.data = [], [], [], [], []
        self.all: list[str] = []
        self._in: str | None = None

    def handle_starttag(self, tag: str, attrs: list) -> None:
        a = dict(attrs)
        if tag == "a" and a.get("href"):
            self.links.append(a["href"])
        elif tag == "meta" and a.get("content"):
            self.meta.append((a.get("property") or a.get("name") or "", a["content"]))
        elif tag in ("title", "style", "script"):
            self._in = "json" if tag == "script" and (a.get("type") or "").lower() == "application/ld+json" else tag

    def handle_endtag(self, tag: str) -> None:
        if tag in ("title", "style", "script"):
            self._in = None

    def handle_data(self, data: str) -> None:
        if data.strip():
            self.all.append(data.strip())
        if self._in in (None, "title", "json"):
            {None: self.text, "title": self.title, "json": self.data}[self._in].append(data)


def _objects(value):
    """All objects of a JSON-LD value: lists, objects and their @graph."""
    if isinstance(value, list):
        for x in value:
            yield from _objects(x)
    elif isinstance(value, dict):
        yield value
        yield from _objects(value.get("@graph", []))


def _parse(html: str | None) -> dict | None:
    if html is None:
        return None
    page = _Page()
    page.feed(html)
    title, names = " ".join("".join(page.title).split()), []
    for block in page.data:
        try:
            found = list(_objects(json.loads(block)))
        except ValueError:
            continue
        for o in found:
            if not o.get("name") or isinstance(o["name"], (dict, list)):
                continue
            kinds = o.get("@type") or []
            kinds = {str(k).casefold() for k in (kinds if isinstance(kinds, list) else [kinds])}
            if kinds & set(PLACE_TYPES):
                names.append({"name": str(o["name"]).strip(), "confidence": JSON_LD_PLACE, "origin": "json_ld"})
            elif o.get("address") and "organization" in kinds:
                names.append({"name": str(o["name"]).strip(), "confidence": JSON_LD_OTHER, "origin": "json_ld"})
    said = {(n or "").casefold(): c.strip() for n, c in page.meta if c.strip()}
    names += [{"name": said[k], "confidence": META_NAME, "origin": "meta"} for k in META_KEYS if k in said]
    first = re.split(TITLE_PARTS, title, maxsplit=1)[0].strip()
    if 2 <= len(first) <= 100:
        names.append({"name": first, "confidence": TITLE_NAME, "origin": "title"})
    return {"title": title or None, "meta": [{"name": n, "content": c} for n, c in page.meta], "links": page.links,
            "text": " ".join(" ".join(page.text).split()), "names": names, "everything": " ".join(" ".join(page.all).split())}


def _pieces(html: pa.Array) -> Iterator[pa.Array]:
    """What ``_parse`` gives of pages, piece by piece: a page's parts are held as objects only while its piece is parsed."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(html), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    lo = 0
    while lo < len(html):
        hi = int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + PIECE_BYTES, "right"))
        hi = max(lo + 1, min(hi, lo + PIECE_PAGES))
        yield pa.array([_parse(h) or dict.fromkeys(PAGE.names) for h in html.slice(lo, hi - lo).to_pylist()], type=_PAGE_ARROW)
        lo = hi


def parsed_pages(pages: DataFrame, *fields: str, html: str = "html") -> DataFrame:
    """The rows with these fields of ``PAGE`` in place of ``html``; they are handed on by pieces, so a task holds no more at any number of pages."""
    kept = [c for c in pages.columns if c != html]
    schema = StructType([*(pages.schema[c] for c in kept), *(PAGE[f] for f in fields)])

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for piece in _pieces(batch.column(html)):
                rows = batch.slice(at, len(piece))
                at += len(piece)
                yield pa.RecordBatch.from_arrays([*(rows.column(c) for c in kept), *(piece.field(f) for f in fields)], names=schema.names)

    return pages.mapInArrow(parse, schema)


@F.arrow_udf(PAGE)
def parse_page(html: pa.Array) -> pa.Array:
    """Title, meta entries, links, text, name claims and all text with scripts and styles of a page; null html gives nulls."""
    return pa.concat_arrays([pa.array([], type=_PAGE_ARROW), *_pieces(html)])


@F.arrow_udf(PAGE["names"].dataType)
def page_names(html: pa.Array) -> pa.Array:
    """The name claims of a page alone; null html gives none."""
    names = [pc.fill_null(piece.field("names"), pa.scalar([], type=_PAGE_ARROW.field("names").type)) for piece in _pieces(html)]
    return pa.concat_arrays([pa.array([], type=_PAGE_ARROW.field("names").type), *names])


def page_title(html: Column) -> Column:
    """The text of the title element as it stands, by pattern; null if there is none."""
    return F.nullif(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1), F.lit(""))


def page_language(html: Column) -> Column:
    return F.nullif(F.regexp_extract(html, r"(?is)<html[^>]*\blang=[\"']?([a-z-]+)", 1), F.lit(""))


def link_count(html: Column) -> Column:
    return F.regexp_count(html, F.lit("(?i)<a [^>]*href="))


def name_claims(pages: DataFrame, key: str, html: str = "html", ascii_words: bool = False) -> DataFrame:
    """``key, normalized_name, name, confidence, origin``: the best claim of each normalized name of each page; ``ascii_words`` as in ``normalize_name``."""
    claims = pages.select(key, F.explode(page_names(F.col(html))).alias("c")).select(
        key, normalize_name(F.col("c.name"), ascii_words=ascii_words).alias("normalized_name"), "c.confidence", "c.name", "c.origin").where("normalized_name <> ''")
    best = F.max(F.struct("confidence", "name", "origin")).alias("b")
    return claims.groupBy(key, "normalized_name").agg(best).select(key, "normalized_name", "b.name", "b.confidence", "b.origin")


def identity_score(text: Column, phones: Column, address: Column, postal_code: Column, city: Column) -> Column:
    """How well a page's text supports a place, at most 1: one of its phones, its address, its postal code, its city.

    A phone counts by its last ten digits; an address, normalized, by its first number together
    with one of its first three words of four letters or more.
    """
    low = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"\s+", " ")
    digits = F.regexp_replace(low, "[^0-9]", "")
    held = lambda c: F.coalesce(F.length(c) > 0, F.lit(False)) & low.contains(F.lower(c))
    by_phone = F.exists(F.filter(F.coalesce(phones, F.array().cast("array<string>")), lambda p: F.coalesce(p, F.lit("")) != ""),
                        lambda p: digits.contains(F.right(F.regexp_replace(p, "[^0-9]", ""), F.lit(10))))
    words = F.slice(F.filter(F.split(address, " "), lambda w: (F.length(w) >= 4) & ~w.rlike("^[0-9]+$")), 1, 3)
    number = F.regexp_extract(address, r"\b[0-9]+\b", 0)
    by_address = held(number) & F.exists(words, lambda w: low.contains(w))
    part = lambda c, w: F.when(F.coalesce(c, F.lit(False)), w).otherwise(0.0)
    return F.least(F.lit(1.0), part(by_phone, PHONE_WEIGHT) + part(by_address, ADDRESS_WEIGHT) + part(held(postal_code), POSTAL_WEIGHT)
                   + part(held(city), CITY_WEIGHT))
