"""Text normalizers, as column expressions unless Unicode folding is asked for."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Legal suffixes, address abbreviations (in this order) and tracking parameters.
LEGAL_SUFFIXES = ("llc", "inc", "incorporated", "corp", "corporation", "ltd", "limited", "lp", "llp")
ADDRESS_WORDS = (
    ("street", "st"), ("avenue", "ave"), ("boulevard", "blvd"), ("road", "rd"), ("drive", "dr"),
    ("lane", "ln"), ("highway", "hwy"), ("north", "n"), ("south", "s"), ("east", "e"), ("west", "w"),
    ("suite", "ste"), ("apartment", "apt"),
)
TRACKING_PARAMETER = r"(?i)^(?:utm_|y_source$|fbclid$|gclid$)"
_SUFFIX = "|".join(LEGAL_SUFFIXES)


@F.pandas_udf(StringType())
def fold_unicode(values: pd.Series) -> pd.Series:
    """NFKC and case folding, which Spark has no expression for."""
    return values.map(lambda v: unicodedata.normalize("NFKC", v).casefold(), na_action="ignore")


def fold(text: Column, unicode: bool = False) -> Column:
    """Case folding: by Arrow with NFKC, or natively with the one common letter on which ``lower`` differs."""
    return fold_unicode(text) if unicode else F.regexp_replace(F.lower(text), "ß", "ss")


def clean_text(text: Column, unicode: bool = False) -> Column:
    """Folded words separated by single spaces; ``&`` becomes ``and``, other punctuation a space; null gives ''."""
    t = F.regexp_replace(fold(F.coalesce(text, F.lit("")), unicode), "&", " and ")
    t = F.regexp_replace(t, r"[^\p{L}\p{N}\p{M}_\s]", " ")
    return F.trim(F.regexp_replace(t, r"\s+", " "))


def normalize_name(text: Column, unicode: bool = False, ascii_words: bool = False) -> Column:
    """Clean text without one legal suffix at its end; with ``ascii_words`` a suffix may also follow a letter beyond ASCII."""
    before = "(?<![A-Za-z0-9_])" if ascii_words else r"\b"
    return F.trim(F.regexp_replace(clean_text(text, unicode), rf"{before}(?:{_SUFFIX})\.?$", ""))


def display_name(text: Column) -> Column:
    """The name in its own capitals without a legal suffix, unless nothing else is left."""
    original = F.trim(F.coalesce(text, F.lit("")))
    cut = F.regexp_replace(F.regexp_replace(original, rf"(?i)(?:,\s*|\s+)(?:{_SUFFIX})\.?$", ""), r"[ ,]+$", "")
    return F.when(cut == "", original).otherwise(cut)


def normalize_address(text: Column, unicode: bool = False) -> Column:
    """Clean text with the usual abbreviations of street words."""
    t = clean_text(text, unicode)
    for word, short in ADDRESS_WORDS:
        t = F.regexp_replace(t, rf"\b{word}\b", short)
    return t


def normalize_phone(phone: Column, country: Column | None = None) -> Column:
    """``+`` and digits: 10 or 11 (leading 1) digits in the US, else 8 to 15; null for others."""
    digits = F.regexp_replace(phone, r"[^0-9]", "")
    n = F.length(digits)
    us = F.lit(True) if country is None else country == "US"
    return (
        F.when(us & (n == 10), F.concat(F.lit("+1"), digits))
        .when(us & (n == 11) & digits.startswith("1"), F.concat(F.lit("+"), digits))
        .when(n.between(8, 15), F.concat(F.lit("+"), digits))
    )


def _url_parts(url: Column) -> tuple[Column, Column, Column, Column]:
    raw = F.trim(url)
    raw = F.when(F.instr(raw, "://") > 0, raw).otherwise(F.concat(F.lit("https://"), raw))
    part = lambda group: F.regexp_extract(raw, r"^([^:/?#]+)://([^/?#]*)([^?#]*)(?:\?([^#]*))?", group)
    return F.lower(part(1)), part(2), part(3), part(4)


def website_host(url: Column) -> Column:
    """Host of a URL, lower case, without user, port and a leading ``www.``; null if none."""
    _, netloc, _, _ = _url_parts(url)
    host = F.lower(F.regexp_replace(F.regexp_replace(netloc, r"^.*@", ""), r":[0-9]*$", ""))
    return F.nullif(F.regexp_replace(host, r"^www\.", ""), F.lit(""))


def normalize_url(url: Column) -> Column:
    """Scheme (https by default), host, port unless usual, path without end slash, query without tracking."""
    scheme, netloc, path, query = _url_parts(url)
    port = F.regexp_extract(netloc, r":([0-9]+)$", 1)
    usual = (port == "") | ((scheme == "https") & (port == "443")) | ((scheme == "http") & (port == "80"))
    kept = F.array_join(F.filter(F.split(query, "&"), lambda p: F.length(F.substring_index(p, "=", -1)) * F.instr(p, "=") > 0), "&")
    kept = F.array_join(F.filter(F.split(kept, "&"), lambda p: ~F.substring_index(p, "=", 1).rlike(TRACKING_PARAMETER)), "&")
    host = website_host(url)
    return F.when(host.isNotNull(), F.concat(
        scheme, F.lit("://"), host, F.when(usual, "").otherwise(F.concat(F.lit(":"), port)),
        F.regexp_replace(path, "/+$", ""), F.when(kept == "", "").otherwise(F.concat(F.lit("?"), kept))))


def resolve_url(base: Column, href: Column) -> Column:
    """The absolute URL of a reference on a page: RFC 3986 with dot segments removed; a null side gives null."""
    href = F.trim(href)
    start = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    path, query = F.regexp_extract(base, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1), F.regexp_extract(base, r"^[^?#]*(\?[^#]*)", 1)
    own, rest = F.regexp_extract(href, r"^([^?#]*)", 1), F.regexp_extract(href, r"^[^?#]*(.*)$", 1)
    merged = F.when(own.startswith("/"), own).otherwise(F.concat(F.regexp_replace(F.when(path == "", "/").otherwise(path), "[^/]*$", ""), own))
    kept = F.aggregate(F.slice(F.split(merged, "/"), 2, F.size(F.split(merged, "/"))), F.array().cast("array<string>"), lambda seen, x: F.when(
        x == "..", F.slice(seen, 1, F.greatest(F.size(seen) - 1, F.lit(0)))).when(x == ".", seen).otherwise(F.concat(seen, F.array(x))))
    ended = F.when(merged.rlike(r"(^|/)\.\.?$"), F.lit("/")).otherwise("")
    flat = F.concat(F.lit("/"), F.array_join(kept, "/"))
    return (
        F.when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), href)
        .when(href.startswith("//"), F.concat(F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*:)", 1), href))
        .when(own == "", F.concat(start, path, F.when(rest.startswith("?"), rest).otherwise(F.concat(query, rest))))
        .otherwise(F.concat(start, F.regexp_replace(F.concat(flat, ended), "^/{2,}$", "/"), rest))
    )


def blank_to_null(text: Column) -> Column:
    return F.nullif(F.trim(text), F.lit(""))


def first_filled(*texts: Column) -> Column:
    """The first value that is neither null nor blank, trimmed."""
    return F.coalesce(*(blank_to_null(t) for t in texts))


def join_filled(*texts: Column, separator: str = " ") -> Column:
    """Filled values joined by a separator."""
    return F.concat_ws(separator, *(blank_to_null(t) for t in texts))


def slug(text: Column) -> Column:
    """Lower case, runs of anything but letters and digits become one underscore, none at the ends."""
    return F.regexp_replace(F.regexp_replace(F.lower(F.trim(text)), "[^a-z0-9]+", "_"), "^_+|_+$", "")


def name_tokens(text: Column) -> Column:
    """Distinct words of a normalized name without stop words."""
    stop = F.array(*(F.lit(w) for w in ("the", "and", "at", "sf")))
    return F.array_except(F.array_distinct(F.split(normalize_name(text), " ")), F.array_union(stop, F.array(F.lit(""))))


def names_compatible(a: Column, b: Column, overlap: float = 0.5) -> Column:
    """Token texts equal or contained, or at least ``overlap`` of the smaller set shared; empty ones never."""
    x, y = name_tokens(a), name_tokens(b)
    least = F.least(F.size(x), F.size(y))
    s, t = F.array_join(x, " "), F.array_join(y, " ")
    return (least > 0) & (s.contains(t) | t.contains(s) | (F.size(F.array_intersect(x, y)) >= overlap * least))


def price_symbols(text: Column) -> Column:
    """Number of ``$`` signs if the text is one to four of them, else null."""
    return F.when(text.rlike(r"^\${1,4}$"), F.length(text))


def safe_url(url: Column, longest: int = 2048) -> Column:
    """Whether a URL is http(s) and not too long."""
    return F.coalesce(url.rlike("(?i)^https?://[^/?#]+") & (F.length(url) <= longest), F.lit(False))


def is_e164(phone: Column) -> Column:
    return F.coalesce(F.regexp_replace(phone, r"[\s().-]", "").rlike(r"^\+[1-9][0-9]{7,14}$"), F.lit(False))
