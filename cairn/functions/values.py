"""Casts, dates, digests and other scalar rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Date patterns tried in order on the first 11 characters (a fixed value).
DATE_PATTERNS = ("dd-MMM-yyyy", "MM/dd/yyyy", "yyyy-MM-dd", "yyyyMMdd", "MMddyyyy")
# Families of sources; others are their own family.
SOURCE_FAMILIES = {
    "ca_abc": "government_regulator", "datasf": "government_registry", "overture": "consumer_poi",
    "fsq": "consumer_poi", "osm": "community", "overture_divisions": "community_boundary",
    "official_web": "first_party", "canonical_seed": "canonical_seed",
}


def bounded(value: Column, default: float = 0.0) -> Column:
    """A number within 0 and 1; the default for what is no number."""
    v = value.try_cast("double")
    return F.when(v.isNull(), default).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), v)))


def finite(value: Column) -> Column:
    """A double, null for NaN, infinities and what is no number."""
    v = value.try_cast("double")
    return F.when(~F.isnan(v) & (F.abs(v) != float("inf")), v)


def parse_date(text: Column, patterns: tuple[str, ...] = DATE_PATTERNS) -> Column:
    """The first pattern that fits the first 11 characters; else null."""
    head = F.trim(F.substring(text, 1, 11))
    return F.coalesce(*(F.try_to_timestamp(head, F.lit(p)) for p in patterns)).cast("date")


def parse_timestamp(text: Column) -> Column:
    """ISO date or time to a UTC timestamp; without a zone it is UTC; null if it is neither."""
    return F.try_to_timestamp(F.trim(text))


def latest_timestamp(texts: Column) -> Column:
    return F.array_max(F.transform(texts, parse_timestamp))


def wkt_point(text: Column) -> tuple[Column, Column]:
    """(latitude, longitude) of ``Point(lon lat)``."""
    pattern = r"(?i)point\s*\(\s*(-?[0-9.]+)\s+(-?[0-9.]+)\s*\)"
    return (F.nullif(F.regexp_extract(text, pattern, 2), F.lit("")).try_cast("double"),
            F.nullif(F.regexp_extract(text, pattern, 1), F.lit("")).try_cast("double"))


def truthy(text: Column) -> Column:
    return F.coalesce(F.lower(F.trim(text.cast("string"))).isin("1", "true", "yes", "y", "t"), F.lit(False))


def price_level(text: Column) -> Column:
    """1 to 4 from a number or one of four aliases."""
    t = F.lower(F.trim(text.cast("string")))
    level = F.when(t == "cheap", 1).when(t == "moderate", 2).when(t == "expensive", 3).when(t == "very expensive", 4)
    number = t.try_cast("int")
    return F.coalesce(F.when(number.between(1, 4), number), level)


def license_code(text: Column) -> Column:
    """Without leading zeros; ``0`` if nothing is left."""
    return F.coalesce(F.nullif(F.regexp_replace(F.trim(text.cast("string")), "^0+", ""), F.lit("")), F.lit("0"))


def source_family(source: Column) -> Column:
    pairs = [F.lit(x) for kv in SOURCE_FAMILIES.items() for x in kv]
    return F.coalesce(F.element_at(F.create_map(*pairs), source), source)


def payload_hash(**fields: Column) -> Column:
    """SHA-256 of compact JSON with sorted keys; nulls are kept as nulls."""
    ordered = F.struct(*(fields[k].alias(k) for k in sorted(fields)))
    return F.sha2(F.to_json(ordered, {"ignoreNullFields": "false"}), 256)


def digest(*columns: Column) -> Column:
    """SHA-256 of values joined by a separator that texts do not hold; null and empty differ."""
    return F.sha2(F.concat_ws("\x1f", *(F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("-")) for c in columns)), 256)


def rounded_coordinate(degrees: Column) -> Column:
    """Five places, halves upwards."""
    return F.floor(degrees * 100000 + 0.5) / 100000


def request_fingerprint(name: Column, lat: Column, lon: Column) -> Column:
    return F.concat(F.lit("v1:"), digest(name, rounded_coordinate(lat), rounded_coordinate(lon)))


def coordinate_key(degrees: Column) -> Column:
    return F.format_string("%.4f", degrees)


def fresh_within(at: Column, as_of: Column, days: int) -> Column:
    """Whether a time is at most so many days before as_of; unknown times are not fresh."""
    return F.coalesce(at >= as_of - F.make_dt_interval(F.lit(days)), F.lit(False))


def backoff_seconds(attempt: Column, base: float, most: float) -> Column:
    return F.least(F.lit(float(most)), base * F.pow(F.lit(2.0), attempt - 1))


def redact_error(text: Column, longest: int = 2000) -> Column:
    """Connection URLs hidden, and the text cut."""
    return F.substring(F.regexp_replace(text, r"(?i)postgres(?:ql)?://\S+", "[redacted]"), 1, longest)


def exactly_one(*columns: Column) -> Column:
    total = F.lit(0)
    for c in columns:
        total = total + c.isNotNull().cast("int")
    return total == 1


def subset(a: Column, b: Column) -> Column:
    return F.size(F.array_except(a, b)) == 0


def json_is_empty(text: Column) -> Column:
    """Null, JSON null, {} or []."""
    return F.coalesce(F.trim(text).isin("null", "{}", "[]", ""), F.lit(True))
