"""Provider payload fields: flags, settings, lists, attributes, provenance."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from cairn.functions.text import blank_to_null, slug
from cairn.functions.values import truthy

_NONE = "array<string>"
# Spellings of flags (without underscores), upstream origins by parts of a data set's name, licences by the same,
# and the paths at which a field's source items stand.
FLAG_ALIASES = {"doesntexist": "doesnt_exist", "doesnotexist": "does_not_exist", "privatevenue": "privatevenue"}
CDLA_PROVIDERS = ("brightquery", "dac", "krick", "meta", "microsoft", "pinmeto", "renderseo")
FIELD_PATHS = {
    "display_name": ("/names",),
    "address": ("/addresses",),
    "latitude": ("/geometry",),
    "longitude": ("/geometry",),
    "phone_e164": ("/phones",),
    "website_url": ("/websites",),
    "primary_type_slug": ("/basic_category", "/taxonomy", "/categories"),
    "operating_status": ("/operating_status",),
    "setting_slug": ("/basic_category", "/taxonomy", "/categories"),
}


def strings(value: Column) -> Column:
    """A list of strings without blanks, trimmed."""
    return F.filter(F.transform(value, lambda t: F.trim(t)), lambda t: t.isNotNull() & (t != ""))


def first_string(value: Column) -> Column:
    return F.get(strings(value), F.lit(0))


def flags_of_list(value: Column, aliases: dict[str, str] | None = None) -> Column:
    """Quality flags as slugs, with aliases resolved, each once and sorted."""
    names = F.transform(F.coalesce(strings(value), F.array().cast(_NONE)), slug)
    for old, new in (aliases or {}).items():
        names = _renamed(names, old, new)
    return F.array_sort(F.array_distinct(names))


def _renamed(names: Column, old: str, new: str) -> Column:
    return F.transform(names, lambda t: F.when(t == old, new).otherwise(t))


def quality_flags(value: Column) -> Column:
    """Quality flags of a list, with the known spellings brought to one; each once and sorted."""
    def known(t: Column) -> Column:
        compact = F.regexp_replace(t, "_", "")
        chain = F
        for old, new in FLAG_ALIASES.items():
            chain = chain.when(compact == old, new)
        return chain.otherwise(t)

    names = F.transform(F.coalesce(strings(value), F.array().cast(_NONE)), slug)
    return F.array_sort(F.array_distinct(F.transform(names, known)))


def flags_of_map(value: Column) -> Column:
    """Quality flags from a map of flags: those that are truthy."""
    return quality_flags(F.map_keys(F.map_filter(value, lambda k, v: truthy(v))))


def attribute_key(name: Column) -> Column:
    """Attribute names by letters and digits only, lower case."""
    return F.regexp_replace(F.lower(name), "[^a-z0-9]", "")


def attributes(entries: Column) -> Column:
    """A map from an array of (name, value) structs with canonical names; the last of equal names counts."""
    keyed = F.transform(entries, lambda e: F.struct(attribute_key(e["name"]).alias("k"), e["value"].alias("v")))
    keys = F.array_distinct(F.transform(keyed, lambda e: e["k"]))
    return F.map_from_arrays(keys, F.transform(keys, lambda k: F.element_at(F.filter(keyed, lambda e: e["k"] == k), -1)["v"]))


def _names(cases: list[tuple[Column, str]]) -> Column:
    """Names of the cases that hold, sorted."""
    return F.array_sort(F.array_compact(F.array(*(F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for c, n in cases))))


def settings_of_labels(labels: Column, outdoor: Column) -> Column:
    """Objective settings from category labels (taken as one text) and a boolean for outdoor seats."""
    text = F.lower(F.array_join(labels, " "))
    return _names([(outdoor.cast("boolean"), "outdoor_patio"), (text.contains("hotel bar"), "hotel"), (text.contains("rooftop"), "rooftop")])


def settings_of_tokens(tokens: Column) -> Column:
    """Objective settings from category tokens."""
    has = lambda *t: F.arrays_overlap(tokens, F.array(*(F.lit(x) for x in t)))
    return _names([(has("hotel_bar", "hotel_lounge"), "hotel"), (has("rooftop_bar", "rooftop_lounge"), "rooftop"),
                   (has("brewpub"), "production_premises"), (has("brewpub"), "restaurant_attached")])


def veracity(value: Column) -> Column:
    """An integer 1 to 5, else null."""
    n = value.try_cast("double")
    return F.when(n.between(1, 5) & (n == F.floor(n)), n.cast("int"))


def category_labels(ids: Column, labels: Column, more: Column) -> Column:
    """Labels of several shapes, order kept, each once."""
    empty = F.array().cast(_NONE)
    return F.array_distinct(strings(F.concat(*(F.coalesce(x, empty) for x in (ids, labels, more)))))


def nested_or_flat(flat: Column, nested: Column) -> Column:
    """A top-level number, else the nested one."""
    return F.coalesce(flat.try_cast("double"), nested.try_cast("double"))


def point_of(lon_lat: Column, lat: Column, lon: Column) -> Column:
    """struct(lat, lon) from a GeoJSON pair or two keys; a failure of either coordinate makes both null."""
    y = F.coalesce(F.get(lon_lat, F.lit(1)).try_cast("double"), lat.try_cast("double"))
    x = F.coalesce(F.get(lon_lat, F.lit(0)).try_cast("double"), lon.try_cast("double"))
    return F.when(x.isNotNull() & y.isNotNull(), F.struct(y.alias("lat"), x.alias("lon")))


def _any_in(text: Column, parts: tuple[str, ...]) -> Column:
    found = F.lit(False)
    for part in parts:
        found = found | text.contains(part)
    return found


def origin_of(dataset: Column) -> Column:
    """The upstream provider of a data set, so that copies of one provider are not independent evidence."""
    t = F.lower(dataset)
    return (F.when(t.contains("foursquare") | t.startswith("fsq"), "foursquare").when(_any_in(t, ("facebook", "meta")), "meta")
            .when(_any_in(t, ("microsoft", "bing")), "microsoft").when(t.contains("openstreetmap") | (t == "osm"), "openstreetmap")
            .otherwise(F.concat(F.lit("overture:"), t)))


def origin_keys(datasets: Column) -> Column:
    """Origins of data sets, each once and sorted; without any the origin is unknown."""
    found = F.array_sort(F.array_distinct(F.transform(F.filter(datasets, lambda d: F.coalesce(d, F.lit("")) != ""), origin_of)))
    return _held(found, lambda known: F.when(F.coalesce(F.size(known), F.lit(0)) > 0, known).otherwise(F.array(F.lit("overture:unknown"))))


def dataset_license(dataset: Column) -> Column:
    """A data set's licence where its items name none."""
    t = F.lower(dataset)
    return (F.when(t.contains("foursquare") | t.startswith("fsq"), "Apache-2.0")
            .when(t.contains("alltheplaces") | t.isin("overture", "overturemaps"), "CC0-1.0")
            .when(_any_in(t, CDLA_PROVIDERS), "CDLA-Permissive-2.0").otherwise("unknown"))


def item_license(dataset: Column, license_id: Column) -> Column:
    """A source item's licence, inferred from its data set where it names none."""
    return F.coalesce(F.nullif(license_id, F.lit("")), dataset_license(dataset))


def source_items(items: Column) -> Column:
    """Items that name a data set, as struct(dataset, record_id, property, license, update_time); empty texts are null."""
    given = lambda v: F.nullif(v, F.lit(""))
    return F.transform(F.filter(items, lambda i: given(i["dataset"]).isNotNull()), lambda i: F.struct(
        i["dataset"].alias("dataset"), given(i["record_id"]).alias("record_id"), given(i["property"]).alias("property"),
        item_license(i["dataset"], i["license"]).alias("license"), given(i["update_time"]).alias("update_time")))


def _held(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once a row, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def provenance_of(items: Column, paths: tuple[str, ...]) -> Column:
    """struct(origin_keys, license_ids, source_items) of a field: of the items at its paths and of those without a property."""
    return _held(source_items(items), lambda known: _provenance(known, paths))


def _provenance(known: Column, paths: tuple[str, ...]) -> Column:
    def relevant(i: Column) -> Column:
        at = F.lit(False)
        for path in paths:
            at = at | i["property"].startswith(path)
        return i["property"].isNull() | at

    return _held(F.filter(known, relevant), lambda own: F.struct(
        origin_keys(F.transform(own, lambda i: i["dataset"])).alias("origin_keys"),
        F.array_sort(F.array_distinct(F.transform(own, lambda i: i["license"]))).alias("license_ids"), own.alias("source_items")))


def field_provenance(items: Column) -> Column:
    """Provenance by field name; fields without a source item are left out."""
    entries = lambda known: F.array(*(F.struct(F.lit(f).alias("key"), _provenance(known, paths).alias("value")) for f, paths in FIELD_PATHS.items()))
    return F.map_from_entries(F.filter(_held(source_items(items), entries), lambda e: F.size(e["value"]["source_items"]) > 0))


def manual_value(field: Column, value: Column, known_settings: list[str]) -> Column:
    """A reviewer's value in its field's form, null if it has none."""
    v = blank_to_null(value)
    price = v.try_cast("int")
    return (F.when(field == "price_level", F.when(price.between(1, 4), price.cast("string")))
            .when(field == "setting_slug", F.when(slug(v).isin(*known_settings), slug(v))).otherwise(v))
