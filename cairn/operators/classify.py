"""Classification of places by licence, industry code, category tokens and name."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from cairn.functions.values import license_code

# Licence codes, industry codes, category tokens and name patterns with their types, in order.
LICENSE_TYPES = {"2": "winery", "23": "brewery", "74": "distillery"}
LICENSE_BAR_CODES = ("40", "41", "42", "47", "48", "61", "87")
LICENSE_BREWPUB_CODES = ("75",)
NAICS_TYPES = {"312120": "brewery", "312130": "winery", "312140": "distillery"}
NAICS_BAR_CODES = ("722410",)
TOKEN_TYPES = {
    "cocktail_bar": "cocktail_bar", "dive_bar": "dive_bar", "wine_bar": "wine_bar", "beer_bar": "beer_bar",
    "sports_bar": "sports_bar", "pub": "pub", "lounge": "lounge", "nightclub": "nightclub",
    "night_club": "nightclub", "hotel_bar": "bar", "tiki_bar": "cocktail_bar", "speakeasy": "cocktail_bar",
    "beer_garden": "beer_bar", "irish_pub": "pub", "gastropub": "pub", "brewery": "brewery", "taproom": "taproom",
    "tap_room": "taproom", "brewpub": "brewpub", "brew_pub": "brewpub", "winery": "winery",
    "tasting_room": "tasting_room", "distillery": "distillery",
}
GENERIC_BAR_TOKENS = ("bar", "drinking_place", "drinking_places")
BAR_TYPES = ("bar", "cocktail_bar", "dive_bar", "wine_bar", "beer_bar", "sports_bar", "pub", "lounge", "nightclub")
ACCESS_TYPES = (*BAR_TYPES, "taproom", "tasting_room", "brewpub")
MANUFACTURER_TYPES = ("brewery", "winery", "distillery")
CONSUMER_TYPES = (*ACCESS_TYPES, *MANUFACTURER_TYPES)
NAME_PATTERNS = (
    (r"\bcocktail\s+bar\b", "cocktail_bar", 0.98), (r"\bdive\s+bar\b", "dive_bar", 0.98),
    (r"\bsports?\s+bar\b", "sports_bar", 0.98), (r"\bbeer\s+bar\b", "beer_bar", 0.97),
    (r"\bbrewpub\b|\bbrew\s+pub\b", "brewpub", 0.98), (r"\btap\s*room\b", "taproom", 0.97),
    (r"\btasting\s+room\b", "tasting_room", 0.96), (r"\bwinery\b|\bvineyards?\b", "winery", 0.97),
    (r"\bdistiller(?:y|ies)\b", "distillery", 0.98), (r"\bbrewery\b|\bbrewing\b", "brewery", 0.96),
    (r"\bwine\s+bar\b", "wine_bar", 0.96), (r"\bnight\s*club\b", "nightclub", 0.97),
    (r"\blounge\b", "lounge", 0.91), (r"\bpub\b", "pub", 0.93), (r"\bsaloon\b", "bar", 0.92), (r"\bbar\b", "bar", 0.88),
)
LICENSES_OF_TYPE = {
    **{t: ("40", "42", "48", "61", "41", "47", "87") for t in BAR_TYPES},
    "brewery": ("1", "23"), "taproom": ("1", "23"), "winery": ("2",), "distillery": ("74",),
    "tasting_room": ("2", "74"), "brewpub": ("1", "23", "75"),
}
COMPATIBLE_TYPES = (("brewery", "taproom"), ("brewery", "brewpub"), ("winery", "tasting_room"), ("distillery", "tasting_room"))
COMBINED_TYPE_CAP = 0.94
# Categories that contradict any drinking place, or a bar; types that a restaurant category does not contradict.
HARD_CONFLICTS = (
    "apartment_or_condo", "cafe", "caf", "cafe_coffee_and_tea_house", "coffee_shop", "comedy_club", "country_club", "fitness_center",
    "food_court", "gym", "gym_and_studio", "harbor_or_marina", "hostel", "lodging", "motel", "office", "performing_arts_venue",
    "residential_building", "residential_building_or_home", "social_club", "tech_startup", "theater",
)
BAR_RETAIL_CONFLICTS = (
    "convenience_store", "food_and_beverage_retail", "grocery_store", "liquor_store", "retail", "shopping", "supermarket", "wine_store",
)
PRODUCER_ACCESS_TYPES = ("brewpub", "taproom", "tasting_room")


def _result(slug: Column | str | None, confidence: Column | float, eligible: bool, reason: Column | str) -> Column:
    as_col = lambda v, kind: (v if isinstance(v, Column) else F.lit(v)).cast(kind)
    return F.struct(as_col(slug, "string").alias("type"), as_col(confidence, "double").alias("confidence"),
                    F.lit(eligible).alias("eligible"), as_col(reason, "string").alias("reason"))


def _first(cases: list[tuple[Column, Column]], otherwise: Column) -> Column:
    """The value of the first case that holds."""
    return reduce(lambda chain, case: chain.when(*case), cases, F).otherwise(otherwise)


def classify_name(name: Column) -> Column:
    """struct(type, confidence, eligible, reason) of the first pattern found in the name."""
    cases = [(name.rlike("(?i)" + p), _result(t, c, True, f"name_pattern:{t}")) for p, t, c in NAME_PATTERNS]
    return _first(cases, _result(None, 0.0, False, "no_strong_name_signal"))


def classify_license(code: Column) -> Column:
    """By licence type; leading zeros do not matter."""
    raw, short = F.trim(code.cast("string")), license_code(code)
    reason = lambda kind: F.concat(F.lit(f"license_{kind}:"), raw)
    cases = [(short == k, _result(t, 0.99, True, reason("type"))) for k, t in LICENSE_TYPES.items()]
    cases += [(short.isin(*LICENSE_BAR_CODES), _result("bar", 0.90, True, reason("public_premises"))),
              (short.isin(*LICENSE_BREWPUB_CODES), _result("brewpub", 0.93, True, reason("brewpub")))]
    return _first(cases, _result(None, 0.0, False, reason("not_in_scope")))


def classify_naics(name: Column, code: Column) -> Column:
    """By industry code, and by name where the code only says drinking place or nothing."""
    c, by_name = F.trim(F.coalesce(code, F.lit(""))), classify_name(name)
    reason = F.concat(F.lit("naics:"), c)
    cases = [(c == k, _result(t, 0.94, True, reason)) for k, t in NAICS_TYPES.items()]
    cases += [
        (c.isin(*NAICS_BAR_CODES) & by_name["type"].isNotNull(), by_name),
        (c.isin(*NAICS_BAR_CODES), _result(None, 0.78, True, F.concat(F.lit("naics_drinking_place:"), c))),
        (by_name["type"].isNotNull(), _result(by_name["type"], F.least(by_name["confidence"], F.lit(0.90)), True, by_name["reason"])),
    ]
    return _first(cases, _result(None, 0.0, False, "naics_not_in_scope"))


def classify_tokens(name: Column, tokens: Column, existence: Column) -> Column:
    """By category tokens: combinations, then names that refine a producer, then tokens in order, then any bar."""
    t = F.transform(tokens, lambda x: F.lower(F.trim(x)))
    has = lambda *any_of: F.arrays_overlap(t, F.array(*(F.lit(x) for x in any_of)))
    sure = F.least(F.lit(COMBINED_TYPE_CAP), F.greatest(F.lit(0.0), F.coalesce(existence, F.lit(0.90))))
    by_name = classify_name(name)
    combined = [
        (has("winery") & has("wine_bar"), "tasting_room", "winery+wine_bar"),
        (has("distillery") & has("bar", "cocktail_bar", "lounge", "tasting_room"), "tasting_room", "distillery+bar"),
        (has("brewery") & has("bar", "beer_bar", "pub", "taproom", "tap_room"), "taproom", "brewery+bar"),
        (has("brewery") & has("restaurant"), "brewpub", "brewery+restaurant"),
    ]
    cases = [(c, _result(k, sure, True, f"taxonomy:{why}")) for c, k, why in combined]
    for producer, finer in (("brewery", ("brewpub", "taproom")), ("winery", ("tasting_room",)), ("distillery", ("tasting_room",))):
        cases.append((has(producer) & by_name["type"].isin(*finer), _result(
            by_name["type"], F.least(sure, by_name["confidence"]), True,
            F.concat(F.lit(f"taxonomy:{producer}+name_"), by_name["type"]))))
    cases += [(has(k), _result(v, sure, True, f"taxonomy:{k}")) for k, v in TOKEN_TYPES.items()]
    cases.append((has(*GENERIC_BAR_TOKENS), _result("bar", 0.86, True, "taxonomy:generic_bar")))
    return _first(cases, _result(None, 0.0, False, "taxonomy_not_in_scope"))


def supports_consumer_identity(name: Column, tokens: Column, kind: Column, reason: Column) -> Column:
    """Whether a place of a consumer type is one: no contradicting category, and a name that says so where the category is only ``bar``."""
    none_of = lambda families: ~F.coalesce(conflicts_with(tokens, families), F.lit(False))
    by_name = F.coalesce(classify_name(name)["type"].isin(*CONSUMER_TYPES), F.lit(False))
    return F.coalesce(
        kind.isin(*CONSUMER_TYPES) & none_of(HARD_CONFLICTS) & (kind.isin(*PRODUCER_ACCESS_TYPES) | none_of(("restaurant",)))
        & (~kind.isin(*BAR_TYPES) | none_of(BAR_RETAIL_CONFLICTS)) & ((reason != "taxonomy:generic_bar") | by_name), F.lit(False))


def license_supports(code: Column, kind: Column) -> Column:
    """Whether a licence code allows a place of the type."""
    pairs = [x for t, codes in LICENSES_OF_TYPE.items() for x in (F.lit(t), F.array(*(F.lit(c) for c in codes)))]
    return F.coalesce(F.array_contains(F.element_at(F.create_map(*pairs), kind), code), F.lit(False))


def types_compatible(a: Column, b: Column) -> Column:
    """Equal, unknown, both bars, or one of the producer pairs."""
    pair = F.concat_ws("|", F.array_sort(F.array(a, b)))
    known = ["|".join(sorted(p)) for p in COMPATIBLE_TYPES]
    return a.isNull() | b.isNull() | (a == b) | (a.isin(*BAR_TYPES) & b.isin(*BAR_TYPES)) | pair.isin(*known)


def merged_type(a: Column, a_consumer: Column, b: Column, b_consumer: Column) -> Column:
    """The type of a combined record; null for incompatible ones."""
    bars = a.isin(*BAR_TYPES) & b.isin(*BAR_TYPES)
    pair = F.concat_ws("|", F.array_sort(F.array(a, b)))
    chain = (F.when(a.eqNullSafe(b), a).when(a.isNull(), b).when(b.isNull(), a)
             .when(bars & a_consumer & (a != "bar"), a).when(bars & b_consumer & (b != "bar"), b).when(bars, "bar"))
    for producer, venue in COMPATIBLE_TYPES:
        chain = chain.when(pair == "|".join(sorted((producer, venue))), venue)
    return chain


def conflicts_with(tokens: Column, families: tuple[str, ...]) -> Column:
    """Whether a token is one of the families or ends with ``_family``."""
    return F.exists(tokens, lambda t: F.coalesce(
        t.isin(*families) | reduce(lambda x, y: x | y, (t.endswith("_" + f) for f in families)), F.lit(False)))
