"""Rules of the operators on small literal tables, on both sides of their thresholds."""

import io
import zipfile

import pytest
from pyspark.sql import functions as F

from cairn.functions import hours, payload, similarity, text, values
from cairn.operators import classify, gate, identity, latest, ledger, materialize, providers, readiness, reports, resolve, review, snapshot
from cairn.sources import licences, pages, places, tables
from cairn.streaming import queue, quota


def one(spark, column, **row):
    """Value of an expression over one row of literals."""
    return spark.range(1).select(*(F.lit(v).alias(k) for k, v in row.items()) if row else ["id"]).select(column.alias("v")).first()["v"]


# --- functions -------------------------------------------------------------


@pytest.mark.parametrize("raw, want", [
    (None, ""), ("  The  Bar & Grill, LLC. ", "the bar and grill"), ("INC", ""), ("Straße 5 Ltd", "strasse 5"), ("a_b-c", "a_b c"), ("incorporated art", "incorporated art")])
def test_names(spark, raw, want):
    assert one(spark, text.normalize_name(F.lit(raw).cast("string"))) == want


def test_unicode_folding(spark):
    assert one(spark, text.normalize_name(F.lit("ﬁne Ｂar LLC"), unicode=True)) == "fine bar"


@pytest.mark.parametrize("raw, want", [("Joe's, LLC", "Joe's"), ("LLC", "LLC"), ("Big Inc.", "Big"), (None, ""), ("Inc Bar", "Inc Bar")])
def test_display_names(spark, raw, want):
    assert one(spark, text.display_name(F.lit(raw).cast("string"))) == want


def test_addresses(spark):
    assert one(spark, text.normalize_address(F.lit("12 North Main Street, Suite 4"))) == "12 n main st ste 4"
    assert one(spark, text.normalize_address(F.lit("Northern Streets"))) == "northern streets"


@pytest.mark.parametrize("raw, country, want", [
    ("(415) 555-0100", "US", "+14155550100"), ("1 415 555 0100", "US", "+14155550100"), ("2 415 555 0100", "US", "+24155550100"), ("1234567", "US", None), ("12345678", "US", "+12345678"),
    ("1" * 15, "GB", "+" + "1" * 15), ("1" * 16, "GB", None), (None, "US", None), ("4155550100", "GB", "+4155550100")])
def test_phones(spark, raw, country, want):
    assert one(spark, text.normalize_phone(F.lit(raw).cast("string"), F.lit(country))) == want


@pytest.mark.parametrize("raw, want", [
    ("WWW.Example.com/", "https://example.com"), ("http://example.com:80/a/?utm_x=1&b=2#f", "http://example.com/a?b=2"), ("https://example.com:8443/x", "https://example.com:8443/x"),
    ("https://user@Example.com/?fbclid=1", "https://example.com"), ("https://", None), (None, None)])
def test_urls(spark, raw, want):
    assert one(spark, text.normalize_url(F.lit(raw).cast("string"))) == want


def test_small_texts(spark):
    assert one(spark, text.price_symbols(F.lit("$$$"))) == 3 and one(spark, text.price_symbols(F.lit("$$$$$"))) is None
    assert one(spark, text.first_filled(F.lit(" "), F.lit(None).cast("string"), F.lit(" x "))) == "x"
    assert one(spark, text.join_filled(F.lit("a "), F.lit(""), F.lit("b"))) == "a b"
    assert one(spark, text.slug(F.lit(" Wine  Bar! "))) == "wine_bar"
    assert one(spark, text.is_e164(F.lit("+1 (415) 555-0100"))) and not one(spark, text.is_e164(F.lit("4155550100")))
    assert one(spark, text.safe_url(F.lit("HTTPS://x"))) and not one(spark, text.safe_url(F.lit("ftp://x"))) and not one(spark, text.safe_url(F.lit("http://" + "x" * 2050)))
    pair = lambda a, b, o=0.5: one(spark, text.names_compatible(F.lit(a), F.lit(b), o))
    assert pair("The Red Fox", "Red Fox Bar") and pair("a b", "b c") and not pair("a b c", "c d e") and not pair("the", "the") and not pair("a b", "b c", 0.75)


@pytest.mark.parametrize("a, b, want", [("abcd", "abcd", 1.0), ("abcd", "abed", 0.75), ("abc", "xyz", 0.0), ("", "a", 0.0), (None, "a", 0.0), ("ab", "ba", 0.5), ("kitten", "sitting", 8 / 13)])
def test_lcs_ratio(spark, a, b, want):
    df = spark.createDataFrame([(a, b)], "a string, b string")
    assert df.select(similarity.lcs_ratio("a", "b")).first()[0] == pytest.approx(want)


def test_places(spark):
    grams = lambda t: similarity.trigrams(F.lit(t))
    assert sorted(one(spark, grams("cat"))) == ["  c", " ca", "at ", "cat"]
    assert one(spark, similarity.trigram_similarity(grams("word"), grams("two words"))) == pytest.approx(4 / 11)
    meters = one(spark, similarity.haversine_meters(F.lit(37.0), F.lit(-122.0), F.lit(37.0), F.lit(-122.001)))
    assert meters == pytest.approx(88.8, abs=0.1)
    for m, want in ((20.0, 1.0), (60.0, 0.5), (100.0, 0.0), (None, 0.0)):
        assert one(spark, similarity.geo_score(F.lit(m).cast("double"))) == pytest.approx(want)
    ring = F.array(*(F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in ((0, 0), (4, 0), (4, 4), (2, 1), (0, 4))))
    inside = lambda x, y: one(spark, similarity.point_in_ring(F.lit(x), F.lit(y), ring))
    assert inside(1.0, 1.0) and not inside(2.0, 3.0) and not inside(5.0, 1.0)
    assert one(spark, similarity.ring_distance(F.lit(1.0), F.lit(0.5), ring)) == pytest.approx(0.5)


def test_values(spark):
    for raw, want in (("05-Jan-2020", "2020-01-05"), ("01/05/2020", "2020-01-05"), ("2020-01-05 10:00", "2020-01-05"), ("20200105", "2020-01-05"), ("soon", None), (None, None)):
        got = one(spark, values.parse_date(F.lit(raw).cast("string")))
        assert (got and str(got)) == want
    for raw, want in (("2", 0.0 + 1), ("-1", 0.0), ("0.3", 0.3), ("x", 0.7)):
        assert one(spark, values.bounded(F.lit(raw), 0.7)) == want
    lat, lon = values.wkt_point(F.lit("Point(-122.5 37.25)"))
    assert (one(spark, lat), one(spark, lon)) == (37.25, -122.5)
    assert [one(spark, values.license_code(F.lit(x))) for x in ("0048", "000", "75")] == ["48", "0", "75"]
    assert one(spark, values.source_family(F.lit("fsq"))) == "consumer_poi" and one(spark, values.source_family(F.lit("x"))) == "x"
    assert one(spark, values.payload_hash(b=F.lit(1), a=F.lit("x"))) == one(spark, values.payload_hash(a=F.lit("x"), b=F.lit(1)))
    assert one(spark, values.digest(F.lit(None).cast("string"), F.lit("a"))) != one(spark, values.digest(F.lit(""), F.lit("a")))
    assert one(spark, values.rounded_coordinate(F.lit(1.234568))) == 1.23457 and one(spark, values.coordinate_key(F.lit(1.0))) == "1.0000"
    at, now = F.lit("2024-01-01").cast("timestamp"), F.lit("2024-12-31").cast("timestamp")
    assert one(spark, values.fresh_within(at, now, 365)) and not one(spark, values.fresh_within(at, now, 364))
    assert not one(spark, values.fresh_within(F.lit(None).cast("timestamp"), now, 9))
    assert [one(spark, values.backoff_seconds(F.lit(n), 30.0, 100.0)) for n in (1, 2, 3)] == [30, 60, 100]
    assert "secret" not in one(spark, values.redact_error(F.lit("at postgresql://u:secret@h/db failed")))
    assert [one(spark, values.json_is_empty(F.lit(x).cast("string"))) for x in (None, "null", "{}", "[]", "[1]")] == [True] * 4 + [False]
    assert one(spark, values.exactly_one(F.lit(1), F.lit(None))) and not one(spark, values.exactly_one(F.lit(1), F.lit(2)))
    assert [one(spark, values.price_level(F.lit(x))) for x in ("3", "5", "cheap", None)] == [3, None, 1, None]
    assert one(spark, values.finite(F.lit("nan"))) is None and one(spark, values.finite(F.lit("1.5"))) == 1.5


def week(spark, raw):
    got = one(spark, hours.weekly_intervals(hours.parse_week(F.lit(raw))))
    return got and [tuple(i) for i in got]


def test_hours(spark):
    assert week(spark, '{"Tuesday": [["16:00", "24:00"]], "monday": [["11:00", "14:00"], ["17:00", "02:00"], ["11:00", "14:00"]]}') == [
        (1, "11:00", "14:00", 0), (1, "17:00", "02:00", 1), (2, "16:00", "00:00", 1)]
    assert week(spark, '{"monday": [["10:00", "+01:00"]]}') == [(1, "10:00", "01:00", 1)]
    for bad in ('{"someday": [["10:00", "11:00"]]}', '{"monday": [["10", "11:00"]]}', '{"monday": [["10:00"]]}', "Mon-Fri 9-5", "{}", '{"monday": []}'):
        assert week(spark, bad) is None
    assert [one(spark, hours.hhmm(F.lit(x))) for x in ("0930", "+0130", "9:30")] == ["09:30", "+01:30", "9:30"]
    assert [one(spark, hours.twelve_hour(F.lit(x))) for x in ("16:00", "16:30", "00:00", "12:05", "09:15")] == ["4 PM", "4:30 PM", "12 AM", "12:05 PM", "9:15 AM"]
    weekly = hours.weekly_intervals(hours.parse_week(F.lit('{"friday": [["16:00", "02:00"]]}')))
    assert one(spark, hours.weekday_text(weekly)) == ["Friday: 4 PM - 2 AM"] and one(spark, hours.weekly_valid(weekly)) and one(spark, hours.has_hours(weekly))
    special = lambda d, c, o, z: one(spark, hours.special_interval(F.lit(d), F.lit(c), F.lit(o).cast("string"), F.lit(z).cast("string")))
    assert special("2024-12-25", True, None, None)["closed"] and special("2024-12-25", False, "10:00", "02:00")["closes_day_offset"] == 1
    assert special("soon", True, None, None) is None and special("2024-12-25", False, None, None) is None


def test_payloads(spark):
    assert one(spark, payload.flags_of_list(F.array(F.lit(" Doesnt Exist "), F.lit(""), F.lit("dup")), {"dup": "duplicate"})) == ["doesnt_exist", "duplicate"]
    flags = F.create_map(F.lit("closed"), F.lit("true"), F.lit("delete"), F.lit("no"))
    assert one(spark, payload.flags_of_map(flags)) == ["closed"]
    entries = F.array(*(F.struct(F.lit(n).alias("name"), F.lit(v).alias("value")) for n, v in (("Outdoor Seating", "1"), ("outdoor_seating", "2"), ("tv", "3"))))
    assert one(spark, payload.attributes(entries)) == {"outdoorseating": "2", "tv": "3"}
    assert [one(spark, payload.veracity(F.lit(x))) for x in ("4", "4.5", "6", "x")] == [4, None, None, None]
    none = F.array().cast("array<double>")
    assert one(spark, payload.point_of(none, F.lit("1.5"), F.lit("bad"))) is None and tuple(one(spark, payload.point_of(F.array(F.lit(2.0), F.lit(1.0)), F.lit(None), F.lit(None)))) == (1.0, 2.0)
    assert one(spark, payload.manual_value(F.lit("price_level"), F.lit("5"), [])) is None and one(spark, payload.manual_value(F.lit("setting_slug"), F.lit("Rooftop"), ["rooftop"])) == "rooftop"


# --- windows and sets ------------------------------------------------------


def test_latest(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "y"), ("a", 3, "z"), ("b", None, "w")], "k string, t int, v string")
    assert {tuple(r) for r in latest.latest_per_key(df, ["k"], ["t", "v"]).collect()} == {("a", 3, "z"), ("b", None, "w")}
    tied = spark.createDataFrame([("a", 5, 1), ("a", 5, 0), ("a", 4, 2)], "k string, t int, p int")
    assert latest.first_of_ties(tied, ["k"], "t", "p").first().p == 0


@pytest.mark.parametrize("scores, wins", [([0.9], True), ([0.9, 0.87], True), ([0.9, 0.875], False)])
def test_margin(spark, scores, wins):
    df = spark.createDataFrame([("k", s, i) for i, s in enumerate(scores)], "k string, s double, i int").withColumn("s", F.col("s").cast("decimal(9,4)"))
    assert (latest.margin_top1(df, ["k"], "s", "i", 0.03).count() == 1) is wins


def test_ownership_and_changes(spark):
    pairs = spark.createDataFrame([(1, "r", 0.9), (2, "r", 0.95), (2, "q", 0.5)], "a int, r string, s double")
    own, rest = latest.one_owner(pairs, "r", [F.desc("s"), F.asc("a")])
    assert {(r.a, r.r) for r in own.collect()} == {(2, "r"), (2, "q")} and [(r.a, r.r) for r in rest.collect()] == [(1, "r")]
    events = spark.createDataFrame([("k", 1, "x"), ("k", 2, "x"), ("k", 3, None), ("k", 4, None), ("k", 5, "x")], "k string, t int, v string")
    assert [r.t for r in latest.changed_only(events, ["k"], ["t"], "v").orderBy("t").collect()] == [1, 3, 5]


def test_as_of(spark):
    left = spark.createDataFrame([("a", 5), ("a", 10), ("a", 1), ("b", 5)], "k string, at int")
    right = spark.createDataFrame([("a", 2, "x"), ("a", 10, "y")], "k string, since int, v string")
    want = {("a", 5, "x"), ("a", 10, "y"), ("a", 1, None), ("b", 5, None)}
    for width in (None, 1, 3, 100):
        assert {tuple(r) for r in latest.as_of_join(left, right, ["k"], "at", "since", ["v"], width).collect()} == want
    assert {(r.k, r["at"], r.v) for r in latest.join_effective(left, right, ["k"], "at", "since").collect()} == want


def test_snapshots(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "d")], "k int, h string")
    new = spark.createDataFrame([(1, "a"), (2, "x"), (3, None), (5, "e")], "k int, h string")
    want = {1: "unchanged", 2: "updated", 3: "unchanged", 4: "retired", 5: "created"}
    assert {r.k: r.change for r in snapshot.snapshot_diff(old, new, ["k"], "h").collect()} == want
    assert 4 not in {r.k for r in snapshot.snapshot_diff(old, new, ["k"], "h", complete=False).collect()}
    assert {r.k: r.h for r in snapshot.merge(old, new, ["k"]).collect()} == {1: "a", 2: "x", 3: None, 4: "d", 5: "e"}
    at = F.lit("2024-01-01").cast("timestamp")
    once = snapshot.retire_missing(old, new, ["k"], at)
    assert {r.k for r in once.where("retired_at IS NOT NULL").collect()} == {4}
    assert snapshot.retire_missing(once, old, ["k"], at).where("retired_at IS NOT NULL").count() == 0
    assert [r.changed for r in snapshot.changed_columns(old, new, ["k"], ["h"]).collect()] == [["h"]]


@pytest.mark.parametrize("old, new, allow, ok", [(0, 0, True, False), (20, 9, False, False), (20, 10, False, True), (19, 1, False, True), (20, 1, True, True)])
def test_size_guard(old, new, allow, ok):
    if ok:
        snapshot.guard_size(old, new, allow)
    else:
        with pytest.raises(snapshot.SnapshotRefused):
            snapshot.guard_size(old, new, allow)


def test_append_only_new(spark):
    old = spark.createDataFrame([("a", "s", "f", "1")], "k string, source string, field_name string, value_text string")
    new = spark.createDataFrame([("a", "s", "f", "1"), ("a", "s", "f", "2"), ("a", "s", "f", "2")], old.schema)
    assert [r.value_text for r in ledger.append(ledger.ledger_rows(old, ["k"]), new, ["k"]).collect()] == ["2"]


# --- identity and classification -------------------------------------------


@pytest.mark.parametrize("name, address, phone, website, meters, licensed, want", [
    (0.55, 0.985, True, False, None, False, "exact_phone_same_location"), (0.54, 0.985, True, False, None, False, "same_location_name_conflict"),
    (0.65, 0.5, False, True, 25.0, False, "exact_website_same_location"), (0.64, 0.5, False, True, 25.0, False, "insufficient_identity_evidence"),
    (0.90, 0.985, False, False, None, False, "exact_address_strong_name"), (0.89, 0.985, False, False, None, False, "insufficient_identity_evidence+"),
    (0.84, 0.985, False, False, None, True, "licensed_exact_premise_name"), (0.83, 0.985, False, False, None, True, "same_location_name_conflict"),
    (0.94, 0.1, False, False, 25.0, False, "same_door_strong_name"), (0.94, 0.1, False, False, 25.1, False, "insufficient_identity_evidence"),
    (0.92, 0.96, False, False, 50.0, False, "nearby_address_and_name"), (0.74, 0.1, False, False, 15.0, False, "same_location_name_conflict"),
    (0.78, 0.95, False, False, None, False, "probable_identity_needs_review"), (0.77, 0.95, False, False, None, False, "insufficient_identity_evidence")])
def test_identity(spark, name, address, phone, website, meters, licensed, want):
    if want.endswith("+"):
        want = "probable_identity_needs_review"
    lit = lambda v, t: F.lit(v).cast(t)
    d = identity.decide_identity(F.lit(False), F.lit(True), F.lit(True), lit(name, "double"), lit(address, "double"), lit(phone, "boolean"), lit(website, "boolean"),
                                 lit(meters, "double"), lit(licensed, "boolean"))
    assert one(spark, d)["reason"] == want


@pytest.mark.parametrize("score, second, f, want", [
    (0.5, None, (0.96, 1.0, 0, 0, 0), ("auto_match", 0.97)), (0.99, None, (0.1, 0.9, 1, 0, 0), ("auto_match", 0.99)), (0.5, None, (0.1, 0.1, 1, 0, 0.85), ("auto_match", 0.98)),
    (0.5, None, (0.1, 0.95, 0, 1, 0), ("auto_match", 0.96)), (0.5, None, (0.55, 0.98, 0, 0, 0), ("review", 0.84)), (0.92, 0.87, (0.9, 0.9, 0, 0, 0), ("auto_match", 0.92)),
    (0.92, 0.88, (0.9, 0.9, 0, 0, 0), ("review", 0.92)), (0.79, None, (0.5, 0.5, 0, 0, 0), ("distinct", 0.79))])
def test_best_match(spark, score, second, f, want):
    cols = [F.lit(float(x)) for x in f]
    got = one(spark, identity.decide_best_match(F.lit(score), F.lit(second).cast("double"), *cols))
    assert (got["action"], pytest.approx(got["score"])) == want


def test_blocking(spark):
    rows = spark.createDataFrame([(1, "SF", "Red Fox Bar", "1 Main St", 37.0, -122.0), (2, "SF", "Blue Door", "9 Oak Ave", 38.0, -121.0)], "id int, city string, name string, address string, lat double, lon double")
    anchors = spark.createDataFrame([(10, "SF", "The Red Fox", "77 Pine", None, None), (11, "SF", "Zzz", "Qqq", 37.0005, -122.0), (12, "LA", "Red Fox Bar", "1 Main St", 37.0, -122.0), (13, "SF", "Www", "9 Oak Avenue", None, None)], rows.schema)
    got = {(r.record_id, r.anchor_id) for r in identity.fuzzy_block(rows, anchors, ["city"]).collect()}
    assert got == {(1, 10), (1, 11), (2, 13)}
    near = identity.distance_pairs(rows.unionByName(anchors), "id", "lat", "lon", 100.0)
    assert {(r.a, r.b) for r in near.collect()} == {(1, 11), (1, 12), (11, 12)}


def test_independent_agreement(spark):
    df = spark.createDataFrame([("e", 1, "v", "a", ["x"]), ("e", 2, "v", "b", ["x"]), ("e", 3, "w", "c", ["y"]), ("e", 4, "v", "d", ["z"]), ("e", 5, "w", "f", [])], "e string, p int, v string, s string, o array<string>")
    assert tuple(identity.independent_agreement(df, "e", "p", "v", "s", "o").first()) == ("e", "v", "a+d")


def test_classification(spark):
    kind = lambda c: one(spark, c)["type"]
    assert [kind(classify.classify_name(F.lit(n))) for n in ("Joe's Cocktail Bar", "Bar None Brewing", "Tap Room", "Barn")] == ["cocktail_bar", "brewery", "taproom", None]
    assert [kind(classify.classify_license(F.lit(c))) for c in ("02", "23", "048", "75", "20")] == ["winery", "brewery", "bar", "brewpub", None]
    tokens = lambda name, *t: kind(classify.classify_tokens(F.lit(name), F.array(*(F.lit(x) for x in t)), F.lit(0.99)))
    assert tokens("x", "Winery", "wine_bar") == "tasting_room" and tokens("x", "brewery", "restaurant") == "brewpub" and tokens("X Taproom", "brewery") == "taproom"
    assert tokens("X Taproom", "winery") == "winery" and tokens("x", "pub", "dive_bar") == "dive_bar" and tokens("x", "bar") == "bar" and tokens("x", "shop") is None
    assert one(spark, classify.classify_tokens(F.lit("x"), F.array(F.lit("pub")), F.lit(0.99)))["confidence"] == 0.94
    assert [kind(classify.classify_naics(F.lit(n), F.lit(c))) for n, c in (("x", "312130"), ("A Pub", "722410"), ("x", "722410"), ("A Pub", "1"))] == ["winery", "pub", None, "pub"]
    same = lambda a, b: one(spark, classify.types_compatible(F.lit(a).cast("string"), F.lit(b).cast("string")))
    assert same("pub", "lounge") and same(None, "x") and same("taproom", "brewery") and not same("winery", "taproom")
    merged = lambda a, b: one(spark, classify.merged_type(F.lit(a).cast("string"), F.lit(True), F.lit(b).cast("string"), F.lit(False)))
    assert merged("bar", "pub") == "bar" and merged("pub", "bar") == "pub" and merged("brewery", "taproom") == "taproom" and merged("winery", "pub") is None


# --- evidence --------------------------------------------------------------


@pytest.mark.parametrize("days, plain, of_hours, price", [(180, 1.0, 1.0, 1.0), (181, 1.0, 0.9, 1.0), (365, 1.0, 0.9, 1.0), (366, 0.96, 0.7, 0.8), (731, 0.96, 0.5, 0.6), (1095, 0.96, 0.5, 0.6), (1096, 0.88, 0.5, 0.6)])
def test_freshness(spark, days, plain, of_hours, price):
    now = F.lit("2024-06-01").cast("timestamp")
    for field, want in (("name", plain), ("hours", of_hours), ("price_level", price)):
        assert one(spark, resolve.freshness_factor(now - F.make_dt_interval(F.lit(days)), now, F.lit(field))) == want
    unknown = F.lit(None).cast("timestamp")
    assert one(spark, resolve.freshness_factor(unknown, now)) == 0.92 and one(spark, resolve.freshness_factor(unknown, now, F.lit("hours"))) == 0.70


def select(spark, rows, minimum=0.5):
    df = spark.createDataFrame(rows, "k string, v string, score double, origin string, id int")
    return tuple(resolve.select_value(resolve.group_values(df, ["k"], "v", "score", "origin", "id"), ["k"], "v", minimum).first())[1:]


def test_selection(spark):
    assert select(spark, [("k", "a", 0.5, "x", 1)])[0] == "a" and select(spark, [("k", "a", 0.49, "x", 1)])[4] == "insufficient"
    value, score, n, origins, status = select(spark, [("k", "a", 0.6, "x", 1), ("k", "a", 0.5, "y", 2), ("k", "a", 0.5, "z", 3), ("k", "a", 0.5, "w", 4)])
    assert (value, n, origins, status) == ("a", 1, 4, "selected") and score == pytest.approx(0.68)
    assert select(spark, [("k", "a", 0.6, "x", 1), ("k", "b", 0.55, "y", 2)])[4] == "conflicted"
    assert select(spark, [("k", "a", 0.75, "x", 1), ("k", "b", 0.6, "y", 2)])[0] == "a"


def test_direct_origin_decides_a_close_call(spark):
    v = spark.createDataFrame([("k", "a", 0.6, ["x", "y"], "x", 1), ("k", "b", 0.58, ["x"], "q", 1)], "k string, v string, score double, origins array<string>, direct_origin string, evidence_count int")
    assert resolve.select_value(v, ["k"], "v", 0.5).first().selected_value == "a"
    assert resolve.select_value(v.withColumn("direct_origin", F.lit("q")), ["k"], "v", 0.5).first().selected_value is None


@pytest.mark.parametrize("c, want", [([], 0.0), ([1.0], 0.9), ([1.0, 1.0], 0.99), ([0.5, 0.5], 1 - 0.55**2), ([1.0] * 9, 0.995), ([0.1, 0.1, 0.1, 0.1, 0.1], 1 - 0.91**4)])
def test_noisy_or(spark, c, want):
    assert one(spark, resolve.noisy_or(F.array(*(F.lit(x) for x in c)).cast("array<double>"))) == pytest.approx(want)


def test_rights(spark):
    policies = spark.createDataFrame([("s", True, True, True, True, 0.9, ["l"]), ("t", True, False, True, True, 0.9, ["l"])], "source string, may_store boolean, may_display boolean, may_derive boolean, may_redistribute boolean, authority double, allowed_license_ids array<string>")
    rows = [("s", ["l"], ["o"], 0.9, None), ("t", ["l"], ["o"], 0.9, "rights_missing"), ("s", ["l", "m"], ["o"], 0.9, "license_not_allowed"), ("s", ["l"], [], 0.9, "no_origin"),
            ("s", ["l"], ["o"], 0.91, "authority_exceeds_policy"), ("u", ["l"], ["o"], 0.1, "no_policy")]
    claims = spark.createDataFrame(rows, "source string, license_ids array<string>, origin_keys array<string>, authority double, want string")
    assert all(r.rejection == r.want and r.admitted == (r.want is None) for r in ledger.admit(claims, policies).collect())


GATE = dict(links=2, flags=[], licensed=1, active=1, anchor_open=True, kind="bar", license_code="48", identity=0.96, failure=False, anchor_updated="2024-05-01", passed=True,
            tier="provider", has_hours=True, missing=0)


@pytest.mark.parametrize("change, want", [
    ({}, "all_hard_gates_passed"), ({"links": 0}, "no_linked_sources"), ({"flags": ["closed"]}, "consumer_hard_negative"), ({"active": 0}, "license_not_active"),
    ({"active": 0, "licensed": 0}, "missing_active_license"), ({"anchor_open": False}, "missing_current_anchor"), ({"kind": "cafe"}, "consumer_type_not_supported"),
    ({"license_code": "23"}, "license_incompatible_with_venue_type"), ({"identity": 0.959}, "identity_below_publication_threshold"), ({"failure": True}, "current_verifier_failure"),
    ({"anchor_updated": "2023-01-01"}, "all_hard_gates_passed"), ({"anchor_updated": "2023-01-01", "passed": False}, "missing_current_anchor"),
    ({"passed": False}, "all_hard_gates_passed"), ({"passed": False, "license_code": "47"}, "missing_high_quality_verification"),
    ({"kind": "brewery", "license_code": "23"}, "generic_manufacturer_requires_manual_public_access"), ({"kind": "brewery", "license_code": "23", "tier": "manual"}, "all_hard_gates_passed"),
    ({"kind": "taproom", "license_code": "1", "has_hours": False}, "manufacturer_access_requires_hours_or_manual_attestation"), ({"missing": 1}, "missing_required_materialization_fields")])
def test_candidate_gate(spark, change, want):
    f = GATE | change
    cols = {k: F.array(*(F.lit(x) for x in v)).cast("array<string>") if isinstance(v, list) else F.lit(v) for k, v in f.items()}
    cols["anchor_updated"] = cols["anchor_updated"].cast("timestamp")
    assert one(spark, gate.candidate_state(**cols, as_of=F.lit("2024-06-01").cast("timestamp")))["reason"] == want


def test_leases_and_creation(spark):
    now = F.lit("2024-06-01").cast("timestamp")
    assert [one(spark, gate.lease_state(F.lit(x).cast("timestamp"), now)) for x in (None, "2024-06-01", "2024-06-02")] == ["expired", "expired", "live"]
    assert str(one(spark, gate.open_evidence_expiry(F.lit("2023-06-15").cast("timestamp"), now)))[:10] == "2024-06-14"
    ok = lambda q, flags=(): one(spark, gate.safe_to_create(F.lit("consumer_poi"), F.lit("open"), F.lit(1.0), F.lit(1.0), F.lit("pub"), F.lit(True), F.lit("walk_in"),
                                                            F.array(*(F.lit(x) for x in flags)).cast("array<string>"), F.lit(q), classify.ACCESS_TYPES))
    assert ok(0.85) and not ok(0.849) and not ok(0.9, ("closed",)) and ok(0.9, ("inappropriate",))
    outcome = lambda a, b, p: one(spark, gate.verification_outcome({"a": F.lit(a).cast("boolean"), "b": F.lit(b).cast("boolean")}, {"p": F.lit(p)}))
    assert [outcome(True, True, True), outcome(True, False, True), outcome(True, None, True), outcome(True, True, False)] == ["pass", "fail", "inconclusive", "inconclusive"]


# --- providers, reviews, reports, state --------------------------------------


def test_provider_matching(spark):
    reject = lambda **k: one(spark, providers.candidate_rejection(**{n: F.lit(v) for n, v in (dict(provider_id="abcdef", closed=False, meters=50.0, expected_name="Red Fox", name="Red Fox Bar",
                                                                  name_score=0.9, address_score=0.5, same_phone=False, category=True) | k).items()}))
    assert reject() is None and reject(provider_id="x") == "invalid_identity" and reject(closed=True) == "closed" and reject(meters=None) == "missing_coordinates" and reject(meters=100.1) == "location_mismatch"
    assert reject(meters=76.0) == "name_mismatch" and reject(meters=76.0, address_score=0.86) is None and reject(category=False) == "type_mismatch"
    df = spark.createDataFrame([(1, None, "a", 0.9), (1, "closed", "b", 0.0), (2, None, "a", 0.9), (2, None, "b", 0.9), (3, "closed", "a", 0.0), (3, "name_mismatch", "b", 0.0)], "e int, r string, p string, c double")
    assert {r.e: (r.outcome, r.p) for r in providers.select_matches(df, "e", "r", "p", "c").collect()} == {1: ("matched", "a"), 2: ("ambiguous", None), 3: ("name_mismatch", None)}
    assert [one(spark, providers.cooldown_seconds(F.lit(c))) for c in ("forbidden", "rate_limited", "other")] == [3600, 900, 300]


def test_reviews(spark):
    links = spark.createDataFrame([("a", "match", 0.96, "h1"), ("b", "match", 0.95, "h2"), ("c", "review", 0.85, "h3")], "k string, action string, score double, evidence_hash string")
    accepted = spark.createDataFrame([("b", "h2"), ("c", "old")], "k string, evidence_hash string")
    assert {r.k: (r.outcome, r.identity_confidence) for r in review.revalidate(links, accepted, ["k"]).collect()} == {"a": ("keep", 0.96), "b": ("reviewed", 0.99), "c": ("review", None)}
    reviews = spark.createDataFrame([("a", "h", "pending"), ("b", "h", "resolved")], "k string, evidence_hash string, state string")
    res = spark.createDataFrame([("a", "h", "same_place", "n", "ann"), ("b", "h", "same_place", "n", "ann")], "k string, evidence_hash string, resolution string, note string, reviewer string")
    assert {r.k: r.resolution for r in review.resolve(reviews, res, ["k"]).collect()} == {"a": "same_place", "b": None}
    cov = lambda a, b: one(spark, review.covered_by_review(F.array(*map(F.lit, a)).cast("array<string>"), F.array(*map(F.lit, b)).cast("array<string>")))
    assert cov(["1"], ["1", "2"]) and not cov(["3"], ["1"]) and not cov([], ["1"])


def test_reports(spark):
    votes = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (2, "a"), (2, "b"), (3, "a"), (4, "a"), (4, "a"), (4, "b"), (4, "b")], "e int, c string")
    assert [tuple(r) for r in reports.strict_winner(votes, "e", "c").collect()] == [(1, "a", 2)]
    assert [one(spark, reports.rollup_state(*map(F.lit, x))) for x in ((0, 0, 0), (2, 2, 0), (2, 0, 2), (2, 1, 1), (2, 1, 0))] == ["empty", "succeeded", "failed", "partial", "running"]
    d = spark.createDataFrame([(1, "f", "selected", True, True), (1, "g", "selected", False, True), (1, "h", "unknown", False, False)], "k int, field string, status string, conflicted boolean, stale boolean")
    assert {r.field: r.state for r in reports.coverage(spark.createDataFrame([(1,)], "k int"), "k", ["f", "g", "h", "i"], d).collect()} == {"f": "conflicted", "g": "stale", "h": "unknown", "i": "unknown"}
    names = one(spark, readiness.blockers({"a": F.lit(True), "b": F.lit(None).cast("boolean"), "c": F.lit(True)}, F.array(F.lit("s"))))
    assert names == ["a", "c", "source_stale:s"] and one(spark, readiness.same_scope(F.array(F.lit("B"), F.lit("a")), F.array(F.lit("A"), F.lit("b"))))


def test_projection(spark):
    snap = spark.createDataFrame([(1, "old", "w"), (2, "old", "w")], "k int, phone_e164 string, hours string")
    dec = spark.createDataFrame([(1, "phone_e164", "new", "selected", "fsq", 1), (2, "phone_e164", "new", "selected", "fsq", 2), (2, "hours", None, "conflicted", "fsq", 2)], "k int, field string, selected_value string, status string, source string, origin_count int")
    got = {r.k: (r.phone_e164, r.phone_e164_status, r.hours, r.hours_status) for r in materialize.overlay_candidates(snap, dec, "k", ["phone_e164", "hours"]).collect()}
    assert got == {1: (None, "insufficient", "w", None), 2: ("new", "selected", None, "conflicted")}
    assert one(spark, materialize.minimum_score(F.lit("hours"))) == 0.58 and one(spark, materialize.default_confidence(F.lit("x"), F.lit(None).cast("double"))) == 0.95


def test_queue(spark):
    rows = [(1, 0, "enqueue"), (1, 10, "claim"), (2, 0, "claim"), (3, 0, "claim"), (3, 1, "claim"), (3, 2, "claim"), (4, 950, "claim"), (5, 0, "claim"), (5, 5, "complete"), (6, 0, "claim"), (6, 990, "renew")]
    log = spark.createDataFrame(rows, "job int, s int, kind string").withColumn("ts", F.timestamp_seconds("s"))
    got = {r.job: r.state for r in queue.replay(log, "job", ["ts"], "kind", "ts", F.timestamp_seconds(F.lit(1000))).collect()}
    assert got == {1: "queued", 2: "queued", 3: "dead", 4: "leased", 5: "succeeded", 6: "leased"}


def test_streams(spark, tmp_path):
    rows = [("u", "2024-01-01 00:00:10"), ("u", "2024-01-01 00:00:20"), ("u", "2024-01-01 00:00:30"), ("v", "2024-01-01 00:00:40"), ("u", "2024-01-01 01:00:00")]
    df = spark.createDataFrame(rows, "u string, t string").select("u", F.col("t").cast("timestamp").alias("ts"))
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    q = quota.streaming_window_counts(stream, "u", "ts", "1 minute", 2, "1 minute").writeStream.format("memory").queryName("w").outputMode("complete").option(
        "checkpointLocation", str(tmp_path / "c1")).start()
    q.processAllAvailable()
    q.stop()
    streamed = {tuple(r) for r in spark.table("w").collect()}
    assert streamed == {tuple(r) for r in quota.window_counts(df, "u", "ts", "1 minute", 2).collect()} and any(r[3] for r in streamed)
    q = quota.streaming_dedupe(stream, ["u"], "ts", "10 minutes").writeStream.format("memory").queryName("d").option("checkpointLocation", str(tmp_path / "c2")).start()
    q.processAllAvailable()
    q.stop()
    assert sorted(r.u for r in spark.table("d").collect())[-1] == "v"


# --- sources ---------------------------------------------------------------


def test_zipped_csv(spark, tmp_path):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        z.writestr("small.csv", "a")
        z.writestr("big.csv", "﻿Report of today\nLicense Type,File Number,DBA Name,Primary Name,Premise Street Address 1,Premise Street Address 2,Premise City,Premise State,Premise Zip,"
                   "Type Status,License or Application,Type Original Issue Dates,Expiration Dates\n048,7,Fox,Fox LLC,1 Main,,SF,CA,94110,ACTIVE,LIC,05-Jan-2020,31-Dec-2024\n20,8,,,,,,,,,,,\n")
    (tmp_path / "x.zip").write_bytes(buffer.getvalue())
    rows = licences.read_zipped_csv(spark, str(tmp_path), ("License Type", "File Number"))
    names = "License Type,File Number,DBA Name,Primary Name,Premise Street Address 1,Premise Street Address 2,Premise City,Premise State,Premise Zip,Type Status,License or Application,Type Original Issue Dates,Expiration Dates".split(",")
    mapped = licences.map_licences(licences.canonical_headers(rows.select(*(F.col("fields")[n].alias(n) for n in names)))).collect()
    assert [(r.source_record_id, r.name, r.address, r.source_status, r.primary_type, str(r.issued)) for r in mapped] == [("7", "Fox", "1 Main", "open", "bar", "2020-01-05")]


def test_other_sources(spark, tmp_path):
    fixed = licences.slice_fixed_width(spark.createDataFrame([("ab  cd",)], "value string"), [("x", 1, 4), ("y", 5, 2), ("z", 7, 3)]).first()
    assert tuple(fixed) == ("ab", "cd", None)
    (tmp_path / "p.txt").write_text('\x1e{"geometry":{"type":"Point","coordinates":[-122.0,37.0]},"properties":{"id":"1","names":{"primary":"Fox"},"taxonomy":{"primary":"pub"},"confidence":0.9,'
                                    '"addresses":[{"freeform":"1 Rue","locality":"Paris","country":"FR"},{"freeform":"1 Main","locality":"SF","country":"US"}],"sources":[{"dataset":"Foursquare","update_time":"2024-01-01T00:00:00Z"}]}}\nnot json\n')
    f = places.map_features(places.read_geojson_sequence(spark, str(tmp_path / "p.txt"))).first()
    assert (f.name, f.address, f.city, f.primary_type, f.latitude, f.origin_keys) == ("Fox", "1 Main", "SF", "pub", 37.0, ["foursquare"])
    (tmp_path / "b.json").write_text('{"type":"FeatureCollection","features":[{"properties":{"name":"A"},"geometry":{"type":"Polygon","coordinates":[[[0,0],[1,0],[1,1]]]}},{"properties":{},"geometry":{"type":"Point","coordinates":[0,0]}}]}')
    b = places.read_feature_collection(spark, str(tmp_path / "b.json")).collect()
    assert [(r.id, len(r.rings[0])) for r in b] == [("A", 3)]
    lines = spark.createDataFrame([(1, '"k1","a","Match","Exact","m","-122.1,37.1"'), (2, '"k1","a","Match","Exact","m","-122.2,37.2"'), (3, '"k2","a","Match","Non_Exact","m","1,2"'), (4, '"k3","a","Match","Exact","m","x,y"')], "o int, value string")
    assert [tuple(r) for r in places.parse_geocodes(lines, "o").collect()] == [("k1", 37.2, -122.2)]
    index = spark.createDataFrame([("<Key>release/2024-05-16.0/a</Key><Key>release/2024-05-16.10/</Key><Key>release/2024-04-16.9/</Key>",)], "value string")
    assert places.latest_release(index).first().release == "2024-05-16.10"
    with pytest.raises(ValueError):
        tables.check_box((1, 2, 0, 3))
    assert tables.check_box((-1, -2, 1, 2)) == (-1.0, -2.0, 1.0, 2.0)


def test_pages(spark):
    html = ('<html><head><title>Red Fox Bar</title><meta property="og:site_name" content="Red Fox"><script type="application/ld+json">{"@graph":[{"@type":"BarOrPub","name":"Red Fox, LLC"}]}</script></head>'
            '<body><a href="/x">x</a>415-555-0100 at 1 Main St</body></html>')
    df = spark.createDataFrame([(1, html), (2, None), (3, "")], "k int, html string")
    claims = {(r.k, r.normalized_name): r.confidence for r in pages.name_claims(df, "k").collect()}
    assert claims == {(1, "red fox"): 0.99, (1, "red fox bar"): 0.76}
    read = df.where("k = 1").select(pages.parse_page(F.col("html"))["text"].alias("text"))
    score = read.select(pages.identity_score(F.col("text"), F.array(F.lit("+14155550100")), F.lit("1 main st"), F.lit("94110"), F.lit("SF")).alias("s")).first().s
    assert score == 1.0
