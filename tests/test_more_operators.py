"""Mappers, state transitions and reports on small literal tables."""

import json

import pytest
from pyspark.sql import functions as F

from cairn.functions import payload
from cairn.operators import discovery, identity, materialize, providers, readiness, resolve, review
from cairn.sources import licences, places
from cairn.streaming import queue


def ts(text):
    return F.lit(text).cast("timestamp")


def frame(spark, rows, ddl, **times):
    df = spark.createDataFrame(rows, ddl)
    return df.withColumns({c: F.col(c).cast("timestamp") for c in times.get("at", ())})


def test_open_places(spark):
    ddl = ("fsq_place_id string, name string, latitude double, longitude double, address string, locality string, region string, postcode string, country string, date_refreshed string, "
           "date_closed string, tel string, website string, fsq_category_labels array<string>, unresolved_flags array<string>")
    row = ["1", "Fox", 1.0, 2.0, "1 Main", "SF", "CA", "94110", "US", "2024-01-01", None, None, None, ["Dining and Drinking > Bar > Cocktail Bar"], None]
    stale = [*row[:9], "2015-01-01", "2020-01-01", *row[11:13], ["Community > School", "Bar"], ["Private Venue"]]
    got = places.map_open_places(spark.createDataFrame([row, stale], ddl), ts("2024-06-01")).collect()
    assert (got[0].primary_type, got[0].source_status, got[0].quality_flags) == ("cocktail_bar", "open", [])
    assert got[1].source_status == "closed" and got[1].quality_flags == ["consumer_identity_conflict", "privatevenue", "stale"]
    assert (got[0].consumer_facing, got[0].public_access, got[1].consumer_facing, got[1].public_access) == (True, "walk_in", False, "members_or_private")
    cases = [  # name, labels, flags, refreshed: status, access, settings, flags
        ("Roof Garden", ["Dining and Drinking > Bar > Rooftop Bar"], [], "2024-05-01", ("open", "unknown", ["rooftop"], ["consumer_identity_conflict"])),
        ("Old Bar", ["Dining and Drinking > Bar"], [], "2020-01-01", ("unknown", "walk_in", [], ["stale"])),
        ("Kokkari Estiatorio", ["Dining and Drinking > Restaurant > Greek Restaurant", "Dining and Drinking > Bar > Cocktail Bar"], [], "2024-05-01",
         ("open", "unknown", [], ["consumer_identity_conflict"])),
        ("Good Wine Bar", ["Retail > Wine Store", "Dining and Drinking > Bar > Wine Bar"], [], "2024-05-01", ("open", "unknown", [], ["consumer_identity_conflict"])),
        ("Corner Taproom", ["Dining and Drinking > Brewery", "Dining and Drinking > Bar", "Dining and Drinking > Restaurant"], ["Doesn't Exist"], "2024-05-01",
         ("closed", "walk_in", [], ["doesnt_exist"])),
        ("Gone Pub", ["Dining and Drinking > Bar > Pub"], ["doesnt exist"], "2024-05-01", ("closed", "walk_in", [], ["doesnt_exist"])),
        ("Library", ["Community > Library"], [], "2024-05-01", None)]
    for name, labels, flags, refreshed, want in cases:
        one = places.map_open_places(spark.createDataFrame([["1", name, *row[2:9], refreshed, None, None, None, labels, flags]], ddl), ts("2024-06-01")).collect()
        assert [(r.source_status, r.public_access, r.setting_slugs, r.quality_flags) for r in one] == ([want] if want else []), name


def test_features_with_provenance(spark):
    source = lambda d, p, l=None: {"dataset": d, "record_id": "abc", "property": p, "license": l, "update_time": "2026-06-01T00:00:00Z"}
    feature = {"geometry": {"type": "Point", "coordinates": [-122.4194, 37.7749]}, "properties": {
        "id": "9", "version": 4, "names": {"primary": "Example Cocktail Bar"}, "basic_category": "bar",
        "taxonomy": {"primary": "cocktail_bar", "hierarchy": ["food_and_drink", "bar", "cocktail_bar"], "alternates": []}, "confidence": 0.98,
        "websites": ["https://example.com"], "phones": ["", "+14155551212"], "operating_status": "open",
        "addresses": [{"freeform": "123 Valencia St", "locality": "San Francisco", "postcode": "94103", "region": "CA", "country": "US"}],
        "sources": [source("meta", "/websites/0"), source("OSM", "/names/primary", "ODbL"), source("", "/phones")]}}
    rows = spark.createDataFrame([(json.dumps(feature),)], "value string").select(F.from_json("value", places.PLACE_FEATURE).alias("feature"))
    got = places.map_features(rows).first()
    assert (got.primary_type, got.classification_confidence, got.source_status, got.phone, got.consumer_facing, got.public_access) == (
        "cocktail_bar", 0.94, "open", "+14155551212", True, "walk_in")
    assert got.origin_keys == ["meta", "openstreetmap"] and set(got.field_provenance) == {"website_url", "display_name"}
    web = got.field_provenance["website_url"]
    assert (web.origin_keys, web.license_ids, len(web.source_items)) == (["meta"], ["CDLA-Permissive-2.0"], 1)
    assert tuple(web.source_items[0]) == ("meta", "abc", "/websites/0", "CDLA-Permissive-2.0", "2026-06-01T00:00:00Z")
    assert got.field_provenance["display_name"].license_ids == ["ODbL"]


@pytest.mark.parametrize("dataset, origin, license_id", [
    ("meta", "meta", "CDLA-Permissive-2.0"), ("Facebook", "meta", "unknown"), ("Foursquare", "foursquare", "Apache-2.0"), ("fsq_os", "foursquare", "Apache-2.0"),
    ("Microsoft", "microsoft", "CDLA-Permissive-2.0"), ("bing maps", "microsoft", "unknown"), ("OpenStreetMap", "openstreetmap", "unknown"),
    ("osm", "openstreetmap", "unknown"), ("cosmos", "overture:cosmos", "unknown"), ("AllThePlaces", "overture:alltheplaces", "CC0-1.0"),
    ("overturemaps", "overture:overturemaps", "CC0-1.0"), ("Krick", "overture:krick", "CDLA-Permissive-2.0"), ("RenderSEO", "overture:renderseo", "CDLA-Permissive-2.0")])
def test_origins_and_licences(spark, dataset, origin, license_id):
    d = F.lit(dataset)
    got = spark.range(1).select(payload.origin_keys(F.array(d, F.lit(None))).alias("o"), payload.item_license(d, F.lit("")).alias("l"),
                                payload.origin_keys(F.array().cast("array<string>")).alias("n")).first()
    assert (got.o, got.l, got.n) == ([origin], license_id, ["overture:unknown"])


def test_registry_elements_bindings(spark):
    ddl = "uniqueid string, certificate_number string, dba_name string, ownership_name string, full_business_address string, city string, location_end_date string, administratively_closed string, naics_code string"
    rows = [("", "c1", "", "Owner LLC", "1 Main", "SF", None, None, "312120"), ("u2", "c2", "A Pub", "X", "2 Main", "SF", "2020-01-01", None, "722410")]
    got = places.map_registry(spark.createDataFrame(rows, ddl)).collect()
    assert [(r.source_record_id, r.name, r.source_status, r.primary_type) for r in got] == [("c1", "Owner LLC", "open", "brewery"), ("u2", "A Pub", "closed", "pub")]
    ddl = "type string, id long, lat double, lon double, center struct<lat:double,lon:double>, timestamp string, tags map<string,string>"
    rows = [("way", 7, None, None, (1.0, 2.0), "2024-01-01T00:00:00Z", {"name": "Fox", "addr:housenumber": "1", "addr:street": "Main", "contact:phone": "5", "outdoor_seating": "yes"})]
    got = places.map_elements(spark.createDataFrame(rows, ddl)).first()
    assert (got.source_record_id, got.address, got.latitude, got.phone, got.settings) == ("way/7", "1 Main", 1.0, "5", ["outdoor"])
    rows = [(1, {"item": "Q1", "itemLabel": "Fox", "coord": "Point(2 1)", "confidence": "0.99"}), (2, {"item": "Q1", "itemLabel": "Other", "coord": "x"})]
    got = places.map_bindings(spark.createDataFrame(rows, "pos int, binding map<string,string>"), "pos").collect()
    assert [(r.name, r.latitude, r.classification_confidence) for r in got] == [("Fox", 1.0, 0.88)]


def test_requests_and_links(spark):
    rows = [("k1", None, "1 Main, Apt 2", "SF", "CA", "9"), ("k2", 1.0, "x", "SF", "CA", "9"), ("k3", None, " ", "SF", "CA", "9")]
    lines = places.geocode_requests(spark.createDataFrame(rows, "k string, latitude double, address string, city string, region string, postal_code string"), "k").collect()
    assert [r.value for r in lines] == ['k1,"1 Main, Apt 2",SF,CA,9']
    html = '<a href="/a.zip">x</a><A HREF=\'/b.csv\'>y</A><a href="/c.html">z</a>'
    assert spark.range(1).select(licences.export_links(F.lit(html)).alias("l")).first().l == ["/b.csv", "/a.zip"]


def test_manual_observations(spark):
    ledger = review.manual_observations(
        spark.createDataFrame([], "idempotency_key string, value_hash string"),
        spark.createDataFrame([("k1", "e", "name", "Fox", 400)], "idempotency_key string, entity string, field_name string, value_text string, lease_days int"), ts("2024-01-01"), 60)
    assert str(ledger.first().expires_at) == "2024-03-01 00:00:00" and not ledger.first().conflict
    again = spark.createDataFrame([("k1", "e", "name", "Fox", 9), ("k1", "e", "name", "Ox", 9)], "idempotency_key string, entity string, field_name string, value_text string, lease_days int")
    assert [(r.value_text, r.conflict) for r in review.manual_observations(ledger, again, ts("2024-01-01"), 60).collect()] == [("Ox", True)]


def test_contributions(spark):
    rows = spark.createDataFrame([(1, "u", "e", "merchant", "t1"), (2, "v", "e", "merchant", "t1"), (3, "v", "e", "visitor", "t1"), (4, "v", "e", "visitor", "t0")], "id int, user_id string, entity string, kind string, terms_version string")
    terms = frame(spark, [("t1", "active", "2024-01-01"), ("t0", "retired", "2023-01-01")], "version string, state string, effective_from string", at=["effective_from"])
    claims = spark.createDataFrame([("u", "e", "verified"), ("v", "e", "pending")], "user_id string, entity string, state string")
    got = {r.id: str(r.expires_at)[:10] for r in review.contributions(rows, terms, claims, ts("2024-02-01")).collect()}
    assert got == {1: "2024-07-30", 3: "2024-05-01"}


def test_review_queue(spark):
    found = spark.createDataFrame([("a", 0.8, "r1", "h1"), ("a", 0.9, "r2", "h2"), ("b", 0.8, "r1", "h3")], "k string, score double, reason string, evidence_hash string")
    reviews = spark.createDataFrame([("b", "h3", "resolved"), ("a", "h2", "pending")], "k string, evidence_hash string, state string")
    assert [(r.k, r.reason) for r in review.enqueue(found, reviews, ["k"]).collect()] == [("a", "r2")]
    pending = spark.createDataFrame([("a", "pending", True, "x:same_location_name_conflict"), ("b", "pending", False, "same_location_name_conflict"), ("c", "pending", True, "other")], "k string, state string, exact_address boolean, reason string")
    assert [r.k for r in review.blocking(spark.createDataFrame([("a",), ("b",), ("c",)], "k string"), pending, "k").collect()] == ["a"]


def test_provider_links_and_withdrawal(spark):
    current = frame(spark, [(1, "old", "2024-01-05", "2024-01-05"), (2, "gone", "2024-01-01", "2024-01-01")], "k int, provider_id string, matched_at string, validated_at string", at=["matched_at", "validated_at"])
    eligible = frame(spark, [(1, 0.9, "p", "2024-01-01", "2024-02-01"), (1, 0.8, "q", "2024-01-02", "2024-03-01"), (3, 0.7, "n", "2024-01-02", "2024-01-03")], "k int, confidence double, provider_id string, matched_at string, validated_at string", at=["matched_at", "validated_at"])
    got = {r.k: (r.provider_id, str(r.matched_at)[:10], str(r.validated_at)[:10], r.retired) for r in materialize.provider_links(
        current, eligible.withColumnsRenamed({"matched_at": "m", "validated_at": "v"}).withColumnsRenamed({"m": "matched_at", "v": "validated_at"}), ["k"]).collect()}
    assert got == {1: ("p", "2024-01-01", "2024-03-01", False), 2: ("gone", "2024-01-01", "2024-01-01", True), 3: ("n", "2024-01-02", "2024-01-03", False)}
    e = frame(spark, [(1, "published", "published", "2024-01-01"), (2, "published", "published", None), (3, "published", "published", "2024-01-02"), (4, "candidate", "verified", None)],
              "id int, publication_state string, candidate_state string, verification_expires_at string", at=["verification_expires_at"])
    got = {r.id: (r.publication_state, r.candidate_state) for r in materialize.withdraw_expired(e, ts("2024-01-01")).collect()}
    assert got == {1: ("suppressed", "needs_verification"), 2: ("suppressed", "needs_verification"), 3: ("published", "published"), 4: ("candidate", "verified")}
    c = frame(spark, [(1, "verified", "2024-01-02"), (2, "verified", "2024-01-01"), (3, "rejected", "2024-01-01")], "id int, candidate_state string, verified_at string", at=["verified_at"])
    assert [r.id for r in materialize.publish(c, 5, 4, True).collect()] == [2] and materialize.publish(c, 5, 4, False).count() == 0 and materialize.publish(c, 5, 9, True).count() == 0
    assert materialize.field_coverage(spark.createDataFrame([("a", None), (" ", 1)], "x string, y int"), ["x", "y"]).first().asDict() == {"entities": 2, "x": 1, "y": 1}


def test_due_and_sync(spark):
    ddl = "id int, provider_id string, attempted_at string, retry_after string, lease_until string, fingerprint string"
    links = frame(spark, [(1, "p", None, None, None, "f"), (2, None, "2024-01-01", None, None, "f"), (3, None, None, "2024-03-01", None, "f"), (4, None, None, None, "2024-03-01", "f"), (5, None, None, None, None, "f")],
                  ddl, at=["attempted_at", "retry_after", "lease_until"])
    assert [r.id for r in providers.due(links, ts("2024-02-01"), 2).collect()] == [5, 2]
    out = spark.createDataFrame([(1, "error", None, "rate_limited", "f"), (2, "matched", "q", None, "f"), (5, "matched", "z", None, "other")], "id int, outcome string, provider_id string, code string, fingerprint string")
    got = {r.id: (r.provider_id, r.attempted_at and str(r.attempted_at)[:10], r.retry_after and str(r.retry_after)) for r in providers.after_sync(links, out, ts("2024-02-01")).collect()}
    assert got[1] == ("p", "2024-02-01", "2024-02-01 00:15:00") and got[2] == ("q", "2024-02-01", None) and got[5] == (None, None, None) and got[3][2].startswith("2024-03-01")
    history = spark.createDataFrame([("k", 1, "a"), ("k", 2, "a"), ("k", 3, None), ("k", 4, "b")], "k string, t int, p string")
    assert [r.t for r in providers.invalidated(history, "k", "t", "p").orderBy("t").collect()] == [3, 4]


def test_live_places(spark):
    base = dict(returned_id="x", expected_id="x", veracity=4, date_closed=None, flags=[], meters=100.0, expected_name="Red Fox", name="The Red Fox Bar", category=True)

    def reject(**k):
        cols = {n: F.array(*map(F.lit, v)).cast("array<string>") if isinstance(v, list) else F.lit(v) for n, v in (base | k).items()}
        return spark.range(1).select(providers.place_rejection(**cols).alias("r")).first().r

    assert reject() is None and reject(returned_id=None) == "identity_mismatch" and reject(veracity=3) == "low_veracity" and reject(date_closed="2020") == "closed"
    assert reject(flags=["duplicate"]) == "provider_warning" and reject(meters=100.5) == "location_mismatch" and reject(name="Blue Door") == "name_mismatch" and reject(category=None) == "type_mismatch"
    wanted = {f: F.lit(f != "website") for f in ("phone", "website", "price", "settings")}
    row = spark.range(1).select(*providers.live_projection(wanted, F.lit("415 555 0100"), F.lit("https://x"), F.lit("2.5"), F.array(F.lit("rooftop")))).first()
    assert tuple(row) == ("+14155550100", None, None, ["rooftop"])


def test_readiness(spark):
    now = ts("2024-06-01")
    e = frame(spark, [("published", "open", "2024-07-01", "v7", "r"), ("published", "open", "2024-05-01", "v6", None), ("candidate", "open", None, None, None)],
              "publication_state string, status string, verification_expires_at string, verification_version string, expansion_release_id string", at=["verification_expires_at"])
    counts = readiness.publication_counts(e, "v7", "r", now)
    assert tuple(counts.first()) == (2, 1, 1, 1)
    runs = frame(spark, [("catalog_refresh", "succeeded", 0, 5, "v7", "2024-05-30"), ("catalog_refresh", "succeeded", 0, 5, "v7", "2024-05-20"), ("catalog_refresh", "failed", 0, 5, "v7", "2024-05-10")],
                 "run_type string, state string, dead_count int, job_count int, decision_version string, finished_at string", at=["finished_at"])
    weeks = readiness.healthy_weeks(runs, F.lit(2), "v7", now, 60)
    assert weeks.first().weeks == 2
    event = frame(spark, [("approved", "2024-01-01", "2024-12-01", 1)], "event_type string, effective_at string, expires_at string, maximum_new_publications int", at=["effective_at", "expires_at"])
    stale = spark.createDataFrame([("fsq",)], "source string")
    got = readiness.release_state(counts, weeks, event, stale, 3, 100, now).first()
    assert not got.ready and got.available_slots == 0 and got.blockers == ["published_verification_expired", "published_decision_version_stale", "insufficient_healthy_refresh_weeks", "source_stale:fsq", "release_capacity_exhausted"]
    none = readiness.release_state(counts, weeks, event.limit(0), stale.limit(0), 2, 100, now).first()
    assert none.blockers[0] == "authorization_missing"
    ddl = "candidate_state string, decision_version string, verification_expires_at string, primary_type string, verification_tier string, phone_e164 string, phone_source string, website_url string, website_source string"
    c = frame(spark, [("verified", "v7", "2024-07-01", "brewery", "provider", "+1", None, None, None), ("published", "v6", None, "pub", "open", None, None, "x", "fsq"), ("rejected", None, None, None, None, "1", None, None, None)], ddl, at=["verification_expires_at"])
    assert tuple(readiness.invariant_audit(c, "v7", now).first()) == (1, 1, 1, 1)
    cities = spark.createDataFrame([("a", "X"), ("a", "x"), ("b", "Y")], "county string, city string")
    assert [r.problem for r in readiness.manifest_problems(cities, 2, 4).collect()] == ["cities", "repeated"]
    facts = spark.createDataFrame([("123e4567-e89b-12d3-a456-426614174000", ["https://x"], 365, ""), ("x", [], 366, "")], "candidate_id string, evidence_urls array<string>, lease_days int, note string")
    assert [r.problems for r in readiness.fact_problems(facts).collect()] == [["candidate_id", "evidence_urls", "lease_days"]]
    act = lambda **k: spark.range(1).select(readiness.next_action(**{n: F.lit(v) for n, v in (dict(required_ready=True, expired=0, visible=0, legacy=0, detail=3, live=3, ready=0, review=0, errors=0) | k).items()}).alias("a")).first().a
    assert [act(), act(required_ready=False, expired=1), act(expired=1, ready=1), act(detail=2), act(errors=1), act(live=0, detail=0)] == [
        "none", "complete_required_snapshots", "sweep_expired", "restore_detail_routing", "retry_provider_errors", "leave_catalog_empty"]


@pytest.mark.parametrize("matching, families, want", [(0, 0, 0.6), (1, 1, 0.8), (2, 2, 0.83), (9, 9, 0.86)])
def test_type_confidence(spark, matching, families, want):
    got = spark.range(1).select(resolve.type_confidence(F.lit(matching), F.lit(0.8), F.lit(families), F.lit(0.6)).alias("c")).first().c
    assert got == pytest.approx(want)


def test_expiry_filters(spark):
    rows = frame(spark, [(1, "2024-01-01"), (2, "2024-01-03"), (3, None)], "id int, expires string", at=["expires"])
    assert sorted(r.id for r in queue.expired(rows, "expires", ts("2024-01-02")).collect()) == [1, 3]


LEAD = "the same opening words of every text " * 8


def test_equal_texts_reads_whole_texts(spark):
    rows = [(1, "en", LEAD + "a"), (2, "en", LEAD + "b"), (3, "en", LEAD + "a"), (4, "de", LEAD + "a"), (5, "en", "short"), (6, "en", "short"),
            (7, None, ""), (8, None, ""), (9, "en", None)] + [(i, "fr", LEAD) for i in range(100, 400)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    got = {r.doc_id: (r.class_id, r.members) for r in identity.equal_texts(docs, "doc_id", "text", ["lang"]).collect()}
    assert {k: v for k, v in got.items() if k < 100} == {1: (1, 2), 2: (2, 1), 3: (1, 2), 4: (4, 1), 5: (5, 2), 6: (5, 2), 7: (7, 2), 8: (7, 2)}
    assert len(got) == 308 and all(got[i] == (100, 300) for i in range(100, 400))


def test_rare_trigrams_lose_no_pair(spark):
    import random

    rng = random.Random(4)
    names = ["".join(rng.choices("abcd ", k=rng.randrange(1, 25))) for _ in range(150)]
    rows = spark.createDataFrame([(i, i % 3, n, "", None, None) for i, n in enumerate(names)], "id int, block int, name string, address string, lat double, lon double")
    grams = [{p[i : i + 3] for w in n.split() for p in [f"  {w} "] for i in range(len(p) - 2)} for n in names]
    sim = lambda i, j: len(grams[i] & grams[j]) / len(grams[i] | grams[j]) if grams[i] | grams[j] else 0.0
    for least in (0.3, 0.7):
        got = {(r.a, r.b): r.similarity for r in identity.trigram_pairs(rows, "id", "name", ["block"], least, inclusive=True).collect()}
        assert got == {(i, j): sim(i, j) for j in range(150) for i in range(j) if i % 3 == j % 3 and sim(i, j) >= least}
    found = {(r.record_id, r.anchor_id) for r in identity.fuzzy_block(rows, rows, ["block"], 1000).collect()}
    assert found == {(i, j) for i in range(150) for j in range(150) if i % 3 == j % 3 and sim(i, j) > 0.3}


EVIDENCE = ("entity int, field string, value_text string, normalized_value string, source string, evidence_id int, authority double, evidence_confidence double, identity_confidence double, "
            "source_updated_at timestamp, origin_keys array<string>")


def evidence(spark, *rows):
    """Evidence rows (field, value, source, id, confidence, origins) of entity 1 of full authority and identity, fresh."""
    import datetime as dt

    at = dt.datetime(2024, 5, 1)
    return spark.createDataFrame([(1, f, v, v.removeprefix("https://").removeprefix("http://"), s, i, 1.0, c, 1.0, at, o) for f, v, s, i, c, o in rows], EVIDENCE)


def decided(spark, *rows, **more):
    return {r.field: r for r in resolve.decide_fields(evidence(spark, *rows), ts("2024-06-01"), "v1", **more).collect()}


def test_field_decisions(spark):
    rows = [
        ("phone_e164", "+1", "fsq", 1, 0.9, ["foursquare"]), ("phone_e164", "+2", "overture", 2, 0.88, ["foursquare"]),  # the upstream beats its copy
        ("address", "a", "datasf", 3, 0.9, None), ("address", "b", "overture", 4, 0.88, ["meta"]),  # too close
        ("hours", "h", "osm", 5, 0.5, ["openstreetmap"]), ("hours", "h", "overture", 6, 0.58, ["meta"]),  # agreement lifts .58 to .62
        ("price_level", "2", "fsq", 7, 0.74, ["foursquare"]),  # below its least score
        ("website_url", "http://x", "fsq", 8, 0.95, ["foursquare"]), ("website_url", "https://x", "osm", 9, 0.7, ["openstreetmap"])]
    got = decided(spark, *rows)
    assert {f: (r.status, r.value_text) for f, r in got.items()} == {
        "phone_e164": ("selected", "+1"), "address": ("unknown", None), "hours": ("selected", "h"), "price_level": ("unknown", None), "website_url": ("selected", "https://x")}
    assert got["hours"].confidence == 0.62 and got["hours"].evidence_ids == [5, 6] and got["address"].value_count == 2
    kept = spark.createDataFrame([(1, "address", "old", 0.4567), (2, "hours", "old", None)], "entity int, field string, value_text string, confidence double")
    rows = resolve.decide_fields(evidence(spark, *rows), ts("2024-06-01"), "v1", kept).collect()
    held = {(r.entity, r.field): (r.value_text, r.confidence) for r in rows if r.reason == "retained_existing_canonical_value"}
    assert held == {(1, "address"): ("old", 0.457), (2, "hours"): ("old", 0.0)}


def test_only_changed_decisions_are_appended(spark):
    first, second = (resolve.decide_fields(evidence(spark, ("address", v, "datasf", 1, 0.9, None)), ts("2024-06-01"), "v1") for v in ("a", "b"))
    assert resolve.changed_decisions(first, first).count() == 0 and resolve.changed_decisions(second, first).count() == 1
    assert resolve.changed_decisions(first, second).count() == 1  # a return is a change


def test_discovery_follows_the_anchors_order(spark):
    import random

    rng = random.Random(8)
    ids = list(range(40))
    choices = {a: sorted(set(rng.sample(range(60), 3))) for a in ids}
    choices |= {a: [a + 1] for a in range(20, 39)}  # a chain: every second one is claimed
    anchors = spark.createDataFrame([(a, a) for a in ids], "id int, rank int")
    pairs = spark.createDataFrame([(a, r, "ca_abc", "match", True, 0.97, "rule") for a in ids for r in choices[a] if r != a],
                                  "anchor_id int, record_id int, source string, action string, compatible boolean, score double, reason string")
    active, links, reviews = discovery.discover(anchors, pairs)
    owner, skipped, late = {}, set(), set()
    for a in ids:
        if a in owner:
            skipped.add(a)
            continue
        for r in (a, *(r for r in choices[a] if r != a)):
            if r in owner:
                late.add((a, r))
            owner.setdefault(r, a)
    assert {r.id for r in active.collect()} == set(ids) - skipped and skipped
    assert {r.record_id: r.candidate_id for r in links.collect()} == owner
    assert {(r.candidate_id, r.record_id) for r in reviews.collect()} == late


def test_records_are_chosen_by_margin(spark):
    rows = [(1, 1, "osm", "match", True, 0.99), (1, 2, "osm", "match", True, 0.97), (1, 3, "fsq", "match", True, 0.99), (1, 4, "fsq", "match", True, 0.95),
            (1, 5, "fsq", "match", False, 0.985), (1, 6, "ca_abc", "match", True, 0.97), (1, 7, "ca_abc", "match", True, 0.97), (1, 8, "osm", "review", True, 0.995)]
    pairs = spark.createDataFrame([(*r, "rule") for r in rows], "anchor_id int, record_id int, source string, action string, compatible boolean, score double, reason string")
    assert {r.record_id for r in discovery.choose_records(pairs).where("chosen").collect()} == {3, 6, 7}


def test_leases(spark):
    rows = [  # job 1: a stale holder cannot complete; job 2: fails, is retried after its delay; job 3: dead after three claims
        (1, 0, "enqueue", 0, None), (1, 1, "claim", 10, "a"), (1, 2, "claim", 50, "b"), (1, 3, "claim", 120, "b"), (1, 4, "complete", 130, "a"),
        (2, 0, "enqueue", 0, None), (2, 1, "claim", 10, "a"), (2, 2, "fail", 20, "a"), (2, 3, "claim", 40, "b"), (2, 4, "claim", 90, "b"), (2, 5, "complete", 95, "b"),
        (3, 0, "enqueue", 0, None), (3, 1, "claim", 10, "a"), (3, 2, "claim", 120, "a"), (3, 3, "claim", 230, "a")]
    log = spark.createDataFrame([(j, o, k, at, w, True, 60) for j, o, k, at, w in rows], "job int, o int, kind string, at long, worker string, retryable boolean, delay long")
    at = lambda n: F.timestamp_seconds(F.lit(n))
    state = lambda n: {r.job: (r.state, r.worker, r.attempts) for r in queue.replay_leases(log, "job", ["o"], at(n), visibility=100).collect()}
    assert state(200) == {1: ("leased", "b", 2), 2: ("succeeded", None, 2), 3: ("leased", "a", 3)}
    assert state(1000) == {1: ("queued", None, 2), 2: ("succeeded", None, 2), 3: ("dead", None, 3)}


def test_latest_row_with_a_map(spark):
    from cairn.operators import latest

    rows = spark.createDataFrame([(1, 1, {"a": 1}, 5), (1, 2, {"b": 2}, 6)], "k int, t int, m map<string,int>, v int")
    assert latest.latest_per_key(rows, ["k"], ["t"]).first().asDict() == {"k": 1, "t": 2, "m": {"b": 2}, "v": 6}
