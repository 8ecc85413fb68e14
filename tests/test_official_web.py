"""Official-web check: references on pages, the frontier of a site, names by identity and order of sites."""

from urllib.parse import urljoin

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cairn.functions.text import resolve_url
from cairn.operators import official_web
from cairn.sources import pages

BASES = ("https://a.example/x/y?q=1#f", "https://a.example", "http://a.example/x/")
HREFS = ("z", "./z", "../z", "../../../z", "/z/../w", "?p=2", "#top", "", "//b.example/k", "mailto:a@b", "https://c.example/..", "z/.", "z/..", "/", "a/b/../c?d=../e")


def test_resolve_url(spark):
    rows = [(b, h) for b in BASES for h in HREFS] + [(None, "x"), ("https://a.example", None)]
    got = spark.createDataFrame(rows, "b string, h string").select("b", "h", resolve_url(F.col("b"), F.col("h")).alias("u")).collect()
    for r in got:
        if r.b is None or r.h is None:
            assert r.u is None
        elif r.h == "" or r.h.startswith("#"):
            assert r.u.split("#")[0] == r.b.split("#")[0]
        elif not r.h.startswith("https:"):
            assert r.u == urljoin(r.b, r.h).replace("https://a.example?", "https://a.example?"), (r.b, r.h)


def site(spark):
    html = {
        "a.example": ["contact", "/news", "/locations/1", "/locations/1", "https://b.example/contact", "/oakland", "/visit", "/taproom"],
        "a.example/contact": ["/visit/deep"], "a.example/locations/1": [], "a.example/oakland": [], "a.example/visit": [], "a.example/taproom": [],
        "a.example/visit/deep": [], "a.example/news": [], "b.example/contact": [], "loop.example": ["/contact"], "loop.example/contact": ["/", "/contact", "/visit"], "loop.example/visit": ["/contact"],
    }
    known = spark.createDataFrame([(k, i, "https://" + k) for i, k in enumerate(html)] + [("a.example/locations", 2, "https://a.example/locations/1")], "key string, page int, url string")
    links = spark.createDataFrame([(i, at, h) for i, k in enumerate(html) for at, h in enumerate(html[k])], "page int, at int, href string")
    return known, links, {k: i for i, k in enumerate(html)}


@pytest.mark.parametrize("hops, most, want", [
    (1, 4, ["a.example", "a.example/contact", "a.example/locations/1", "a.example/oakland"]),
    (1, 9, ["a.example", "a.example/contact", "a.example/locations/1", "a.example/oakland", "a.example/visit", "a.example/taproom"]),
    (2, 9, ["a.example", "a.example/contact", "a.example/locations/1", "a.example/oakland", "a.example/visit", "a.example/taproom", "a.example/visit/deep"]),
    (3, 2, ["a.example", "a.example/contact"]),
])
def test_frontier(spark, hops, most, want):
    known, links, number = site(spark)
    starts = spark.createDataFrame([("a.example", "Oakland"), ("a.example", "Oakland"), ("nowhere.example", "Oakland")], "start string, city string")
    got = official_web.walk_sites(starts, known, links, hops, most).orderBy("turn").collect()
    assert [r.page for r in got] == [number[k] for k in want]
    assert [r.turn for r in got] == list(range(len(want)))


def test_frontier_ends_in_loops_and_keeps_cities_apart(spark):
    known, links, number = site(spark)
    starts = spark.createDataFrame([("loop.example", None), ("a.example", ""), ("a.example", "Oakland"), ("a.example", "news")], "start string, city string")
    got = official_web.walk_sites(starts, known, links, 20, 9).collect()
    by = {}
    for r in sorted(got, key=lambda r: r.turn):
        by.setdefault((r.start, r.city), []).append(r.page)
    assert by["loop.example", None] == [number[k] for k in ("loop.example", "loop.example/contact", "loop.example/visit")]
    assert number["a.example/oakland"] not in by["a.example", ""]
    assert by["a.example", "news"][2] == number["a.example/news"]


def test_official_names(spark):
    """The first site with a name wins, whatever later ones say; pages below the least identity name nobody."""
    known, links, number = site(spark)
    texts = {"a.example": "Welcome to Oakland", "a.example/contact": "Fox, 12 Main St, Oakland 94110", "a.example/locations/1": "call 510-555-0100 in Oakland",
             "b.example/contact": "Owl +1 (510) 555-0100, 12 Main St, Oakland 94110"}
    names = {"a.example": [("Start", .99)], "a.example/contact": [("Fox", .76), ("Fox Bar", .9)], "a.example/locations/1": [("Fox Taproom", .92)], "b.example/contact": [("Owl", .99)]}
    contents = spark.createDataFrame([(number[k], t, names[k]) for k, t in texts.items()], "page int, text string, names array<struct<name:string,confidence:double>>")
    sites = ["http://www.a.example/", "https://a.example", None, "", "b.example/contact"]
    places = spark.createDataFrame([
        (1, "Oakland", "12 Main Street", "94110", ["+15105550100", None], sites), (2, "Oakland", "12 Main Street", "94110", [], ["b.example/contact", "a.example"]),
        (3, "Oakland", "77 Elm Street", None, None, sites), (4, None, None, None, None, None), (5, "Oakland", "12 Main Street", "94110", ["+15105550100"], [])],
        "e int, city string, address string, postal_code string, phones array<string>, websites array<string>")
    got = {r.e: (r.name, r.page, r.start_no, round(r.identity, 2)) for r in official_web.official_names(places, known, links, contents, "e").collect()}
    assert got == {1: ("Fox Bar", number["a.example/contact"], 0, .9), 2: ("Owl", number["b.example/contact"], 0, .9)}


def test_name_rules(spark):
    html = ('<title>Red Fox | Beer and more</title><meta name="Application-Name" content=" Red Fox App "><meta property="og:title" content="no"><script type="application/ld+json">'
            '[{"@type":"organization","name":"Holding"},{"@type":["Organization"],"address":{"a":1},"name":"Red Fox Inc"},{"@graph":{"@type":"brewery","name":"Red Fox Brewing"}}]</script>')
    rows = spark.createDataFrame([(1, html), (2, "<title>x</title>")], "k int, html string").select("k", F.explode(pages.page_names("html")).alias("n")).collect()
    assert [(r.k, r.n.name, r.n.confidence) for r in rows] == [(1, "Red Fox Inc", .92), (1, "Red Fox Brewing", .99), (1, "Red Fox App", .9), (1, "Red Fox", .76)]


def test_pages_are_handed_on_by_pieces(spark, monkeypatch):
    """No more pages than a piece has are held as objects, whatever the length of a batch; rows, nulls and empty pages stay in their places."""
    monkeypatch.setattr(pages, "PIECE_PAGES", 3)
    monkeypatch.setattr(pages, "PIECE_BYTES", 40)
    html = pa.array(["<title>aa</title>", None, "", "<a href=x>y</a>" * 9, "<title>bb</title>", "<title>cc</title>", None, None, None])
    pieces = list(pages._pieces(html))
    assert [len(p) for p in pieces] == [3, 1, 3, 2]
    assert [t for p in pieces for t in p.field("title").to_pylist()] == ["aa", None, None, None, "bb", "cc", None, None, None]
    monkeypatch.undo()
    texts = [(i, h) for i, h in enumerate(html.to_pylist())]
    df = spark.createDataFrame(texts * 150, "k int, html string").coalesce(1)
    got = pages.parsed_pages(df, "title", "links", "names").groupBy("k", "title", "links", "names").count().collect()
    want = df.select("k", pages.parse_page("html").alias("x"), pages.page_names("html").alias("n")).groupBy("k", "x.title", "x.links", "n", "x.names").count().collect()
    assert len(got) == len(html) and sorted(map(repr, ((r.k, r.title, r.links, r.names or []) for r in got))) == sorted(map(repr, ((r.k, r.title, r.links, r.n) for r in want)))
    assert {r["count"] for r in got} == {150}
