"""Archives, URL filters, embeddings and the pipeline."""

import hashlib

import numpy as np
import pytest

from cairn.llm import embedding_dedup, url_filters, warc
from pyspark.sql import functions as F

PAGES = "page_id long, url string, html string"


@pytest.fixture(scope="module")
def odd_pages(spark):
    big = "<p>" + "é" * 700 + "</p>"
    rows = [(1, "https://a.example.org/x?q=1#f", big), (2, "http://B.example.org/x", big), (3, None, big), (4, "no scheme", None), (5, "ftp://h", ""),
            (6, "http://c.com/" + "p" * 5000, "y" * 300_000), (7, "http://c.com/a b\tc\u00a0d", "small"), (8, "http://c.com/small", "small"),
            (9, "http://d.net", big), (9, "http://d.net", big), (None, "http://n.net/", "z" * 2000), (10, "://x/y", "k" * 999), (11, "://x/y", "k" * 999)]
    return spark.createDataFrame([(*r, 1, "h") for r in rows], PAGES + ", key int, sha1 string")


def test_archive_round_trip(odd_pages):
    archive = warc.write_archive(odd_pages, shards=3)
    keys = odd_pages.select(warc.page_key(F.col("page_id"), F.col("url")).alias("key"))
    got = warc.look_up(archive, keys).collect()
    rows = odd_pages.collect()
    assert len(got) == len(rows)
    payload = {r.page_id: (r.html or "").encode() for r in rows}
    for r in got:
        p = payload[r.page_id]
        assert (r.payload_bytes, r.payload_digest) == (len(p), hashlib.sha1(p).hexdigest())
        same = [i for i, q in payload.items() if q == p and i is not None]
        if len(p) >= 1000 and same and r.page_id != max(same):
            assert (r.record_type, r.refers_to, r.payload) == ("revisit", max(same), None)
        else:
            assert (r.record_type, r.refers_to) == ("response", None) and bytes(r.payload) == p


def test_archive_is_gzip_members_and_index_finds_absent_keys(odd_pages):
    import gzip

    archive = warc.write_archive(odd_pages, shards=1)
    (uri, index, _, _) = archive.shards[0]
    reader = warc.files.Reader(uri)
    whole = gzip.decompress(reader.read(0, reader.size()))
    assert whole.count(b"WARC/1.1\r\n") == odd_pages.count()
    found = warc.IndexReader(index)
    assert found.find("nothing") == [] and found.find("zzz") == [] and found.find("") == []


def test_archive_index_blocks(spark, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_LINES", 4)
    rows = [(i, f"http://h{i % 3}.com/{i // 3:03d}", f"page {i}") for i in range(50)]
    pages = spark.createDataFrame(rows, PAGES)
    archive = warc.write_archive(pages, shards=2)
    got = warc.look_up(archive, pages.select(warc.page_key(F.col("page_id"), F.col("url")).alias("key"))).collect()
    assert sorted((r.page_id, bytes(r.payload).decode()) for r in got) == [(i, f"page {i}") for i in range(50)]


def test_archive_empty(spark):
    empty = spark.createDataFrame([], PAGES)
    archive = warc.write_archive(empty)
    assert archive.shards == [] and warc.look_up(archive, empty.select(F.col("url").alias("key"))).count() == 0


def judged(df):
    return {r.page_id: (r.host, r.path, r.rule, r.verdict, r.basis) for r in df.collect()}


def test_urls(spark):
    urls = [None, "", "x", "http://A.Example.ORG/es/1?q#f", "http://example.org/en/1x", "http://example.org/en/2", "http://notexample.org/es/1", "http://x.com/de/",
            "http://x.com/fr/?a", "http://com/de/1", "http://x.com", "http://x.org", "http://x.org?/", "http://x.org:80/", "http://xorg/", "//x.org/", "http://a.b://c/d"]
    df = spark.createDataFrame([(i, u, None) for i, u in enumerate(urls)], PAGES)
    got = judged(url_filters.filter_urls(df))
    assert got[0] == got[1] == got[2] == ("", "", None, "allow", "default")
    assert got[3] == ("a.example.org", "/es/1", "example.org/es/", "block", "rule")
    assert got[4][2:4] == ("example.org/en/1", "block") and got[5][2:4] == ("org/", "allow") and got[6][2:4] == ("org/", "allow")
    assert got[7][2:4] == ("com/de/", "block") and got[8][2:4] == ("com/fr/", "allow") and got[9][2:4] == ("com/de/", "block")
    assert got[10][:3] == ("x.com", "", None) and got[11][2] is None and got[12][:3] == ("x.org", "", None)
    assert got[13][:3] == ("x.org:80", "/", None) and got[14][2] is None and got[15][:2] == ("", "") and got[16][:2] == ("a.b:", "//c/d")
    assert url_filters.filter_urls(df.limit(0)).count() == 0


def test_aliases(spark):
    link = "<head><link rel='canonical' href='{}'></head>"
    rows = [(1, "http://a.net/1", link.format("http://x.com/de/9")), (2, "http://a.net/2", '<META http-equiv="refresh" content="0; URL=/1">'),
            (3, "http://x.com/fr/3", link.format("http://a.net/1")), (4, "http://b.net/1", link.format("http://y.com/de/1")),
            (5, "http://b.net/1#top", None), (6, "http://c.net/", link.format("http://c.net/")), (7, "http://y.com/de/1", None)]
    pages = spark.createDataFrame(rows, PAGES)
    got = judged(url_filters.filter_urls(pages))
    assert {i: v[3:] for i, v in got.items()} == {
        1: ("allow", "alias"), 2: ("allow", "alias"), 3: ("allow", "rule"), 4: ("block", "alias"), 5: ("block", "alias"), 6: ("allow", "default"), 7: ("block", "rule")}
    without = judged(url_filters.filter_urls(pages.where("page_id <> 3")))
    assert without[1][3:] == without[2][3:] == ("block", "alias")
    redirects = spark.createDataFrame([("http://c.net/", "http://b.net/1"), (None, "http://b.net/1")], "from_url string, to_url string")
    assert judged(url_filters.filter_urls(pages, redirects=redirects))[6][3:] == ("block", "alias")


@pytest.mark.parametrize("reference, target", [  # the examples of RFC 3986, 5.4, for the base http://a/b/c/d;p?q, without scheme and fragment
    ("g:h", None), ("g", "a/b/c/g"), ("./g", "a/b/c/g"), ("g/", "a/b/c/g/"), ("/g", "a/g"), ("//g", "g"), ("?y", "a/b/c/d;p?y"), ("g?y", "a/b/c/g?y"),
    ("#s", None), ("g#s", "a/b/c/g"), (";x", "a/b/c/;x"), ("g;x?y#s", "a/b/c/g;x?y"), ("", None), (".", "a/b/c/"), ("./", "a/b/c/"), ("..", "a/b/"),
    ("../", "a/b/"), ("../g", "a/b/g"), ("../..", "a/"), ("../../g", "a/g"), ("../../../g", "a/g"), ("/./g", "a/g"), ("/../g", "a/g"), ("g.", "a/b/c/g."),
    ("..g", "a/b/c/..g"), ("./g/.", "a/b/c/g/"), ("g/../h", "a/b/c/h"), ("g;x=1/../y", "a/b/c/y"), ("g?y/../x", "a/b/c/g?y/../x"), ("https://H/x/../y?z", "h/y?z"),
    ("mailto:a@b", None)])
def test_references(spark, reference, target):
    df = spark.createDataFrame([("http://a/b/c/d;p?q", reference)], "base string, ref string")
    assert df.select(url_filters.url_node(url_filters.resolve(F.col("base"), F.col("ref"))).alias("t")).first().t == target


def test_links_of_a_page(spark):
    rows = [("http://a.net/x/1", """<base href="/y/z"><LINK href=2 rel='alternate canonical'><link rel=canonical href="?p=1&amp;q=2">"""),
            ("http://b.net", "<meta content=0;url=one http-equiv=refresh><meta http-equiv='Refresh' content='5; URL=\"../two\"'>"),
            ("http://c.net/", "<link rel='not-canonical' href='x'><a rel='canonical' href='y'>http-equiv</a><link data-href='z' rel='canonical'>"), (None, "<link rel=canonical href=/x>")]
    pages = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], PAGES)
    assert sorted((r.src, r.dst) for r in url_filters.alias_edges(pages).collect()) == [
        ("a.net/x/1", "a.net/y/2"), ("a.net/x/1", "a.net/y/z?p=1&q=2"), ("b.net", "b.net/one"), ("b.net", "b.net/two")]


def test_vectors_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [1.0, 0.0]), (4, None), (5, []), (6, [0.0, 0.0]), (7, [nan, 1.0]), (8, [inf, 1.0]), (9, [1.0, None]), (10, [1.0, 0.0, 0.0]),
            (11, [0.0, 1.0]), (12, [-1.0, 0.0]), (None, [1.0, 0.0]), (13, [1e-200, 0.0]), (14, [1.0, 0.4])]
    df = spark.createDataFrame([(*r, 0, 3) for r in rows], "vec_id long, embedding array<double>, label int, dim int")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embedding_dedup.near_duplicates(df).collect()}
    assert got[1] == (4, 1, True) and got[2] == (4, 1, False) and got[3] == (4, 1, False) and got[13] == (4, 1, False) and got[14] == (4, 1, False)
    for i in (4, 5, 6, 7, 8, 9, 10, 11, 12):
        assert got[i] == (0, i, True)
    assert got[None][:2] == (0, None)
    assert embedding_dedup.near_duplicates(df.limit(0)).count() == 0


def test_vectors_recall_and_blocks(spark):
    rng = np.random.default_rng(4)
    centers = rng.standard_normal((12, 32))
    x = np.concatenate([centers[rng.integers(0, 12, 300)] + 0.28 * rng.standard_normal((300, 32)), rng.standard_normal((200, 32))]).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    close = (u @ u.T >= 0.9) & ~np.eye(len(x), dtype=bool)
    results = []
    for block in (1024, 16):
        got = {r.vec_id: r for r in embedding_dedup.near_duplicates(df, block=block).collect()}
        n = np.array([got[i].n_links for i in range(len(x))])
        assert (n <= close.sum(axis=1)).all() and n.sum() >= 0.9 * close.sum() and close.sum() > 300
        assert all(got[i].kept == (got[i].component_id == i) for i in got)
        results.append([(got[i].n_links, got[i].component_id) for i in range(len(x))])
    assert results[0] == results[1]


def test_vectors_of_integers_and_repeated_ids(spark):
    rows = [(1, [3, 4]), (2, [3, 5]), (2, [3, 5]), (3, [-4, 3]), (4, [3, 4]), (4, [-4, 3])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<int>")
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in embedding_dedup.near_duplicates(df).collect())
    # 4 has two vectors, that of 1 and that of 3, and so joins their components
    assert got == [(1, 3, 1), (2, 3, 1), (2, 3, 1), (3, 1, 1), (4, 1, 1), (4, 3, 1)]


def test_cosines_at_the_threshold_in_double_precision():
    rng = np.random.default_rng(9)
    x = embedding_dedup._units(rng.standard_normal((300, 64)))
    exact = x @ x.T
    for threshold in np.quantile(exact, [0.2, 0.5, 0.9]):
        assert (embedding_dedup._close(x, np.arange(300), np.arange(300), threshold) == (exact >= threshold)).mean() > 0.9999


def test_table_plan():
    for n in (10, 10_000, 10**9):
        bits, tables = embedding_dedup.table_plan(n)
        agree = (1 - np.arccos(0.9) / np.pi) ** bits
        assert 1 - (1 - agree) ** tables >= 0.97


def test_pipeline(spark, odd_docs, words, tmp_path):
    import corpus_pipeline

    labels = spark.createDataFrame([(1, 1, 0), (8, 1, 0), (9, 1, 0)], "doc_id long, quality int, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    odd_docs.write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, kept[-1], str(tmp_path))
        out.write.parquet(str(tmp_path / name))
        kept.append(spark.read.parquet(str(tmp_path / name)))
    assert all(k.columns == docs.columns for k in kept[:-1])
    first = kept[1].collect()
    assert {r.doc_id for r in first} == {1, 2, 9, 11, None}  # the very long text repeats itself
    third = {r.doc_id for r in kept[3].collect()}
    assert third == {1, 9, None}
    passages = {r.doc_id: r.text for r in kept[4].collect()}
    assert passages[1] == " ".join(words[:120]) and passages[9] == " ".join(words[200:400]) + ".\n"
    assert {r.doc_id for r in kept[5].collect()} == third
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == kept[5].count()


def test_pipeline_stages_on_rows_without_id(spark, words, tmp_path):
    import corpus_pipeline

    rows = [(None, " ".join(words[:200])), (4, " ".join(words[:200])), (None, " ".join(words[300:500])), (None, " ".join(words[300:499])),
            (7, " ".join(words[600:700])), (7, " ".join(words[600:700])), (7, " ".join(words[800:900] + words[620:690])), (None, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", None) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "d"))
    kept = corpus_pipeline.near_duplicate_stage(spark, spark.read.parquet(str(tmp_path / "d")), str(tmp_path))
    left = sorted((r.doc_id or 0, len((r.text or "").split())) for r in kept.collect())
    assert left in ([(0, 0), (0, n), (4, 200), (7, 100), (7, 170)] for n in (199, 200))
    cut = corpus_pipeline.passage_stage(spark, kept, str(tmp_path)).collect()
    assert sum(len((r.text or "").split()) for r in cut if r.doc_id == 7) == 200
