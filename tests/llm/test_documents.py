"""Operators on documents: odd rows, empty tables, and brute force on small fixtures."""

import collections
import hashlib
import re
import zlib

import numpy as np
import pytest
from pyspark import cloudpickle

from cairn.llm import bpe_documents, components, ngram_join, packing, quality, suffix_dedup, token_files, toxicity
from cairn.llm.queries import tokenizer_path
from cairn.llm.scratch import Scratch

WORD = re.compile("[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sequences(docs):
    return [(r.doc_id, WORD.findall((r.text or "").translate(LOWER))) for r in docs.select("doc_id", "text").collect()]


def by_id(df, *columns):
    out = collections.defaultdict(list)
    for r in df.collect():
        out[r["doc_id"]].append(tuple(r[c] for c in columns))
    return out


# --- quality ---------------------------------------------------------------


def test_quality_counts(odd_docs):
    got = by_id(quality.quality_report(odd_docs), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    for r in odd_docs.collect():
        t = r.text or ""
        w = WORD.findall(t)
        c = collections.Counter(zip(w, w[1:], w[2:]))
        covered = {j for i in range(len(w) - 2) if c[tuple(w[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        want = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered))
        assert got[r.doc_id][0] == (*want, len(w) < 50 or 100 * len(covered) > 50 * len(w))


@pytest.mark.parametrize("text, want", [
    ("a a a", 0), ("a a a a", 4), ("a b c a b c", 6), ("x a b c y a b c z", 6), ("a b c d", 0), ("a b a b a", 5), ("a\nb\nc a b c", 6)])
def test_repeat_words(spark, text, want):
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert quality.quality_report(df).first().n_repeat_words == want


def test_quality_order_does_not_change_verdicts(odd_docs):
    rules = quality.production_rules()
    from pyspark.sql import functions as F

    ways = [quality.order_rules(rules, [quality.Estimate(r.name, s, 0.1) for r, s in zip(rules, times)]) for times in ([1, 2, 3, 4, 5], [5, 4, 3, 2, 1])]
    kept = [sorted(str(r) for r in odd_docs.where(quality.first_rejection(w, F.col("text")).isNull()).select("doc_id", "text").collect()) for w in ways]
    assert kept[0] == kept[1]
    assert [r.name for r in ways[0]] == [r.name for r in ways[1]][::-1]
    assert quality.quality_filter(odd_docs).columns == odd_docs.columns


def test_quality_empty(no_docs):
    assert quality.quality_report(no_docs).count() == 0
    assert quality.quality_filter(no_docs).count() == 0


# --- toxicity --------------------------------------------------------------


def toxic_corpus(spark, words, n=400):
    rows, labels = [], []
    for i in range(n):
        parts = [" ".join(words[(i * 37 + 9 * k) % 2900 :][:9]) for k in range(6)]
        bad = i % 4 == 0
        if bad:
            parts[i % 6] += f" {('grumblefoo', 'snarkelbar')[i % 3 % 2]}{'xyz'[i % 3]} thing"
        rows.append((i, ". ".join(parts) + "."))
        labels.append((i, 1, int(bad)))
    return (spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_toxicity_held_out_and_located(spark, words):
    docs, labels = toxic_corpus(spark, words)
    scored = toxicity.score(docs, toxicity.train(docs, labels)).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    held = [r for r in scored if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    right = sum((r.score >= 0.5) == (r.doc_id % 4 == 0) for r in held)
    assert right >= 0.95 * len(held)
    hits = [r for r in held if r.doc_id % 4 == 0 and r.offending]
    assert hits and all(
        any(s in texts[r.doc_id].encode()[o.start : o.end].decode() for s in ("grumblefoo", "snarkelbar")) for r in hits for o in r.offending)


def test_toxicity_learns_nothing_from_held_out_rows(spark, words):
    docs, labels = toxic_corpus(spark, words, 100)
    sample = toxicity.training_sample(docs, labels).collect()
    assert sample and all(zlib.crc32(str(r.doc_id).encode()) % 5 for r in sample)
    assert toxicity.training_sample(docs, labels, max_documents=7).count() <= 7


def test_toxicity_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1, 0), (9, 1, 1), (None, 1, 1), (8, 0, None)], "doc_id long, quality int, toxic int")
    model = toxicity.train(odd_docs, labels)
    rows = toxicity.score(odd_docs, model).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert all(r.score == 0 and r.n_sentences == 0 for r in rows if r.doc_id in (3, 4, 5))
    assert toxicity.score(no_docs, toxicity.train(no_docs, labels)).count() == 0


def test_toxicity_sample_is_random_when_words_run_out(spark, words):
    rows = [(i, " ".join(words[7 * i : 7 * i + 9] + ["vile" if i >= 200 else "mild"]) + ".") for i in range(400)]  # the higher ids are toxic
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, int(i >= 200)) for i, _ in rows], "doc_id long, quality int, toxic int")
    scored = toxicity.score(docs, toxicity.train(docs, labels, max_words=1000)).collect()
    assert all((r.score > 0.5) == (r.doc_id >= 200) for r in scored)


def test_toxicity_words_are_taken_in_turn():
    assert toxicity.TRAIN_WORDS == 5_000_000
    assert toxicity._within([(3, 1, 40), (1, 9, 50), (2, 5, 45), (0, 7, 101), (4, 2, 5)], 100) == [(5, 45), (9, 50)]


def test_toxicity_slopes_are_those_of_the_likelihood():
    rng = np.random.default_rng(5)
    document, y = np.sort(rng.integers(0, 12, 60)), rng.integers(0, 2, 12).astype(float)

    def loss(z):
        p = 1 / (1 + np.exp(-z))
        of_doc = np.array([1 - np.prod(1 - p[document == d]) for d in range(12)])
        seen = np.unique(document)
        return -np.sum(np.where(y > 0, np.log(of_doc), np.log1p(-of_doc))[seen])

    z = rng.normal(-1, 1, 60)
    slopes = toxicity._slopes(z, document, y)
    for i in range(60):
        step = np.zeros(60)
        step[i] = 1e-5
        assert abs((loss(z + step) - loss(z - step)) / 2e-5 - slopes[i]) < 1e-5


def test_toxicity_scores_are_noisy_or_of_sentences(words):
    import pyarrow as pa

    from cairn.llm import wordhash

    rng = np.random.default_rng(6)
    texts = ["", " ".join(words[:130]), "One two. Three!\nfour\n\nfive? (six) " + " ".join(words[5:9]), "\n.\n", "a. " * 50]
    model = toxicity.Model(rng.normal(0, 0.3, toxicity.BUCKETS), -1.5)
    feature = lambda w: toxicity._features(next(wordhash.blocks(pa.array([w]))))[:, 0]
    got = np.zeros(len(texts))
    for block in wordhash.blocks(pa.array(texts), 64):
        got[block.first : block.first + block.n_docs] = model.score(block)[0]
    for t, score in zip(texts, got):
        clean, sentence = 1.0, []
        found = [(m.group(), m.start(), m.end()) for m in WORD.finditer(t)]
        for i, (w, start, end) in enumerate(found):
            sentence.append(w)
            last = i + 1 == len(found)
            if last or w[-1] in ".!?" or "\n" in t[end : found[i + 1][1]]:
                logit = model.bias + sum(model.weights[feature(x)].sum() for x in sentence)
                clean *= 1 - 1 / (1 + np.exp(-logit))
                sentence = []
        assert abs(score - (1 - clean)) < 1e-9


# --- n-gram join -----------------------------------------------------------


def jaccard_classes(seqs):
    sets = {}
    for i, w in seqs:
        sets[i] = set(zip(*(w[k:] for k in range(5)))) if len(w) >= 5 else ({tuple(w)} if w else set())
    label = {i: i for i in sets}
    changed = True
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    return {i: (len(sets[i]), label[i]) for i in sets}


def test_ngram_odd_rows(odd_docs, no_docs):
    got = by_id(ngram_join.similarity_classes(odd_docs), "n_shingles", "component_id")
    want = jaccard_classes([(i, w) for i, w in sequences(odd_docs) if i is not None])
    assert {i: v[0] for i, v in got.items() if i is not None} == want
    assert len(got[10]) == 2 and got[None][0][1] is None
    assert ngram_join.similarity_classes(no_docs).count() == 0


def test_ngram_near_copies_chains_and_ties(spark, words):
    rows = [(i, " ".join(words[i * 3 : i * 3 + 60])) for i in range(30)]  # chains of overlapping texts
    rows += [(100 + i, " ".join([*words[:i], f"new{i}", *words[i + 1 : 200]])) for i in range(60)]  # near copies
    rows += [(300 + i, " ".join([*words[900:940], *words[1000 + i * 20 : 1012 + i * 20]])) for i in range(25)]  # a shared passage
    rows += [(400 + i, " ".join(words[50 : 50 + i])) for i in range(1, 14)]  # small sets
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = by_id(ngram_join.similarity_classes(docs), "n_shingles", "component_id")
    assert {i: v[0] for i, v in got.items()} == jaccard_classes(sequences(docs))


def test_ngram_boundary_both_sides(spark, words, monkeypatch):
    rows = [(i, " ".join(words[7 * (i // 3) : 7 * (i // 3) + 12 + i % 40] + [f"end{i % 2}"])) for i in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = jaccard_classes(sequences(docs))
    for small in (0, 8, 30, 60):
        monkeypatch.setattr(ngram_join, "boundary", lambda sizes, one, two, s=small: s)
        got = by_id(ngram_join.similarity_classes(docs), "n_shingles", "component_id")
        assert {i: v[0] for i, v in got.items()} == want


@pytest.mark.parametrize("block", [2, 8, 2048])
def test_ngram_parts_bring_open_pairs_together(spark, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "LIST_BLOCK", block)
    rng = np.random.default_rng(block)
    rows = []
    for k in range(12):
        sizes = rng.choice([10, 12, 20, 21, 40, 90, 100] if k else [100], rng.integers(2, 40))
        rows += [(k, 7, i, int(s), int(c), b"x") for i, (s, c) in enumerate(zip(sizes, rng.integers(0, 1 + k, len(sizes))))]
    members = spark.createDataFrame(rows, "list1 long, list2 long, doc_id long, size int, component long, sketch binary")
    parts = collections.defaultdict(list)
    for r in ngram_join._parts_of_long_lists(members).collect():
        parts[r.part1, r.part2].append(r)
    met = collections.Counter()
    for own in parts.values():
        met.update({(min(x.doc_id, y.doc_id), max(x.doc_id, y.doc_id), x.size + y.size) for i, x in enumerate(own) for y in own[:i] if x.side + y.side < 2})
    for x in rows:
        for y in rows:
            if x[0] == y[0] and x[2] < y[2] and x[4] != y[4] and 100 * min(x[3], y[3]) >= 80 * max(x[3], y[3]):
                assert met[x[2], y[2], x[3] + y[3]]


def test_ngram_blocks_of_a_long_list_share_a_member(monkeypatch):
    monkeypatch.setattr(ngram_join, "LIST_BLOCK", 4)
    rng = np.random.default_rng(1)
    for n in range(2, 30):
        ids, sizes = rng.permutation(n), np.sort(rng.integers(8, 12, n))
        parts = [set(p.tolist()) for p in ngram_join._blocks(ids, sizes)]
        assert set().union(*parts) == set(range(n)) and all(2 <= len(p) <= 6 for p in parts)
        assert all(a & b for a, b in zip(parts, parts[1:])) and (n <= 4 or all(sizes[-1] * 4 > sizes[0] * 5 or int(ids.argmin()) in p for p in parts))


@pytest.mark.parametrize("block", [2, 8, 2048])
def test_ngram_small_blocks_and_chunks(spark, words, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "LIST_BLOCK", block)
    monkeypatch.setattr(ngram_join, "HUB_CHUNK", 2)
    rows = [(i, " ".join([*words[:i], f"new{i}", *words[i + 1 : 60 if i < 25 else 130]])) for i in range(40)]  # near copies of two sizes
    rows += [(100 + i, " ".join([*words[900:940], *words[1000 + i * 20 : 1012 + i * 20 + 90 * (i % 3)]])) for i in range(25)]
    rows += [(200 + i, " ".join(words[300 + i : 340 + i])) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    cloudpickle.register_pickle_by_value(ngram_join)  # or workers import the module with its own bounds
    try:
        got = by_id(ngram_join.similarity_classes(docs), "n_shingles", "component_id")
    finally:
        cloudpickle.unregister_pickle_by_value(ngram_join)
    assert {i: v[0] for i, v in got.items()} == jaccard_classes(sequences(docs))


def test_ngram_repeated_ids(spark, words):
    a, b, c = (" ".join(words[k : k + 60]) for k in (0, 300, 600))
    rows = [(1, a), (2, b), (5, a + " end"), (5, b), (7, c), (7, c), (8, c), (9, "z " + b)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = by_id(ngram_join.similarity_classes(docs), "n_shingles", "component_id")
    assert got == {1: [(56, 1)], 2: [(56, 1)], 5: got[5], 7: [(56, 7)] * 2, 8: [(56, 7)], 9: [(57, 1)]}
    assert sorted(got[5]) == [(56, 1), (57, 1)]


def thue_morse(n, letters):
    return "".join(letters[bin(i).count("1") & 1] for i in range(n))


def test_arranged_letters_do_not_collide(spark, words):
    one, two = "zzzzzzzz" + thue_morse(2048, "ab"), "zzzzzzzz" + thue_morse(2048, "ba")
    docs = spark.createDataFrame(
        [(1, one), (2, two), (3, " ".join([one] * 60)), (4, " ".join([two] * 60)), (5, " ".join([*words[:15], one, *words[15:30]])),
         (6, " ".join([*words[:15], two, *words[15:30]]))], "doc_id long, text string")
    classes = by_id(ngram_join.similarity_classes(docs), "component_id")
    assert classes == {i: [(i,)] for i in range(1, 7)}
    assert {r.doc_id for r in suffix_dedup.repeated_passages(docs).collect()} == {3, 4}  # in themselves
    clusters = by_id(packing.pieces(docs.selectExpr("*", "'s' AS source")), "cluster")
    assert len({c for c, in (v[0] for v in clusters.values())}) == 6
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path())
    ids = {r.doc_id: library.encode(r.text, add_special_tokens=False).ids for r in docs.collect()}
    encoded = by_id(bpe_documents.encode(docs.coalesce(1), tokenizer_path()), "ids")
    assert {i: v[0][0] for i, v in encoded.items()} == ids
    written = token_files.write_token_files(docs.coalesce(1), tokenizer_path())
    assert {r.doc_id: list(np.frombuffer(r.ids, "<u4")) for r in written.read().collect()} == {i: [*v, 0] for i, v in ids.items()}


def test_long_single_words(spark):
    word = "x" * 70_000
    docs = spark.createDataFrame([(1, word + "a"), (2, word + "b"), (3, word + "a"), (4, None)], "doc_id long, text string")
    assert by_id(ngram_join.similarity_classes(docs), "n_shingles", "component_id") == {1: [(1, 1)], 2: [(1, 2)], 3: [(1, 1)], 4: [(0, 4)]}
    trip = by_id(bpe_documents.round_trip(docs, tokenizer_path()), "decoded_sha256")
    assert {i: v[0][0] for i, v in trip.items()} == {r.doc_id: hashlib.sha256((r.text or "").encode()).hexdigest() for r in docs.collect()}


def test_boundary_by_cost():
    assert ngram_join.boundary({100: 10}, 1.0, 1.0) == 0
    assert ngram_join.boundary({10: 1000}, 0.0, 0.0) == 0  # 6 subsets against 3 postings
    assert ngram_join.boundary({10: 1000}, 20.0, 1.0) >= 13  # but far shorter lists; from 13 on, size 10 posts to no list
    assert ngram_join.subset_count(10) == 6 and ngram_join.prefix_length(10) == 3


# --- suffixes --------------------------------------------------------------


def repeated_windows(seqs, n=suffix_dedup.MIN_WORDS):
    first, need = {}, collections.defaultdict(set)
    for i, w in sorted(seqs):
        for k in range(len(w) - n + 1):
            g = tuple(w[k : k + n])
            if g in first:
                need[i] |= set(range(k, k + n))
            else:
                first[g] = i
    return need


def test_passages_cover_every_repeat(spark, words):
    rows = [(1, " ".join(words[:300])), (2, "start " + " ".join(words[100:160]) + " " + " ".join(words[400:500])),
            (3, " ".join(words[600:700]) + " " + " ".join(words[110:159])), (4, " ".join(words[700:760]) + " x " + " ".join(words[700:760])),
            (5, " ".join(words[1000:1049])), (6, " ".join(words[1000:1049])), (7, "A " + " ".join(words[250:300]).upper())]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    passages = suffix_dedup.repeated_passages(docs)
    got = collections.defaultdict(set)
    for r in passages.collect():
        got[r.doc_id] |= set(range(r.start, r.end))
        assert (r.ref_doc, r.ref_start) < (r.doc_id, r.start)
    assert {k: v for k, v in got.items()} == dict(repeated_windows(sequences(docs)))
    cut = {r.doc_id: WORD.findall(r.text) for r in suffix_dedup.cut_passages(docs, passages).collect()}
    for i, w in sequences(docs):
        assert [x.lower() for x in cut[i]] == [x for k, x in enumerate(w) if k not in got[i]]


def test_passages_odd_rows(odd_docs, no_docs):
    passages = suffix_dedup.repeated_passages(odd_docs)
    got = collections.defaultdict(set)
    for r in passages.collect():
        got[r.doc_id] |= set(range(r.start, r.end))
    once = {i: w for i, w in sequences(odd_docs) if i is not None}
    assert dict(got) == dict(repeated_windows(list(once.items())))
    cut = suffix_dedup.cut_passages(odd_docs, passages)
    assert cut.columns == odd_docs.columns and cut.count() == odd_docs.count()
    assert {r.doc_id: r.text for r in cut.collect()}[3] is None
    assert suffix_dedup.repeated_passages(no_docs).count() == 0


def test_passages_behind_truncated_occurrences(spark, words):
    rows, rng = [], np.random.default_rng(5)
    for k in range(120):  # an earlier document has 39 to 49 words of a passage that two later ones share
        at, size = 20 * k, 50 + k % 12
        passage = words[at : at + size]
        cut, from_left = int(rng.integers(39, 50)), k % 2
        part = passage[:cut] if from_left else passage[-cut:]
        rows += [(j * 1000 + k, " ".join([f"a{j}x{k}"] * 3 + p + [f"z{j}x{k}"] * 30)) for j, p in enumerate((part, passage, passage))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = collections.defaultdict(set)
    for r in suffix_dedup.repeated_passages(docs).collect():
        got[r.doc_id] |= set(range(r.start, r.end))
        assert (r.ref_doc, r.ref_start) < (r.doc_id, r.start)
    want = repeated_windows(sequences(docs))
    assert len(want) == 120 and got == want


def test_passages_of_random_overlaps(spark):
    rng = np.random.default_rng(6)
    rows = [(i, " ".join(str(w) for _ in range(6) for a in [rng.integers(0, 300)] for w in range(a, a + rng.integers(20, 75)))) for i in range(250)]
    rows += [(500 + i, "p q r " * (10 + i)) for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = collections.defaultdict(set)
    for r in suffix_dedup.repeated_passages(docs).collect():
        got[r.doc_id] |= set(range(r.start, r.end))
    assert got == repeated_windows(sequences(docs))


def test_runs_across_partitions(spark, words, tmp_path):
    text = " ".join(words[:80])
    docs = spark.createDataFrame([(i, f"w{i} {text}") for i in range(60)], "doc_id long, text string")
    scratch = Scratch(spark, "test")
    suffixes = scratch.cut(suffix_dedup.sparse_suffixes(docs), "s")
    found, runs = suffix_dedup.neighbours(suffixes, scratch, 16)
    assert found.where("edge = 1").count() > 0
    got = suffix_dedup.repeated_passages(docs).collect()
    assert sorted(r.doc_id for r in got) == list(range(1, 60)) and all((r.start, r.end, r.ref_doc) == (1, 81, 0) for r in got)


# --- packing ---------------------------------------------------------------


def check_bins(rows, sources, texts, capacity):
    bins = collections.defaultdict(list)
    for r in rows:
        bins[r.shard, r.bin].append(r)
    for own in bins.values():
        own.sort(key=lambda r: (r["at"], r.length))
        assert all(a["at"] + a.length <= b["at"] for a, b in zip(own, own[1:])) and own[-1]["at"] + own[-1].length <= capacity
        assert len(own) == 1 or all(
            sources[a.doc_id] is None or sources[a.doc_id] != sources[b.doc_id] for i, a in enumerate(own) for b in own[i + 1 :])
        filled = [r for r in own if r.length]
        assert len({texts[r.doc_id] for r in filled}) == len(filled)


def test_packing_odd_rows(odd_docs, no_docs):
    rows = packing.pack_documents(odd_docs, capacity=100, shard_documents=5).collect()
    first = {r.doc_id: r for r in odd_docs.collect()}
    total = sum(len(w) for _, w in sequences(odd_docs))
    assert sum(r.length for r in rows) == total and {r.doc_id for r in rows} == set(first)
    check_bins(rows, {i: r.source for i, r in first.items()}, {i: tuple(w) for i, w in sequences(odd_docs)}, 100)
    assert packing.pack_documents(no_docs).count() == 0


def test_best_fit_takes_the_tightest_compatible_bin():
    rng = np.random.default_rng(3)
    length = rng.integers(1, 60, 300)
    source, cluster = rng.integers(-1, 6, 300), rng.integers(-1, 40, 300)
    order = np.argsort(-length, kind="stable")
    number, at = packing.pack(length, source, cluster, order, 100)
    bins = []  # residual, sources, clusters
    for i in order:
        fits = [(b[0], k) for k, b in enumerate(bins) if b[0] >= length[i] and not (source[i] >= 0 and source[i] in b[1])
                and not (cluster[i] >= 0 and cluster[i] in b[2])]
        k = min(fits)[1] if fits else len(bins)
        if not fits:
            bins.append([100, set(), set()])
        assert number[i] == k and at[i] == 100 - bins[k][0]
        bins[k][0] -= length[i]
        bins[k][1].add(source[i])
        bins[k][2].add(cluster[i])


# --- tokens ----------------------------------------------------------------


def test_token_files(spark, odd_docs, no_docs):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path())
    written = token_files.write_token_files(odd_docs, tokenizer_path(), shards=3)
    got = [(r.doc_id, r.start, list(np.frombuffer(r.ids, "<u4"))) for r in written.read().collect()]
    got.sort(key=lambda r: r[1])
    assert [r[0] for r in got] == sorted((r.doc_id for r in odd_docs.collect()), key=lambda i: (i is not None, i))
    want = collections.defaultdict(list)
    for r in odd_docs.collect():
        want[r.doc_id].append([*library.encode(r.text or "", add_special_tokens=False).ids, 0])
    start = 0
    for i, s, ids in got:
        assert s == start and ids in want[i]
        start += len(ids)
    digests = {(r.doc_id, r.start): (r.n_tokens, r.ids_crc32) for r in written.digest().collect()}
    assert digests == {(i, s): (len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for i, s, x in got}
    assert token_files.write_token_files(no_docs, tokenizer_path()).digest().count() == 0


def test_value_coding():
    rng = np.random.default_rng(1)
    for n in (0, 1, 3, 4, 5, 1000):
        v = (rng.integers(0, 2**32, n, dtype=np.uint64) >> rng.integers(0, 32, n).astype(np.uint64)).astype(np.uint32)
        control, data = token_files.encode_values(v)
        assert len(control) == -(-n // 4) and (token_files.decode_values(control, data, n) == v).all()


def test_bpe_documents(odd_docs, no_docs):
    encoded = bpe_documents.encode(odd_docs, tokenizer_path())
    decoded = by_id(bpe_documents.decode(encoded, tokenizer_path()), "text")
    for r in odd_docs.collect():
        assert (r.text or "",) in decoded[r.doc_id]
    trip = by_id(bpe_documents.round_trip(odd_docs, tokenizer_path()), "n_tokens", "ids_sha256", "decoded_sha256")
    for r in encoded.collect():
        ids = np.array(r.ids, dtype="<u4")
        assert (len(ids), hashlib.sha256(ids.tobytes()).hexdigest()) in [x[:2] for x in trip[r.doc_id]]
    assert bpe_documents.round_trip(no_docs, tokenizer_path()).count() == 0


# --- components ------------------------------------------------------------


def test_components(spark):
    rng = np.random.default_rng(2)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 400, (260, 2))] + [(i, i + 1) for i in range(1000, 1200)] + [(5000, i) for i in range(5001, 5100)]
    edges += [(None, 1), (7, None), (9, 9)]
    label = {x: x for e in edges for x in e if x is not None}
    for _ in range(300):
        for a, b in edges:
            if a is not None and b is not None:
                label[a] = label[b] = min(label[a], label[b])
    df = spark.createDataFrame(edges, "src long, dst long")
    got = {r.node: r.component for r in components.connected_components(df, Scratch(spark, "cc")).collect()}
    linked = {x for a, b in edges if None not in (a, b) and a != b for x in (a, b)}
    assert {x: got.get(x, x) for x in linked} == {x: label[x] for x in linked}
    assert components.connected_components(df.limit(0), Scratch(spark, "cc")).count() == 0
