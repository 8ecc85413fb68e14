"""Importance resampling, the prefix trie and decontamination against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from cairn.llm import decontamination, importance, prefix_trie

ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BLANK = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def alnum_words(text):
    return ALNUM.findall((text or "").translate(LOWER))


# --- importance resampling ---------------------------------------------------


def features(text):
    w = alnum_words(text)
    return [zlib.crc32(" ".join(w[i : i + n]).encode()) % 10000 for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def resampled(docs, target):
    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(features(text))
    for text in target:
        t.update(features(text))
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (big_s + 10000) / ((s[b] + 1) * (big_t + 10000)))) for b in range(10000)]
    rows, fit = [], []
    for i, (doc, text) in enumerate(docs):
        f = features(text)
        h = int(hashlib.sha256(f"42:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f)
        rows.append([doc, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
        if len(alnum_words(text)) >= 20:
            fit.append(i)
    fit.sort(key=lambda i: (-rows[i][3], rows[i][0] is None, rows[i][0] or 0))
    for k, i in enumerate(fit[: 5 * len(fit) // 100], 1):
        rows[i][4] = k
    return Counter(map(tuple, rows))


@pytest.mark.parametrize("block", [1, 64, 1 << 20])
def test_feature_buckets(words, block):
    import pyarrow as pa

    from cairn.llm.wordhash import byte_blocks

    texts = ["", "One two\x00three", "É!é ñ", "a" * 300 + " b " + "ç" * 90, " ".join(words[:50]), "9:8[7`6{5", "same same same"]
    for first, data, offsets in byte_blocks(pa.array(texts), block):
        found, owner, n = importance.feature_buckets(data, offsets)
        for i in range(len(offsets) - 1):
            assert sorted(found[owner == i]) == sorted(features(texts[first + i])), texts[first + i]
            assert n[i] == len(alnum_words(texts[first + i]))


def test_resampling_odd_rows(spark, odd_docs, words):
    """Nulls, empty and long texts, repeated rows, clashing columns; copies and ties so that drawing matters."""
    rng = random.Random(2)
    more = [(100 + i, " ".join(rng.choices(words[:200], k=rng.randrange(15, 60)))) for i in range(160)]
    more += [(300 + i, more[0][1]) for i in range(40)] + [(None, more[1][1])] * 3
    docs = odd_docs.select("doc_id", "text", F.lit(1).alias("rank"), F.lit(2).alias("digest"), F.lit(3).alias("copies"), F.lit(4).alias("fit")).unionByName(
        spark.createDataFrame(more, "doc_id long, text string"), allowMissingColumns=True)
    target = [" ".join(words[:30]), None, "", " ".join(words[:30])]
    got = importance.resample(docs, spark.createDataFrame([(t,) for t in target], "text string"))
    want = resampled([(r.doc_id, r.text) for r in docs.collect()], target)
    assert Counter(map(tuple, got.collect())) == want
    assert sum(k[4] is not None for k in want.elements()) >= 5


def test_resampling_empty_tables(spark, no_docs):
    assert importance.resample(no_docs, no_docs).collect() == []
    docs = [(i, f"one two three {i} " * 6) for i in range(40)]
    got = importance.resample(spark.createDataFrame(docs, "doc_id long, text string"), no_docs)
    assert Counter(map(tuple, got.collect())) == resampled(docs, [])


# --- prefix trie ---------------------------------------------------------------


def rebuilt(rows, family):
    own = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            r, x = r or "", x or ""
            own[c].append((t is not None, t or 0, hashlib.sha256(f"{len(r.encode())}:{r}{x}".encode()).digest(), r, x))
    own = {c: [k[3:] for k in sorted(v)] for c, v in own.items()}
    if not family:
        return own
    out = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = own.get(c - int(math.fmod(c, 20)), [])[:h] + own[c][h:]
    return out


def trie(turns):
    nodes, kids, leaves, saved = defaultdict(list), defaultdict(list), {}, {}
    for c, s in turns.items():
        for d in range(len(s) + 1):
            nodes[tuple(s[:d])].append(c)
    for k in nodes:
        if k:
            kids[k[:-1]].append(k)
    for k in sorted(nodes, key=len, reverse=True):
        leaves[k] = sum(leaves[x] for x in kids[k]) or 1
        saved[k] = (len(nodes[k]) - 1) * (len(BLANK.findall(k[-1][1])) if k else 0) + sum(saved[x] for x in kids[k])
    sha = lambda k, m: hashlib.sha256(",".join(str(c) for c in sorted(m) if len(turns[c]) == len(k)).encode()).hexdigest()
    return Counter((min(m), len(k), min(nodes[k[:-1]]) if k else None, len(m), len(kids[k]), leaves[k], saved[k], sha(k, m)) for k, m in nodes.items())


TURNS = "conv_id long, turn long, role string, text string"


def conversations(words):
    rng = random.Random(8)
    rows = []
    for c in range(-25, 120):
        if rng.random() < 0.2:
            continue
        for t in range(rng.randrange(1, 6)):
            rows.append((c, t, rng.choice(["user", "assistant"]) if rng.random() < 0.1 else "user", f"turn {t} {rng.choice(words[:2])}"))
    rows += [(500, None, "user", "no turn"), (500, None, None, None), (500, 1, "a", "b"), (500, 1, "a", "b"), (500, 1, "ab", "")]
    rows += [(c, t, "user", f"long {t}") for c in (600, 620, 640) for t in range(12)]  # a shared prefix deeper than most conversations
    rows += [(700, t, None, words[t]) for t in range(60)] + [(None, 0, "user", "nobody"), (None, None, None, None)]
    rows += [(1000 + c, 0, "user", "hello there") for c in range(300)]  # a hot first turn
    return rows


@pytest.mark.parametrize("family", [False, True])
def test_trie_equals_brute_force(spark, words, family, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PIECE_IDS", 7)
    rows = conversations(words)
    df = spark.createDataFrame(rows, TURNS).repartition(5).select("*", F.lit(1).alias("pos"), F.lit(2).alias("node"), F.lit(3).alias("depth"), F.lit("k").alias("turn_key"))
    got = (prefix_trie.family_trie if family else prefix_trie.conversation_trie)(df)
    assert Counter(map(tuple, got.collect())) == trie(rebuilt(rows, family))


@pytest.mark.parametrize("rows", [[], [(None, 1, "u", "x")], [(3, 0, "u", "one two")], [(3, 0, "u", "x"), (23, 0, "u", "x")], [(4, 0, None, None)]])
def test_trie_small_tables(spark, rows):
    want = trie(rebuilt(rows, True))
    got = prefix_trie.family_trie(spark.createDataFrame(rows, TURNS))
    assert Counter(map(tuple, got.collect())) == (want if any(r[0] is not None for r in rows) else Counter())


def test_trie_conversation_without_turns_of_its_own(spark):
    """The head is longer than the conversation and its family has no first one: a member without turns ends at the root."""
    c = next(c for c in range(21, 40) if zlib.crc32(str(c).encode()) % 4 >= 2)
    rows = [(c, 0, "u", "x"), (60, 0, "u", "y")]
    got = Counter(map(tuple, prefix_trie.family_trie(spark.createDataFrame(rows, TURNS)).collect()))
    assert got == trie(rebuilt(rows, True))
    assert any(r[1] == 0 and r[7] == hashlib.sha256(str(c).encode()).hexdigest() for r in got)


# --- decontamination -------------------------------------------------------------


def contaminated(docs, items):
    windows = defaultdict(set)
    for item, text in items:
        w = alnum_words(text)
        for k in range(max(len(w) - 10, 0) + 1 if w else 0):
            windows[tuple(w[k : k + 10])].add("" if item is None else str(item))
    rows = []
    for doc, text in docs:
        w, hit, found = alnum_words(text), set(), set()
        for n in {len(k) for k in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in windows:
                    hit |= set(range(k, k + n))
                    found |= windows[tuple(w[k : k + n])]
        rows.append((doc, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return Counter(rows)


@pytest.fixture(scope="module")
def leaked(words):
    rng = random.Random(4)
    items = [(i, " ".join(rng.choices(words[:60], k=rng.randrange(1, 40)))) for i in range(30)]
    items += [(30, "the the the the the the the the the the the the"), (31, "The"), (None, " ".join(words[100:115])), (None, " ".join(words[300:312])), (32, None), (33, "-- ..."),
              (34, items[0][1]), (35, "never seen words here at all anywhere in this small corpus now")]
    docs = []
    for i in range(80):
        w = rng.choices(words[:60], k=rng.randrange(0, 80))
        for _ in range(rng.randrange(0, 3)):
            part = alnum_words(rng.choice(items)[1])
            a = rng.randrange(0, max(1, len(part) - 10))
            w[rng.randrange(0, len(w) + 1) : 0] = part[a : a + rng.randrange(9, 30)]
        docs.append((i, "! ".join(x.upper() if rng.random() < 0.2 else x for x in w)))
    docs += [(200, "the " * 500), (201, None), (202, ""), (203, " ".join(words[95:120])), (204, "the"), (204, "the"), (None, items[0][1]), (None, items[1][1])]
    return docs, items


def test_contamination_equals_brute_force(spark, leaked):
    docs, items = leaked
    extra = [F.lit(1).alias("doc"), F.lit(2).alias("term"), F.lit("x").alias("phrase"), F.lit(3).alias("n"), F.lit(4).alias("pos"), F.lit(5).alias("item")]
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3).select("*", *extra)
    got = decontamination.contamination(d, spark.createDataFrame(items, "item_id int, text string").select("*", *extra))
    want = contaminated(docs, items)
    assert Counter(map(tuple, got.collect())) == want
    assert sum(r[5] for r in want) > 20


def test_contamination_without_broadcast(spark, leaked, monkeypatch):
    monkeypatch.setattr(decontamination, "BROADCAST_ROWS", 0)
    docs, items = leaked
    got = decontamination.contamination(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id int, text string"))
    assert Counter(map(tuple, got.collect())) == contaminated(docs, items)


def test_contamination_empty_tables(spark, no_docs, odd_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.contamination(no_docs, none).collect() == []
    got = decontamination.contamination(odd_docs, none)
    assert Counter(map(tuple, got.collect())) == contaminated([(r.doc_id, r.text) for r in odd_docs.collect()], [])


@pytest.mark.parametrize("slop", [0, 2, 5])
def test_proximity_equals_brute_force(spark, leaked, slop):
    docs, items = leaked
    index = decontamination.build_index(spark.createDataFrame([d for d in docs if d[0] is not None and d[0] < 204], "doc_id long, text string"))
    phrases, _ = decontamination.windows_of(spark.createDataFrame(items[:12] + [(50, "the")], "item_id int, text string"), index.scratch, size=4)
    rare = {r.phrase: r.term for r in decontamination.rarest_terms(index, phrases).where("turn = 1").collect()}
    got = {tuple(r) for r in decontamination.proximity_matches(index, phrases, slop).collect()}
    hashes = {r.w: r.h for r in spark.createDataFrame([(w,) for w in {x for _, t in docs + items for x in alnum_words(t)}], "w string").select("w", F.xxhash64("w").alias("h")).collect()}
    want = set()
    for doc, text in docs:
        if doc is None or doc >= 204:
            continue
        w = alnum_words(text)
        for phrase, term in rare.items():
            p = phrase.split(" ")
            span = len(p) + slop
            for pos in range(len(w)):
                if hashes[w[pos]] == term and any(set(p) <= set(w[s : s + span]) for s in range(max(0, pos - span + 1), pos + 1)):
                    want.add((doc, phrase, pos))
    assert got == want and want
