"""Target-distribution importance resampling on hashed n-grams of words.

Identical texts are collapsed by grouping the full text: features are computed
and weighted once for each distinct text, corpus counts take every copy by the
group's multiplicity, and weights are joined back by the text's SHA-256 before
each document draws its own noise.  Only the table of bucket gains, whose size
is a constant, reaches the driver.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cairn.llm import runtime
from cairn.llm.scratch import Scratch
from cairn.llm.wordhash import byte_blocks

#: Buckets of features, longest run of words, words that a document needs to be drawn, share drawn in hundredths, seed of the noise.
BUCKETS = 10_000
LONGEST = 3
LEAST_WORDS = 20
PERCENT = 5
SEED = 42

#: Lower case of the 256 bytes (A-Z only), and those that make words: digits, a-z and all bytes of other characters.
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_INSIDE = np.zeros(256, dtype=bool)
_INSIDE[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

#: Words longer than this get their checksum one by one.
_SHORT = 64
_ONE = np.array([zlib.crc32(bytes([i])) for i in range(256)], dtype=np.uint32)
_STEP = _ONE ^ _ONE[0]  # the checksum's byte table: linear part of one byte's checksum
_SPACE_CRC = np.uint32(zlib.crc32(b" "))


def _shift_tables(powers: int) -> list[np.ndarray]:
    """For each k, what 2**k zero bytes make of the four bytes of a checksum (the operation is linear)."""
    tables = []
    base = np.zeros((4, 256), dtype=np.uint32)
    for j in range(4):
        x = np.arange(256, dtype=np.uint32) << np.uint32(8 * j)
        base[j] = _STEP[x & np.uint32(255)] ^ (x >> np.uint32(8))
    tables.append(base)
    for _ in range(powers - 1):
        tables.append(_apply(tables[-1], tables[-1]))
    return tables


def _apply(table: np.ndarray, x: np.ndarray) -> np.ndarray:
    return (table[0][x & np.uint32(255)] ^ table[1][(x >> np.uint32(8)) & np.uint32(255)]
            ^ table[2][(x >> np.uint32(16)) & np.uint32(255)] ^ table[3][x >> np.uint32(24)])


_POWERS = _shift_tables(40)


def _shift(x: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Checksums ``x`` moved on over ``n`` bytes each: the left part of a joined text's checksum."""
    out, bit = x.copy(), 0
    while True:
        left = n >> bit
        if not left.any():
            return out
        odd = np.flatnonzero(left & 1)
        out[odd] = _apply(_POWERS[bit], out[odd])
        bit += 1


def _word_checksums(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """CRC-32 of each word, byte place by byte place over all words that are long enough."""
    crc = np.full(len(starts), 0xFFFFFFFF, dtype=np.uint32)
    order = np.argsort(-np.minimum(sizes, _SHORT + 1), kind="stable")
    begins, run = starts[order], sizes[order]
    state, negative = crc.copy(), -run
    for p in range(min(_SHORT, int(run[0])) if len(run) else 0):
        k = int(np.searchsorted(negative, -p, side="left"))
        c = state[:k]
        state[:k] = _STEP[(c ^ data[begins[:k] + p]) & np.uint32(255)] ^ (c >> np.uint32(8))
    crc[order] = state ^ np.uint32(0xFFFFFFFF)
    for i in np.flatnonzero(sizes > _SHORT):
        crc[i] = zlib.crc32(data[starts[i] : starts[i] + sizes[i]].tobytes())
    return crc


def feature_buckets(data: np.ndarray, offsets: np.ndarray, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all features of consecutive texts, the text of each feature, and the words of each text.

    data, offsets: UTF-8 bytes of the texts and where each begins (and the end).
    A feature is a run of 1 to ``LONGEST`` consecutive words of one text, joined by one space;
    its bucket is its CRC-32 modulo ``buckets``.
    """
    data = _LOWER[data]
    n_texts = len(offsets) - 1
    inside = _INSIDE[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | edge[1:-1]
    starts = np.flatnonzero(begins)
    sizes = np.flatnonzero(ends) + 1 - starts
    text_of = np.searchsorted(offsets, starts, side="right") - 1
    single = _word_checksums(data, starts, sizes)
    found, owners, run = [single], [text_of], single
    for n in range(2, LONGEST + 1):
        if len(starts) < n:
            break
        spaced = _apply(_POWERS[0], run[: len(starts) - n + 1]) ^ _SPACE_CRC
        run = _shift(spaced, sizes[n - 1 :]) ^ single[n - 1 :]
        whole = text_of[: len(starts) - n + 1] == text_of[n - 1 :]
        found.append(run[whole])
        owners.append(text_of[n - 1 :][whole])
    return (np.concatenate(found) % np.uint32(buckets)).astype(np.int64), np.concatenate(owners), np.bincount(text_of, minlength=n_texts)


_FEATURES = "digest binary, copies long, n_words long, n_features long, steps binary"
_FEATURES_ARROW = pa.schema([("digest", pa.binary()), ("copies", pa.int64()), ("n_words", pa.int64()), ("n_features", pa.int64()), ("steps", pa.binary())])
_COUNTS_ARROW = pa.schema([("bucket", pa.int32()), ("n", pa.int64())])
_WEIGHTS_ARROW = pa.schema([("digest", pa.binary()), ("n_words", pa.int64()), ("n_features", pa.int64()), ("weight", pa.int64())])


def text_features(docs: DataFrame, scratch: Scratch, text_col: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """One row per distinct text: SHA-256, copies, words, features, and the sorted buckets as 16-bit steps.

    Written once, so that counts and weights read features that were computed once.  Null
    texts count as empty; an empty table gives none.
    """
    if not 0 < buckets <= 1 << 16:
        raise ValueError("buckets must fit 16 bits")
    runtime.prepare(docs.sparkSession)
    distinct = (
        docs.groupBy(F.coalesce(F.col(text_col), F.lit("")).alias("text")).agg(F.count(F.lit(1)).alias("copies"))
        .select(F.unhex(F.sha2("text", 256)).alias("digest"), "copies", "text")
    )

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first, data, offsets in byte_blocks(b.column(2)):
                found, owner, words = feature_buckets(data, offsets, buckets)
                n = len(words)
                placed = np.sort(owner * (1 << 16) + found)
                found = (placed & 0xFFFF).astype(np.int64)
                per_text = np.bincount(placed >> 16, minlength=n)
                at = np.zeros(n + 1, dtype=np.int64)
                np.cumsum(per_text, out=at[1:])
                steps = np.diff(found, prepend=0)
                full = at[:-1][per_text > 0]
                steps[full] = found[full]
                raw = pa.Array.from_buffers(pa.large_binary(), n, [None, pa.py_buffer((at * 2).tobytes()), pa.py_buffer(steps.astype("<u2").tobytes())])
                yield runtime.batch(_FEATURES_ARROW, digest=b.column(0).slice(first, n), copies=b.column(1).slice(first, n),
                                    n_words=words, n_features=per_text, steps=raw.cast(pa.binary()))

    return scratch.cut(distinct.mapInArrow(compute, _FEATURES), "features")


def _unpacked(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all features of a batch of ``text_features`` and the features of each text."""
    sizes = runtime.numbers(b.column("n_features"))
    raw = b.column("steps").cast(pa.large_binary())
    _, offsets, data = raw.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[raw.offset : raw.offset + len(raw) + 1]
    steps = np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]].view("<u2").astype(np.int64) if at[-1] > at[0] else np.zeros(0, np.int64)
    total = np.zeros(len(steps) + 1, dtype=np.int64)
    np.cumsum(steps, out=total[1:])
    first = np.cumsum(sizes) - sizes
    return total[1:] - np.repeat(total[first], sizes), sizes


def bucket_counts(features: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``bucket``, ``n``: features of all documents in each bucket that has any; each task adds up its own first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for b in batches:
            found, sizes = _unpacked(b)
            copies = np.repeat(runtime.numbers(b.column("copies")), sizes)
            once = copies == 1
            total += np.bincount(found[once], minlength=buckets)
            np.add.at(total, found[~once], copies[~once])
        full = np.flatnonzero(total)
        yield runtime.batch(_COUNTS_ARROW, bucket=full.astype(np.int32), n=total[full])

    return features.select("copies", "n_features", "steps").mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Thousandths of the log ratio of both smoothed distributions, rounded down, for every bucket.

    corpus, target: results of ``bucket_counts``.  ``buckets`` numbers reach the driver, however large the tables are.
    """
    spark = corpus.sparkSession
    s, t = F.coalesce("s", F.lit(0)), F.coalesce("t", F.lit(0))
    both = (
        spark.range(buckets).select(F.col("id").cast("int").alias("bucket"))
        .join(corpus.select("bucket", F.col("n").alias("s")), "bucket", "left").join(target.select("bucket", F.col("n").alias("t")), "bucket", "left")
    )
    sums = both.agg(F.sum(s).cast("double").alias("s"), F.sum(t).cast("double").alias("t")).first()
    ratio = (t + 1).cast("double") * F.lit(sums["s"] + buckets) / ((s + 1).cast("double") * F.lit(sums["t"] + buckets))
    rows = both.select("bucket", F.floor(1000 * F.log(ratio)).alias("gain")).collect()
    gains = np.zeros(buckets, dtype=np.int64)
    gains[[r["bucket"] for r in rows]] = [r["gain"] for r in rows]
    return gains


def text_weights(features: DataFrame, gains: np.ndarray) -> DataFrame:
    """``digest``, ``n_words``, ``n_features``, ``weight``: the sum of gains over each distinct text's features."""

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found, sizes = _unpacked(b)
            total = np.zeros(len(found) + 1, dtype=np.int64)
            np.cumsum(gains[found], out=total[1:])
            ends = np.cumsum(sizes)
            yield runtime.batch(_WEIGHTS_ARROW, digest=b.column("digest"), n_words=b.column("n_words"),
                                n_features=sizes, weight=total[ends] - total[ends - sizes])

    return features.select("digest", "n_words", "n_features", "steps").mapInArrow(weigh, "digest binary, n_words long, n_features long, weight long")


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text",
             percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED) -> DataFrame:
    """One row per document: ``doc_id``, ``n_features``, ``weight``, ``score``, ``rank``.

    A document's score is its weight plus Gumbel noise that depends on ``seed`` and its id alone.
    Of the documents of at least ``least_words`` words, ``percent`` hundredths of their number,
    rounded down, are drawn by highest score, ties to the smaller id; ``rank`` counts them from 1
    and is null for all others.

    Null texts count as empty.  A null id draws the noise of the empty id and comes last among
    ties; repeated rows are documents of their own, in any order among themselves.  Empty tables:
    no documents give no rows, an empty target gives weights against even counts.  Further
    columns, whatever their names, are not read.
    """
    scratch = Scratch(docs.sparkSession, "importance")
    features = text_features(docs, scratch, text_col)
    wanted = text_features(target, scratch, target_col)
    weights = text_weights(features, bucket_gains(bucket_counts(features), bucket_counts(wanted)))
    key = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), key), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))
    each = docs.select(F.col(id_col).alias("doc_id"), noise.alias("noise"), F.unhex(F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256)).alias("digest"))
    scored = each.join(weights, "digest").select(
        "doc_id", "n_features", "weight", (F.col("weight") + F.col("noise")).alias("score"), (F.col("n_words") >= least_words).alias("fit"))
    ranked = rank_top(scratch.cut(scored, "scores"), percent, scratch)
    return ranked.select("doc_id", "n_features", "weight", "score", "rank")


def rank_top(scored: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """``scored`` (a written table) with ``rank`` of the highest scores of rows that are ``fit``.

    Rows are dealt by ranges of their order, so neither one score nor one id is kept together; a
    row's rank is its place in its range plus the sizes of the ranges before, of which there is one
    row each.
    """
    order = [F.col("fit").desc(), F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("turn")]
    placed = scratch.cut(
        scored.withColumn("turn", F.monotonically_increasing_id())
        .repartitionByRange(runtime.partitions_for(scored.sparkSession), *order).sortWithinPartitions(*order)
        .withColumn("place", F.monotonically_increasing_id()).drop("turn"), "placed")
    part = F.shiftright("place", 33)
    sizes = placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("fit").cast("long")).alias("fit_here"))
    before = sizes.select(
        "part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"),
        F.expr(f"{int(percent)} * sum(fit_here) over () div 100").alias("drawn"))
    rank = F.col("before") + F.col("place").bitwiseAND((1 << 33) - 1) + 1
    return placed.withColumn("part", part).join(F.broadcast(before), "part").withColumn(
        "rank", F.when(F.col("fit") & (rank <= F.col("drawn")), rank)).drop("part", "before", "drawn", "place")
