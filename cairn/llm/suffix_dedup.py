"""Repeated passages by sparse suffix arrays.

Of all suffixes (at word positions) only those at content-selected positions
are retained: the smallest ``GRAM``-word hash of every ``WINDOW`` successive
ones.  A passage that repeats selects the same positions wherever it stands, so
a repeat of ``MIN_WORDS`` words holds a retained suffix within its first
``WINDOW`` words, with ``HEAD_WORDS`` more words of the passage to come.  A
suffix's context is all words that passages of ``MIN_WORDS`` words around its
head can hold.  Sorted by head and context, repeats are neighbours: a suffix
whose context occurred before repeats as a whole; where a head has several
contexts, the first suffix of each is looked up by every ``MIN_WORDS``-word
window of its context.  Matches in line are joined.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.llm import runtime, wordhash
from cairn.llm.scratch import Scratch

MIN_WORDS = 50
GRAM = 8
WINDOW = 12
HEAD_WORDS = MIN_WORDS - WINDOW + 1

_SUFFIX = pa.schema([("head", pa.int64()), ("key", pa.int64()), ("doc_id", pa.int64()), ("pos", pa.int32()), ("size", pa.int32())])
_SUFFIX_DDL = "head long, key long, doc_id long, pos int, size int"
_MATCH = "key long, doc_id long, pos int, size int, ref_doc long, ref_pos int, edge int"
_MATCH_ARROW = pa.schema([("key", pa.int64()), ("doc_id", pa.int64()), ("pos", pa.int32()), ("size", pa.int32()),
                          ("ref_doc", pa.int64()), ("ref_pos", pa.int32()), ("edge", pa.int32())])
_PASSAGE = "doc_id long, start int, end int, ref_doc long, ref_start int"
_PASSAGE_ARROW = pa.schema([("doc_id", pa.int64()), ("start", pa.int32()), ("end", pa.int32()), ("ref_doc", pa.int64()), ("ref_start", pa.int32())])


def retained_positions(words: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Retained positions of a flat word array whose documents begin at ``first`` (documents + 1)."""
    if len(words) < GRAM + WINDOW - 1:
        return np.zeros(0, dtype=np.int64)
    grams = wordhash.ngram_hashes(words, GRAM)
    windows = np.lib.stride_tricks.sliding_window_view(grams, WINDOW)
    at = np.arange(len(windows)) + windows.argmin(axis=1)
    doc = np.searchsorted(first, np.arange(len(windows)), side="right")
    last = np.searchsorted(first, np.arange(len(windows)) + WINDOW + GRAM - 2, side="right")
    at = np.unique(at[doc == last])
    end = first[np.searchsorted(first, at, side="right")]
    return at[at + HEAD_WORDS <= end]


def sparse_suffixes(docs: DataFrame) -> DataFrame:
    """``head, key, doc_id, pos, size`` of the retained suffixes of all texts (columns doc_id, text).

    ``pos`` and ``size`` are the place and the words of the suffix's context and
    ``key`` its hash; texts of fewer than ``MIN_WORDS`` words have none.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column("doc_id").to_numpy(zero_copy_only=False)
            for block in wordhash.blocks(b.column("text")):
                words = block.hashes()
                at = retained_positions(words, block.words)
                doc = np.searchsorted(block.words, at, side="right") - 1
                long = block.words[doc + 1] - block.words[doc] >= MIN_WORDS
                at, doc = at[long], doc[long]
                if not len(at):
                    continue
                start = np.maximum(at - (WINDOW - 1), block.words[doc])
                end = np.minimum(at + MIN_WORDS, block.words[doc + 1])
                # two windows that cover the context, and where the head stands in it
                key = wordhash.mix(wordhash.ngram_hashes_at(words, start, MIN_WORDS) + np.uint64(3) * wordhash.ngram_hashes_at(
                    words, end - MIN_WORDS, MIN_WORDS) + (64 * (end - start) + at - start).astype(np.uint64))
                yield runtime.batch(_SUFFIX, head=wordhash.as_long(wordhash.ngram_hashes_at(words, at, HEAD_WORDS)),
                                    key=wordhash.as_long(key), doc_id=ids[block.first + doc],
                                    pos=(start - block.words[doc]).astype(np.int32), size=(end - start).astype(np.int32))

    return docs.where("doc_id IS NOT NULL").mapInArrow(run, _SUFFIX_DDL)


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All ``MIN_WORDS``-word windows of the asked contexts of each text, each once; their head is another hash of the same words."""
    for b in batches:
        ids, asked = b.column("doc_id").to_pylist(), b.column("asked").to_pylist()
        for block in wordhash.blocks(b.column("text")):
            words = block.hashes()
            starts, docs = [], []
            for d in range(block.n_docs):
                own = [np.arange(r["pos"], r["pos"] + r["size"] - MIN_WORDS + 1) for r in asked[block.first + d]]
                own = np.unique(np.concatenate(own)) + block.words[d]
                starts.append(own[own + MIN_WORDS <= block.words[d + 1]])
                docs.append(np.full(len(starts[-1]), d))
            at, doc = np.concatenate(starts), np.concatenate(docs)
            head, key = (wordhash.as_long(wordhash.ngram_hashes_at(words, at, MIN_WORDS, other)) for other in (False, True))
            yield runtime.batch(_SUFFIX, head=head, key=key, doc_id=np.array(ids, dtype=np.int64)[block.first + doc],
                                pos=(at - block.words[doc]).astype(np.int32), size=np.full(len(at), MIN_WORDS, dtype=np.int32))


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Suffixes whose predecessor in sorted order has the same head and key (128 bits), with the first of their run.

    The run at which a partition begins may have begun earlier: its rows (edge
    1) are settled once the first suffix of each last run (edge 2) is known.
    The first suffix of each key is given as well (edge 3) where its head has
    other keys, or may have them in another partition.
    """
    opening, head, key, doc, pos = None, None, None, 0, 0  # the first run's key; the current run's head, key and first suffix
    first_run = True
    first_head, held = None, None  # the first run's head; the latest run's first row, and if its head had a key before
    for b in batches:
        if not b.num_rows:
            continue
        h, x, d, p, size = (b.column(c).to_numpy() for c in ("head", "key", "doc_id", "pos", "size"))
        new = np.ones(len(x), dtype=bool)
        new[1:] = (x[1:] != x[:-1]) | (h[1:] != h[:-1])
        new[0] = key is None or x[0] != key or h[0] != head
        start = np.maximum.accumulate(np.where(new, np.arange(len(x)), -1))
        first_d, first_p = np.where(start >= 0, d[start], doc), np.where(start >= 0, p[start], pos)
        edge = np.zeros(len(x), dtype=np.int32)
        first_head = h[0] if first_head is None else first_head
        if first_run:
            opening = x[0] if opening is None else opening
            other = np.flatnonzero((x != opening) | (h != first_head))
            edge[: other[0] if len(other) else len(x)] = 1
            first_run = not len(other)
        k = np.flatnonzero(~new | (edge > 0))
        yield runtime.batch(_MATCH_ARROW, key=x[k], doc_id=d[k], pos=p[k], size=size[k], ref_doc=first_d[k],
                            ref_pos=first_p[k].astype(np.int32), edge=edge[k])
        r = np.flatnonzero(new)
        if len(r):
            rows = np.stack([c[r].astype(np.int64) for c in (h, x, d, p, size)])
            later = False
            if held is not None:
                rows, later = np.concatenate([held[0][:, None], rows], axis=1), held[1]
            same = rows[0, 1:] == rows[0, :-1]
            before = np.append(later, same)
            yield _firsts(rows[:, :-1][:, same | before[:-1] | (rows[0, :-1] == first_head)])
            held = rows[:, -1], before[-1]
        head, key, doc, pos = h[-1], x[-1], first_d[-1], first_p[-1]
    if held is not None:
        yield _firsts(held[0][:, None])
    if key is not None and not first_run:
        yield runtime.batch(_MATCH_ARROW, key=[key], doc_id=[doc], pos=[pos], size=[0], ref_doc=[doc], ref_pos=[pos], edge=[2])


def _firsts(rows: np.ndarray) -> pa.RecordBatch:
    _, x, d, p, size = rows
    p = p.astype(np.int32)
    return runtime.batch(_MATCH_ARROW, key=x, doc_id=d, pos=p, size=size.astype(np.int32), ref_doc=d, ref_pos=p,
                         edge=np.full(len(x), 3, dtype=np.int32))


def neighbours(suffixes: DataFrame, scratch: Scratch, partitions: int) -> tuple[DataFrame, Runs]:
    """Suffixes with an equal key before them in sorted order (edge 0 and 1), first suffixes of keys whose head
    has others (edge 3), and the first suffixes of runs that cross partitions."""
    order = ["head", "key", "doc_id", "pos"]
    ordered = suffixes.repartitionByRange(partitions, *order).sortWithinPartitions(*order)
    found = scratch.cut(ordered.mapInArrow(_neighbours, _MATCH), "neighbours")
    # runs that touch a partition's end: two rows for each partition at most
    ends = found.where("edge IN (1, 2)").groupBy("key").agg(F.min(F.struct("doc_id", "pos")).alias("first")).collect()
    ends.sort(key=lambda r: r.key)
    return found.where("edge <> 2"), Runs(*(np.array(c, dtype=np.int64) for c in (
        [r.key for r in ends], [r.first.doc_id for r in ends], [r.first.pos for r in ends])))


@dataclass
class Runs:
    """First suffixes (document and place) of runs, by sorted key."""

    key: np.ndarray
    doc: np.ndarray
    pos: np.ndarray

    def __add__(self, other: Runs) -> Runs:
        key, doc, pos = (np.concatenate(c) for c in ((self.key, other.key), (self.doc, other.doc), (self.pos, other.pos)))
        order = np.argsort(key, kind="stable")
        return Runs(key[order], doc[order], pos[order])


def _passages(runs: Runs):
    """Joins matches that overlap or touch: those of one alignment first, then all of a document; rows sorted by document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, _ in runtime.sorted_runs(batches, ["doc_id"]):
            x, d, p, size, rd, rp, edge = (
                t.column(c).to_numpy().astype(np.int64) for c in ("key", "doc_id", "pos", "size", "ref_doc", "ref_pos", "edge"))
            crossing = np.flatnonzero(edge)
            if len(crossing):
                at = np.searchsorted(runs.key, x[crossing])
                rd[crossing], rp[crossing] = runs.doc[at], runs.pos[at]
            other = np.flatnonzero((d != rd) | (p != rp))
            if not len(other):
                continue
            order = other[np.lexsort((p[other], (p - rp)[other], rd[other], d[other]))]
            d, p, e, rd, rp = d[order], p[order], (p + size)[order], rd[order], rp[order]
            a, e = _joined(p, e, (d, rd, p - rp))
            d, p, rd, rp = d[a], p[a], rd[a], rp[a]
            order = np.lexsort((rp, rd, e, p, d))
            d, p, e, rd, rp = d[order], p[order], e[order], rd[order], rp[order]
            a, end = _joined(p, e, (d,))
            island = np.repeat(np.arange(len(a)), np.diff(np.append(a, len(d))))
            # the longest match of each, of equal ones the earliest
            best = np.lexsort((-rp, -rd, e - p, island))[np.append(a[1:], len(d)) - 1]
            yield runtime.batch(_PASSAGE_ARROW, doc_id=d[a], start=p[a].astype(np.int32), end=end.astype(np.int32),
                                ref_doc=rd[best], ref_start=rp[best].astype(np.int32))

    return run


def _joined(start: np.ndarray, end: np.ndarray, group: tuple[np.ndarray, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Rows at which ranges that neither overlap nor touch an earlier one begin, and their ends; rows sorted by group and start."""
    fresh = np.ones(len(start), dtype=bool)
    fresh[1:] = np.any([c[1:] != c[:-1] for c in group], axis=0)
    base = np.cumsum(fresh) << 32
    reach = np.maximum.accumulate(base + end) - base
    fresh[1:] |= start[1:] > reach[:-1]
    a = np.flatnonzero(fresh)
    return a, reach[np.append(a[1:], len(start)) - 1]


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, start, end, ref_doc, ref_start``: passages (words start to end) that occur earlier as well.

    Earlier is a smaller (doc_id, place); the first occurrence is not reported.
    Words are compared with A-Z lower-cased.  Every word of every passage of
    ``MIN_WORDS`` or more that repeats is in a reported range; ranges that
    overlap or touch are joined, and ``ref_doc`` and ``ref_start`` tell where
    the range's longest match stands (of matches with first occurrences).  Null,
    empty and short texts and rows without id have none; repeated rows of one
    id count as one document; an empty table gives none; other columns are not
    read.
    """
    spark = docs.sparkSession
    runtime.prepare(spark)
    scratch = Scratch(spark, "suffixes")
    n = runtime.partitions_for(spark)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    suffixes = scratch.cut(sparse_suffixes(texts), "suffixes")
    found, runs = neighbours(suffixes, scratch, n)
    scratch.drop(suffixes)
    asked = found.where("edge = 3").groupBy("doc_id").agg(F.collect_set(F.struct("pos", "size")).alias("asked"))
    windows = scratch.cut(texts.join(asked, "doc_id").mapInArrow(_windows, _SUFFIX_DDL), "windows")
    more, more_runs = neighbours(windows, scratch, n)
    scratch.drop(windows)
    matches = found.where("edge < 2").unionByName(more.where("edge < 2"))
    return matches.repartition(n, "doc_id").sortWithinPartitions("doc_id").mapInArrow(_passages(runs + more_runs), _PASSAGE)


def cut_passages(docs: DataFrame, passages: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with their columns, without the words of the given passages.

    The white space after a passage goes with it.  Texts without a passage are
    unchanged; a text that is all passage becomes empty; null texts stay null.
    Rows of one id all lose the passages given for it, rows without id none; an
    empty table stays empty.
    """
    runtime.prepare(docs.sparkSession)
    holes = passages.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("holes"))
    schema = docs.schema
    names = [f"c{i}" for i in range(len(schema))]
    id_at, text_at = names[schema.names.index(id_col)], names[schema.names.index(text_col)]
    joined = docs.toDF(*names).join(holes.withColumnsRenamed({"doc_id": "_doc", "holes": "_holes"}),
                                    F.col(id_at) == F.col("_doc"), "left").drop("_doc")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, holes_of = b.column(text_at), b.column("_holes").to_pylist()
            if any(holes_of):
                out = texts.to_pylist()
                for block in wordhash.blocks(texts):
                    for d in range(block.n_docs):
                        if holes_of[block.first + d]:
                            out[block.first + d] = _without(block, d, holes_of[block.first + d])
                texts = pa.array(out, texts.type)
            yield pa.RecordBatch.from_arrays([texts if n == text_at else b.column(n) for n in names], names=names)

    ddl = ", ".join(f"{n} {f.dataType.simpleString()}" for n, f in zip(names, schema))
    return joined.mapInArrow(run, ddl).toDF(*schema.names)


def _without(block: wordhash.Block, d: int, holes: list[dict]) -> str:
    begin, end = int(block.offsets[d]), int(block.offsets[d + 1])
    starts = block.starts[block.words[d] : block.words[d + 1]]
    raw, parts, at = block.data[begin:end].tobytes(), [], 0
    for h in holes:
        a = int(starts[h["start"]]) - begin
        z = int(starts[h["end"]]) - begin if h["end"] < len(starts) else end - begin
        parts.append(raw[at:a])
        at = z
    parts.append(raw[at:])
    return b"".join(parts).decode("utf-8")
