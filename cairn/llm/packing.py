"""Conflict-constrained best-fit packing of documents into training sequences.

Pieces of documents are dealt by a hash of the document id to shards of bounded
size (rows that repeat an id, and rows without one, by a hash of their place as
well); each shard is packed on its own.  In a shard the open bins are kept in
order of residual capacity, and each carries a bitmap of the sources and one of
the duplicate clusters that it holds.  A piece, in falling order of length,
searches from the tightest bin that it fits to ever looser successors until one
is compatible: a bin takes one document per source and per cluster.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.llm import runtime, wordhash

#: Words of one bin.
CAPACITY = 2048
#: Documents of one shard, on average.
SHARD_DOCUMENTS = 4096
#: Bins of one step of the successor search.
_STEP = 64

PIECES = "doc_id long, piece int, start int, length int, source string, cluster long, deal long"
PACKED = "doc_id long, piece int, start int, length int, shard long, bin int, at int"
_PACKED_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int32()), ("length", pa.int32()),
    ("shard", pa.int64()), ("bin", pa.int32()), ("at", pa.int32())])


class Bins:
    """Open bins in order of residual (ties: older first) with their bitmaps."""

    def __init__(self, capacity: int, n_sources: int, n_clusters: int):
        self.capacity = capacity
        self.width = (max(1, (n_sources + 63) // 64), max(1, (n_clusters + 63) // 64))
        self.size, room = 0, 1024
        self.residual = np.zeros(room, np.int32)
        self.number = np.zeros(room, np.int32)
        self.bits = np.zeros((room, sum(self.width)), np.uint64)
        self.opened = 0

    def _column(self, source: int, cluster: int) -> list[tuple[int, np.uint64]]:
        out = []
        if source >= 0:
            out.append((source // 64, np.uint64(1) << np.uint64(source % 64)))
        if cluster >= 0:
            out.append((self.width[0] + cluster // 64, np.uint64(1) << np.uint64(cluster % 64)))
        return out

    def place(self, length: int, source: int, cluster: int) -> tuple[int, int]:
        """Bin number and place in it for a piece; source or cluster -1 conflict with nothing."""
        marks = self._column(source, cluster)
        at, step = int(np.searchsorted(self.residual[: self.size], length)), _STEP
        found = -1
        while at < self.size:
            upto = min(self.size, at + step)
            clear = np.ones(upto - at, dtype=bool)
            for column, bit in marks:
                clear &= (self.bits[at:upto, column] & bit) == 0
            hit = int(clear.argmax())
            if clear[hit]:
                found = at + hit
                break
            at, step = upto, step * 4
        if found < 0:
            number, left, bits = self.opened, self.capacity, np.zeros(self.bits.shape[1], np.uint64)
            self.opened += 1
        else:
            number, left, bits = int(self.number[found]), int(self.residual[found]), self.bits[found].copy()
            self._remove(found)
        for column, bit in marks:
            bits[column] |= bit
        if left > length:
            self._insert(left - length, number, bits)
        return number, self.capacity - left

    def _remove(self, i: int) -> None:
        for a in (self.residual, self.number, self.bits):
            a[i : self.size - 1] = a[i + 1 : self.size]
        self.size -= 1

    def _insert(self, residual: int, number: int, bits: np.ndarray) -> None:
        if self.size == len(self.residual):
            for name in ("residual", "number", "bits"):
                old = getattr(self, name)
                grown = np.zeros((2 * len(old), *old.shape[1:]), old.dtype)
                grown[: len(old)] = old
                setattr(self, name, grown)
        lo = int(np.searchsorted(self.residual[: self.size], residual))
        hi = int(np.searchsorted(self.residual[: self.size], residual, side="right"))
        i = lo + int(np.searchsorted(self.number[lo:hi], number))
        for a, v in ((self.residual, residual), (self.number, number), (self.bits, bits)):
            a[i + 1 : self.size + 1] = a[i : self.size].copy()
            a[i] = v
        self.size += 1


def pack(length: np.ndarray, source: np.ndarray, cluster: np.ndarray, order: np.ndarray,
         capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and place of each piece; sources and clusters are dense numbers or -1."""
    bins = Bins(capacity, int(source.max(initial=-1)) + 1, int(cluster.max(initial=-1)) + 1)
    number, at = np.zeros(len(length), np.int32), np.zeros(len(length), np.int32)
    for i in order:
        number[i], at[i] = bins.place(int(length[i]), int(source[i]), int(cluster[i]))
    return number, at


def _dense(values: np.ndarray, only_repeated: bool = False) -> np.ndarray:
    """Dense numbers of non-null values; -1 for nulls (and for values that occur once, if asked)."""
    known = np.array([v is not None for v in values], dtype=bool)
    out = np.full(len(values), -1, np.int64)
    if known.any():
        _, code, count = np.unique(values[known], return_inverse=True, return_counts=True)
        if only_repeated:
            keep = count > 1
            code = np.where(keep[code], (np.cumsum(keep) - 1)[code], -1)
        out[known] = code
    return out


class _Seen:
    """Ids that a task has met, in sorted arrays of growing length."""

    def __init__(self) -> None:
        self.parts: list[np.ndarray] = []

    def repeats(self, ids: np.ndarray) -> np.ndarray:
        """Which of the ids an earlier row has."""
        own, first = np.unique(ids, return_index=True)
        again = np.ones(len(ids), dtype=bool)
        again[first] = False
        for part in self.parts:
            at = np.minimum(np.searchsorted(part, ids), len(part) - 1)
            again |= part[at] == ids
        self.parts.append(own)
        while len(self.parts) > 1 and 2 * len(self.parts[-1]) >= len(self.parts[-2]):
            self.parts[-2:] = [np.union1d(self.parts[-2], self.parts[-1])]
        return again


def _deal(ids: pa.Array, seen: _Seen, place: int) -> np.ndarray:
    """The number by which each row is dealt; ``place`` is that of the first row among all rows."""
    null = ids.is_null().to_numpy(zero_copy_only=False)
    values = ids.fill_null(0).to_numpy().astype(np.uint64)
    salted = null.copy()
    known = np.flatnonzero(~null)
    if len(known):
        salted[known] = seen.repeats(values[known])
    places = (np.arange(len(ids)) + place + 1).astype(np.uint64)
    return wordhash.as_long(wordhash.mix(values ^ np.where(salted, wordhash.mix(places), np.uint64(0))))


def pieces(docs: DataFrame, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text",
           source_col: str = "source") -> DataFrame:
    """Cut each document into pieces of at most ``capacity`` words.

    The cluster is a hash of the lower-cased word sequence.  A document without
    words is one piece of length 0 and of no cluster.  ``deal`` is a hash of the
    id for the first row of an id in a task, and of the task and the row's
    number too for the rows that repeat it there.
    """
    runtime.prepare(docs.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int32()),
                        ("length", pa.int32()), ("source", pa.string()), ("cluster", pa.int64()), ("deal", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, place = _Seen(), TaskContext.get().partitionId() << 40
        for b in batches:
            ids = b.column("doc_id").cast(pa.int64())
            deal = _deal(ids, seen, place)
            place += b.num_rows
            counts, cluster = np.zeros(b.num_rows, np.int64), np.zeros(b.num_rows, np.int64)
            for block in wordhash.blocks(b.column("text")):
                words = block.hashes()
                odd = np.arange(len(words), dtype=np.uint64) - np.repeat(
                    block.words[:-1], np.diff(block.words)).astype(np.uint64)
                parts = np.zeros(len(words) + 1, np.uint64)
                np.cumsum(wordhash.mix(words + odd * np.uint64(0x9E3779B97F4A7C15)), out=parts[1:])
                at = slice(block.first, block.first + block.n_docs)
                counts[at] = np.diff(block.words)
                cluster[at] = wordhash.as_long(parts[block.words[1:]] - parts[block.words[:-1]])
            n = np.maximum(1, -(-counts // capacity))
            row = np.repeat(np.arange(b.num_rows), n)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            start = piece * capacity
            yield pa.RecordBatch.from_arrays([
                ids.take(pa.array(row)), pa.array(piece.astype(np.int32)),
                pa.array(start.astype(np.int32)),
                pa.array(np.minimum(capacity, counts[row] - start).astype(np.int32)),
                b.column("source").cast(pa.string()).take(pa.array(row)),
                pa.array(cluster[row], mask=counts[row] == 0), pa.array(deal[row])], schema=schema)

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                       F.col(source_col).alias("source")).mapInArrow(run, PIECES)


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, shard_documents: int = SHARD_DOCUMENTS,
                   id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length`` (words), ``shard, bin, at``.

    (shard, bin) names a bin; its pieces lie at ``at`` without overlap and sum to
    at most ``capacity``.  A bin holds no two documents of one source or of one
    duplicate cluster; a null source conflicts with nothing.  A document without
    words has a piece of length 0.  Every row of the input is packed, repeated
    rows too (as copies, which conflict where they meet in a shard); rows without
    id and rows that repeat one are spread over all shards.  An empty table gives
    none; other columns are not read.
    """
    spark = docs.sparkSession
    shards = max(1, -(-docs.count() // shard_documents))
    parts = min(shards, max(runtime.partitions_for(spark), shards // 8))
    cut = pieces(docs, capacity, id_col, text_col, source_col)
    shard = F.pmod("deal", F.lit(shards)).alias("shard")
    dealt = cut.select(shard, "*").drop("deal").repartition(parts, "shard").sortWithinPartitions("shard", "doc_id", "piece")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, at in runtime.sorted_runs(batches, ["shard"]):
            for a, e in zip(at[:-1], at[1:]):
                t = table.slice(a, e - a)
                length = t.column("length").to_numpy()
                source = _dense(np.array(t.column("source").to_pylist(), dtype=object).astype(object))
                cluster = _dense(np.array(t.column("cluster").to_pylist(), dtype=object), only_repeated=True)
                order = np.argsort(-length.astype(np.int64), kind="stable")
                number, place = pack(length, source, cluster, order, capacity)
                yield from pa.Table.from_arrays(
                    [t.column("doc_id"), t.column("piece"), t.column("start"), t.column("length"), t.column("shard"),
                     pa.array(number), pa.array(place)], schema=_PACKED_ARROW).combine_chunks().to_batches()

    return dealt.mapInArrow(run, PACKED)
