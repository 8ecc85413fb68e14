"""Token ids in binary files: frequency ranks in a byte-aligned variable-length code.

Ids are replaced by their rank in the order of falling corpus frequency, so
frequent ids take one byte.  Lengths stand apart from the bytes: a control byte
holds the lengths of four values.  Decoding looks control bytes up in a table
and gathers; nothing is parsed value by value.

A data set is a folder of shard files, in ascending document order, and a
manifest.  A shard is a sequence of blocks of whole documents; each block has a
header, the document ids, their token counts, control bytes and data bytes.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.llm import bpe, files, runtime
from cairn.llm.scratch import Scratch

END_ID = 0
#: Tokens of one block of a shard (a longer document is a block of its own).
BLOCK_TOKENS = 1 << 20
_HEADER = struct.Struct("<4sIQQQ")  # magic, documents, tokens, control bytes, data bytes
_MAGIC = b"CTK1"

#: For each control byte the lengths of its four values, and for each length the mask of its bits.
LENGTHS = (((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3) + 1).astype(np.int64)
MASKS = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], dtype=np.uint32)


def encode_values(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control and data bytes of unsigned 32-bit values."""
    v = np.ascontiguousarray(values, dtype="<u4")
    more = (v > 0xFF).astype(np.uint8) + (v > 0xFFFF) + (v > 0xFFFFFF)
    padded = np.zeros(-(-len(v) // 4) * 4, dtype=np.uint8)
    padded[: len(v)] = more
    quads = padded.reshape(-1, 4)
    control = quads[:, 0] | quads[:, 1] << 2 | quads[:, 2] << 4 | quads[:, 3] << 6
    data = v.view(np.uint8).reshape(-1, 4)[np.arange(4) <= more[:, None]]
    return control.astype(np.uint8).tobytes(), data.tobytes()


def decode_values(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The n values of ``encode_values``."""
    length = LENGTHS[np.frombuffer(control, dtype=np.uint8)].ravel()[:n]
    at = np.cumsum(length) - length
    raw = np.frombuffer(data + b"\0\0\0", dtype=np.uint8).astype(np.uint32)
    value = raw[at]
    for k in range(1, int(length.max(initial=1))):
        value = value | raw[at + k] << np.uint32(8 * k)
    return value & MASKS[length]


def encode_block(doc_ids: list[int | None], counts: np.ndarray, ranks: np.ndarray) -> bytes:
    control, data = encode_values(ranks)
    known = np.array([i is not None for i in doc_ids], dtype=np.uint8)
    ids = np.array([i or 0 for i in doc_ids], dtype="<i8")
    return b"".join([
        _HEADER.pack(_MAGIC, len(doc_ids), len(ranks), len(control), len(data)),
        ids.tobytes(), known.tobytes(), counts.astype("<i8").tobytes(), control, data])


def read_blocks(reader: files.Reader) -> Iterator[tuple[list[int | None], np.ndarray, np.ndarray]]:
    """Document ids, token counts and ranks of each block in turn."""
    at, size = 0, reader.size()
    while at < size:
        magic, docs, tokens, n_control, n_data = _HEADER.unpack(reader.read(at, _HEADER.size))
        if magic != _MAGIC:
            raise ValueError("not a token file")
        body = reader.read(at + _HEADER.size, 17 * docs + n_control + n_data)
        ids = np.frombuffer(body, "<i8", docs)
        known = np.frombuffer(body, np.uint8, docs, 8 * docs)
        counts = np.frombuffer(body, "<i8", docs, 9 * docs)
        control = body[17 * docs : 17 * docs + n_control]
        yield ([int(i) if k else None for i, k in zip(ids, known)], counts,
               decode_values(control, body[17 * docs + n_control :], tokens))
        at += _HEADER.size + len(body)


def id_type(tokenizer_path: str) -> str:
    """The narrowest unsigned integer that holds every id of a vocabulary."""
    from tokenizers import Tokenizer

    return "<u2" if Tokenizer.from_file(tokenizer_path).get_vocab_size() <= 1 << 16 else "<u4"


def tokenize(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
             end_id: int = END_ID) -> DataFrame:
    """``doc_id, ids, counts``: the tokenizers library's ids (``id_type``) of whole texts, with the end id.

    The library encodes the distinct pre-tokens of the texts; see
    ``bpe.TextEncoder``.  The last row of each partition has no ids but
    ``counts``: how often each id occurs in the partition.  Null texts count as empty: they
    have the end id alone.  Rows with a null or repeated id are documents of their own.
    """
    runtime.prepare(docs.sparkSession)
    kind = id_type(tokenizer_path)
    end = np.array([end_id], dtype=kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, total = _library_encoder(tokenizer_path), np.zeros(1, dtype=np.int64)
        for b in batches:
            for first, flat, at in encoder.encode_column(b.column("text")):
                n = len(at) - 1
                counts = np.bincount(flat, minlength=max(end_id + 1, len(total)))
                counts[end_id] += n
                counts[: len(total)] += total
                total, flat = counts, flat.astype(kind)
                yield pa.RecordBatch.from_arrays([
                    b.column("doc_id").cast(pa.int64()).slice(first, n),
                    pa.array([np.concatenate([flat[a:e], end]).tobytes() for a, e in zip(at[:-1], at[1:])], pa.binary()),
                    pa.nulls(n, pa.binary())], names=["doc_id", "ids", "counts"])
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.array([total.astype("<i8").tobytes()])],
            names=["doc_id", "ids", "counts"])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, "doc_id long, ids binary, counts binary")


_library_encoders: dict[str, bpe.TextEncoder] = {}


def _library_encoder(path: str) -> bpe.TextEncoder:
    """The library behind a memory of chunks and pre-tokens, kept in the Python worker from task to task."""
    if path not in _library_encoders:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the threads; more would each hold memory
        from tokenizers import Tokenizer

        library = Tokenizer.from_file(path)
        library.no_padding()
        library.no_truncation()
        (newline,) = library.encode("\n", add_special_tokens=False).ids

        def encode(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
            # words without white space inside are joined by line ends, which are tokens of their own before a word
            plain = np.array([w[:1] != "\n" and w.isprintable() and not w[1:].isspace() and w != " " for w in words], dtype=bool)
            joined, alone = np.flatnonzero(plain), np.flatnonzero(~plain)
            parts = [joined[lo : lo + 2048] for lo in range(0, len(joined), 2048)]
            texts = ["\n".join([words[i] for i in part]) for part in parts] + [words[i] for i in alone]
            got = [np.array(e.ids, dtype=np.int64) for e in library.encode_batch_fast(texts, add_special_tokens=False)]
            flat = np.concatenate(got) if got else np.zeros(0, dtype=np.int64)
            ends = np.cumsum([len(x) for x in got[len(parts) :]])
            cuts = [np.flatnonzero(x == newline) for x in got[: len(parts)]]
            if any(len(c) != len(part) - 1 for c, part in zip(cuts, parts)):
                raise ValueError("the vocabulary merges line ends with words")
            sizes = np.zeros(len(words), dtype=np.int64)
            for c, x, part in zip(cuts, got, parts):
                sizes[part] = np.diff(np.concatenate([[-1], c, [len(x)]])) - 1
            sizes[alone] = np.diff(np.concatenate([[0], ends])) if len(alone) else 0
            head = flat[: len(flat) - (int(ends[-1]) if len(alone) else 0)]
            flat = np.concatenate([head[head != newline], flat[len(head) :]])
            return bpe.reordered(flat, sizes, np.concatenate([joined, alone]))

        _library_encoders[path] = bpe.TextEncoder(bpe.PreTokenizer.load(path), encode)
    return _library_encoders[path]


@dataclass
class TokenFiles:
    """A written data set.  shards: (uri, first token, documents, tokens) in document order."""

    spark: SparkSession
    shards: list[tuple[str, int, int, int]]
    id_of_rank: np.ndarray

    def read(self) -> DataFrame:
        """``doc_id, start, ids``: all documents with the number of ids before each."""
        def rows(doc_ids: list, starts: np.ndarray, ids: list[np.ndarray]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(doc_ids, pa.int64()), pa.array(starts), pa.array([x.tobytes() for x in ids], pa.binary())],
                names=["doc_id", "start", "ids"])

        return self._scan(rows, "doc_id long, start long, ids binary")

    def digest(self) -> DataFrame:
        """``doc_id, start, n_tokens, ids_crc32`` (unsigned, of ids as little-endian 32-bit integers)."""
        def rows(doc_ids: list, starts: np.ndarray, ids: list[np.ndarray]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(doc_ids, pa.int64()), pa.array(starts), pa.array([len(x) for x in ids], pa.int64()),
                 pa.array([zlib.crc32(x) for x in ids], pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

        return self._scan(rows, "doc_id long, start long, n_tokens long, ids_crc32 long")

    def _scan(self, rows, schema: str) -> DataFrame:
        """Decode every block of every shard on the executors."""
        shards = self.spark.createDataFrame(
            [(u, s) for u, s, _, _ in self.shards] or [("", -1)], "uri string, start long").where("start >= 0")
        table = self.spark.sparkContext.broadcast(self.id_of_rank.astype("<u4"))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for uri, start in zip(b.column("uri").to_pylist(), b.column("start").to_pylist()):
                    reader = files.Reader(uri)
                    for doc_ids, counts, ranks in read_blocks(reader):
                        ids, ends = table.value[ranks], np.cumsum(counts)
                        yield rows(doc_ids, start + ends - counts, [ids[e - c : e] for c, e in zip(counts, ends)])
                        start += int(ends[-1])
                    reader.close()

        return shards.repartition(max(1, len(self.shards))).mapInArrow(run, schema)


def write_token_files(docs: DataFrame, tokenizer_path: str, folder: str | None = None, id_col: str = "doc_id",
                      text_col: str = "text", end_id: int = END_ID, shards: int | None = None) -> TokenFiles:
    """Tokenize whole texts and write them, in ascending document order, as token files.

    Null and empty texts hold the end id alone.  Null document ids come first;
    repeated rows are written one after the other; an empty table gives a data
    set without shards.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "tokens")
    folder = folder or scratch.path("files")
    kind = id_type(tokenizer_path)
    written = scratch.cut(tokenize(docs, tokenizer_path, id_col, text_col, end_id), "ids")

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for raw in b.column("counts").to_pylist():
                n = np.frombuffer(raw, "<i8")
                seen = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(n[seen])], names=["id", "n"])

    # a row for each id of the vocabulary at most
    found = written.where("counts IS NOT NULL").select("counts").mapInArrow(unpack, "id long, n long").groupBy("id").agg(
        F.sum("n").alias("n")).collect()
    ids = written.where("counts IS NULL").select("doc_id", "ids")
    id_of_rank = np.array([r.id for r in sorted(found, key=lambda r: (-r.n, r.id))], dtype=np.int64)
    rank_of = np.zeros(int(id_of_rank.max(initial=0)) + 1, dtype=np.uint32)
    rank_of[id_of_rank] = np.arange(len(id_of_rank))
    shared, width = spark.sparkContext.broadcast(rank_of), np.dtype(kind).itemsize

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _library_encoders.clear()  # the worker's memory is needed here
        part = TaskContext.get().partitionId()
        out, n_docs, n_tokens = None, 0, 0
        doc_ids, raws, held = [], [], 0

        def flush() -> None:
            nonlocal n_docs, n_tokens, held
            flat = np.frombuffer(b"".join(raws), kind)
            counts = np.array([len(r) // flat.itemsize for r in raws], dtype=np.int64)
            out.write(encode_block(doc_ids, counts, shared.value[flat]))
            n_docs, n_tokens, held = n_docs + len(doc_ids), n_tokens + len(flat), 0
            doc_ids.clear()
            raws.clear()

        for b in batches:
            for i, raw in zip(b.column("doc_id").to_pylist(), b.column("ids").to_pylist()):
                out = out or files.Writer(files.fresh_name(folder, "shard", part, ".ctk"))
                doc_ids.append(i)
                raws.append(raw)
                held += len(raw) // width
                if held >= BLOCK_TOKENS:
                    flush()
        if out:
            if doc_ids:
                flush()
            out.close()
            yield pa.RecordBatch.from_pydict(
                {"part": [part], "uri": [out.uri], "docs": [n_docs], "tokens": [n_tokens]})

    manifest = (
        ids.repartitionByRange(shards or runtime.partitions_for(spark), "doc_id")
        .sortWithinPartitions("doc_id", "ids")
        .mapInArrow(write, "part long, uri string, docs long, tokens long").collect()
    )
    scratch.drop(written)
    done, start = [], 0
    for r in sorted(manifest, key=lambda r: r.part):
        done.append((r.uri, start, r.docs, r.tokens))
        start += r.tokens
    return TokenFiles(spark, done, id_of_rank)
