"""BPE encoding and decoding of document tables."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.llm import bpe, runtime


def encode(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids`` (array of int) of each whole text; null and empty texts have none.

    A null id stays null; repeated rows are encoded one by one; an empty table gives none.
    """
    runtime.prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = bpe.worker_encoder(tokenizer_path)
        for b in batches:
            for first, flat, at in encoder.encode_column(b.column("text")):
                yield pa.RecordBatch.from_arrays([
                    b.column("doc_id").cast(pa.int64()).slice(first, len(at) - 1),
                    pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(flat.astype(np.int32)))],
                    names=["doc_id", "ids"])

    return _texts(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, tokenizer_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``doc_id, text`` of token ids, special tokens kept; bytes that are no UTF-8 become U+FFFD.

    A null list decodes to an empty text; repeated rows are decoded one by one, and an
    empty table gives none.
    """
    runtime.prepare(encoded.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = bpe.worker_encoder(tokenizer_path).vocabulary
        for b in batches:
            lists = b.column("ids").fill_null([])
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            at = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int64)
            raw, ends = vocabulary.decode_bytes(flat, at)
            yield pa.RecordBatch.from_arrays([
                b.column("doc_id").cast(pa.int64()),
                pa.array([raw[a:e].tobytes().decode("utf-8", "replace") for a, e in zip(ends[:-1], ends[1:])], pa.string())],
                names=["doc_id", "text"])

    return encoded.select(F.col(id_col).alias("doc_id"), F.col(ids_col).alias("ids")).mapInArrow(
        run, "doc_id long, text string")


def round_trip(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode, decode, and return digests: ``doc_id, n_tokens, ids_sha256, decoded_sha256``.

    Both directions run in one pass, so ids and decoded texts never leave the worker.
    Null texts count as empty and have no tokens; rows with a null or repeated id are
    documents of their own; an empty table gives none; no other column is read.
    """
    runtime.prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = bpe.worker_encoder(tokenizer_path)
        for b in batches:
            for first, flat, at in encoder.encode_column(b.column("text")):
                raw, ends = encoder.vocabulary.decode_bytes(flat, at)
                ids = flat.astype("<u4")
                yield pa.RecordBatch.from_arrays([
                    b.column("doc_id").cast(pa.int64()).slice(first, len(at) - 1),
                    pa.array(np.diff(at)),
                    pa.array([hashlib.sha256(ids[a:e]).hexdigest() for a, e in zip(at[:-1], at[1:])]),
                    pa.array([hashlib.sha256(_as_text(raw[a:e])).hexdigest() for a, e in zip(ends[:-1], ends[1:])])],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return _texts(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def _as_text(raw: np.ndarray) -> bytes:
    return raw.tobytes().decode("utf-8", "replace").encode("utf-8")


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
