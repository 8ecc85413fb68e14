"""Words of whole texts and their 64-bit hashes, on flat numpy arrays.

A word is a longest run of bytes outside 0x20 and 0x09-0x0D, so UTF-8 needs no
decoding.  A word's hash is the sum of its bytes' random codes, each times a
random number of its place in the word, modulo 2**64: no arrangement of letters
makes such sums equal but by chance, as it does for powers of one base.  Every
pass is one numpy operation over all bytes of a block of documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text handled by one block of array operations (a longer text is a block of its own).
BLOCK_BYTES = 1 << 20

_rng = np.random.Generator(np.random.PCG64(20240607))
_BASE = np.uint64(0x9E3779B97F4A7C15)
_CODES = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER_CODES = _CODES.copy()
_LOWER_CODES[65:91] = _CODES[97:123]
_ODD = _rng.integers(1, 2**63, 128, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ODD_TOO = _rng.integers(1, 2**63, 128, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_powers: dict[str, np.ndarray] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers["up"]) < n:
        size = max(n, BLOCK_BYTES + 1)
        inverse = np.uint64(pow(int(_BASE), -1, 2**64))
        for name, base in (("up", _BASE), ("down", inverse)):
            table = np.full(size, base, dtype=np.uint64)
            table[0] = 1
            _powers[name] = np.multiply.accumulate(table)
    return _powers["up"][:n], _powers["down"]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _of_place(place: np.ndarray) -> np.ndarray:
    """A random odd number for each place in a word."""
    return mix((place.astype(np.uint64) + np.uint64(1)) * _BASE) | np.uint64(1)


#: Places whose numbers are kept; those of farther ones are made when a word is that long.
_PLACES = 1 << 16
_OF_PLACE = _of_place(np.arange(_PLACES))


@dataclass
class Block:
    """Texts of consecutive documents and the places of their words."""

    first: int  # index of the first document in its batch
    data: np.ndarray  # uint8
    offsets: np.ndarray  # int64, documents + 1
    starts: np.ndarray  # of words, in bytes of data
    ends: np.ndarray
    words: np.ndarray  # documents + 1: word index at which each document begins

    @property
    def n_docs(self) -> int:
        return len(self.offsets) - 1

    def hashes(self, lower: bool = True) -> np.ndarray:
        """One mixed 64-bit hash for each word; A-Z are taken as a-z if lower."""
        if not len(self.starts):
            return np.zeros(0, dtype=np.uint64)
        first, n = int(self.starts[0]), len(self.data)
        begins = self.starts.astype(np.int32) if n < 1 << 31 else self.starts
        place = np.arange(first, n, dtype=begins.dtype)
        place -= np.repeat(begins, np.diff(np.append(begins, begins.dtype.type(n))))
        terms = _OF_PLACE[place & (_PLACES - 1)]
        if (self.ends - self.starts).max() > _PLACES:
            far = np.flatnonzero(place >= _PLACES)
            terms[far] = _of_place(place[far])
        terms *= (_LOWER_CODES if lower else _CODES)[self.data[first:]]
        sums = np.zeros(n - first + 1, dtype=np.uint64)
        np.cumsum(terms, out=sums[1:])
        return mix(sums[self.ends - first] - sums[self.starts - first])

    def table_keys(self) -> np.ndarray:
        """A 64-bit number for each word by powers of one base: quick, for tables that compare the bytes as well."""
        if not len(self.starts):
            return np.zeros(0, dtype=np.uint64)
        up, down = _power_tables(len(self.data))
        sums = np.empty(len(self.data) + 1, dtype=np.uint64)
        sums[0] = 0
        np.cumsum(_CODES[self.data] * up, out=sums[1:])
        return mix((sums[self.ends] - sums[self.starts]) * down[self.starts])


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts and the offsets of each (nulls are empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def byte_blocks(column: pa.Array, block_bytes: int | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """First row, bytes and offsets of blocks of whole documents."""
    data, offsets = text_bytes(column)
    n, i, size = len(offsets) - 1, 0, block_bytes or BLOCK_BYTES
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + size, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j


def blocks(column: pa.Array, block_bytes: int | None = None) -> Iterator[Block]:
    """Split a text column into blocks of whole documents."""
    for first, data, offsets in byte_blocks(column, block_bytes):
        yield _block(first, data, offsets)


def _block(first: int, data: np.ndarray, offsets: np.ndarray) -> Block:
    inside = ~_SPACE[data]
    full = np.flatnonzero(offsets[1:] > offsets[:-1])
    before = np.empty_like(inside)
    after = np.empty_like(inside)
    if len(data):
        before[0], after[-1] = False, False
        before[1:], after[:-1] = inside[:-1], inside[1:]
        before[offsets[:-1][full]] = False
        after[offsets[1:][full] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return Block(first, data, offsets, starts, ends, np.searchsorted(starts, offsets))


def ngram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all n-word windows of a flat word array (at least n words)."""
    total = words[: len(words) - n + 1] * _ODD[0]
    for j in range(1, n):
        total = total + words[j : len(words) - n + 1 + j] * _ODD[j]
    return mix(total)


def ngram_hashes_at(words: np.ndarray, at: np.ndarray, n: int, other: bool = False) -> np.ndarray:
    """``ngram_hashes(words, n)[at]`` without the other windows; if ``other``, a second hash of the same windows."""
    odd = _ODD_TOO if other else _ODD
    total = words[at] * odd[0]
    for j in range(1, n):
        total = total + words[at + j] * odd[j]
    return mix(total)


def whole_hash(words: np.ndarray) -> np.ndarray:
    """Hash of one sequence shorter than a window, as an array of one value."""
    total = np.uint64(len(words))
    with np.errstate(over="ignore"):
        for j, w in enumerate(words):
            total = total + w * _ODD[j]
    return mix(np.array([total ^ np.uint64(0xA5A5A5A5A5A5A5A5)], dtype=np.uint64))


def ngram_sets(block: Block, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-word shingle hashes of each document, sorted, and their offsets.

    A document with fewer words has its whole sequence as its one shingle; one
    without words has none.
    """
    words = block.hashes()
    counts = np.diff(block.words)
    sizes = np.where(counts >= n, counts - n + 1, np.minimum(counts, 1))
    at = np.zeros(len(counts) + 1, dtype=np.int64)
    np.cumsum(sizes, out=at[1:])
    flat = np.empty(int(at[-1]), dtype=np.uint64)
    grams = ngram_hashes(words, n) if len(words) >= n else words[:0]
    for d in range(len(counts)):
        a, b = at[d], at[d + 1]
        if counts[d] >= n:
            flat[a:b] = grams[block.words[d] : block.words[d] + b - a]
            flat[a:b].sort()
        elif b > a:
            flat[a:b] = whole_hash(words[block.words[d] : block.words[d + 1]])
    new = np.ones(len(flat), dtype=bool)
    new[1:] = flat[1:] != flat[:-1]
    new[at[:-1][sizes > 0]] = True
    kept = np.zeros(len(flat) + 1, dtype=np.int64)
    np.cumsum(new, out=kept[1:])
    return flat[new], kept[at]


def as_long(h: np.ndarray) -> np.ndarray:
    """The same bits as signed 64-bit integers."""
    return h.view(np.int64)


def as_hash(h: np.ndarray) -> np.ndarray:
    """The same bits as unsigned 64-bit integers."""
    return np.ascontiguousarray(h, dtype=np.int64).view(np.uint64)
