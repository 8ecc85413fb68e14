"""Byte-level BPE encoding in batched numpy merge rounds, and decoding by table lookup.

The symbols of many words lie in one flat array.  In each round every adjacent
pair is looked up by binary search over the sorted pair keys of the merge
table; each word merges its pair of lowest rank, all words at once.  Words are
encoded once and remembered; texts are assembled from them by gathering.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex

from cairn.llm import wordhash

#: The pre-tokenizer of byte-level BPE (a fixed value of the public vocabulary's format).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Pre-tokens remembered by one worker before it starts anew, and chunks as a multiple of them (they take far fewer bytes).
MEMO_CHUNKS = 300_000
MEMO_BYTES_FACTOR = 5
#: Bytes of text handled at once.
BLOCK_BYTES = 1 << 19
_NO_PAIR = np.iinfo(np.int64).max


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters, extra = {b: chr(b) for b in plain}, 0
    for b in range(256):
        if b not in letters:
            letters[b] = chr(256 + extra)
            extra += 1
    return [letters[b] for b in range(256)]


#: Settings under which pre-tokens and merges are what this module makes of them; absent ones count as None.
_SUPPORTED = {
    "normalizer": (None,),
    "pre_tokenizer.type": ("ByteLevel",), "pre_tokenizer.add_prefix_space": (False,), "pre_tokenizer.use_regex": (True, None),
    "decoder.type": ("ByteLevel",), "model.type": ("BPE", None), "model.dropout": (None, 0.0), "model.unk_token": (None,),
    "model.continuing_subword_prefix": (None, ""), "model.end_of_word_suffix": (None, ""),
    "model.byte_fallback": (False, None), "model.ignore_merges": (False, None),
}


def read_settings(path: str) -> dict:
    """A vocabulary file's content; ValueError where it asks for what this module does not do."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    for name, allowed in _SUPPORTED.items():
        value = spec
        for part in name.split("."):
            value = value.get(part) if isinstance(value, dict) else None
        if value not in allowed:
            raise ValueError(f"{name} = {value!r} is not supported")
    for token in spec.get("added_tokens", []):
        for name in ("single_word", "lstrip", "rstrip"):
            if token.get(name):
                raise ValueError(f"added token {token['content']!r}: {name} is not supported")
    return spec


class PreTokenizer:
    """Pre-tokens of a text in order; special tokens as their ids."""

    def __init__(self, special: dict[str, int]):
        self.special = special
        self.find = regex.compile(PATTERN).findall
        names = sorted(special, key=len, reverse=True)
        self.names = names
        self.find_special = regex.compile("|".join(map(regex.escape, names))).finditer if names else None

    @classmethod
    def load(cls, path: str) -> PreTokenizer:
        return cls({t["content"]: t["id"] for t in read_settings(path).get("added_tokens", [])})

    def has_special(self, text: str) -> bool:
        return any(n in text for n in self.names)

    def __call__(self, text: str) -> list[str | int]:
        out: list[str | int] = []
        at = 0
        for m in self.find_special(text) if self.find_special else ():
            out += self.find(text[at : m.start()])
            out.append(self.special[m.group()])
            at = m.end()
        return out + self.find(text[at:]) if at else self.find(text)


@dataclass
class Vocabulary:
    """Tables of one byte-level BPE vocabulary."""

    pair_keys: np.ndarray  # sorted, left * size + right
    pair_ranks: np.ndarray
    pair_merged: np.ndarray
    byte_ids: np.ndarray
    token_bytes: np.ndarray  # uint8, all tokens
    token_at: np.ndarray  # offsets into token_bytes
    special: dict[str, int]
    size: int
    pretokens: PreTokenizer = field(repr=False)

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        spec = read_settings(path)
        vocab = spec["model"]["vocab"]
        special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        size = max([*vocab.values(), *special.values()]) + 1
        letters = byte_letters()
        as_byte = {c: b for b, c in enumerate(letters)}
        keys, merged = [], []
        for pair in spec["model"]["merges"]:
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            keys.append(vocab[left] * size + vocab[right])
            merged.append(vocab[left + right])
        keys = np.array(keys, dtype=np.int64)
        order = np.argsort(keys, kind="stable")
        by_id: list[bytes] = [b""] * size
        for token, i in vocab.items():
            if token not in special:
                by_id[i] = bytes(as_byte[c] for c in token)
        for token, i in special.items():
            by_id[i] = token.encode()
        at = np.zeros(size + 1, dtype=np.int64)
        np.cumsum([len(t) for t in by_id], out=at[1:])
        return cls(
            keys[order], np.arange(len(keys))[order], np.array(merged, dtype=np.int64)[order],
            np.array([vocab[c] for c in letters], dtype=np.int64),
            np.frombuffer(b"".join(by_id), dtype=np.uint8), at, special, size, PreTokenizer(special))

    # --- merging -----------------------------------------------------------

    def _lookup(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Index into the merge table for each pair, -1 for none."""
        keys = left * self.size + right
        i = np.searchsorted(self.pair_keys, keys)
        i[i == len(self.pair_keys)] = 0
        return np.where(self.pair_keys[i] == keys, i, -1)

    def merge_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in one flat array, and the offsets of each word."""
        lengths = np.array([len(w) for w in words], dtype=np.int64)
        symbols = self.byte_ids[np.frombuffer(b"".join(words), dtype=np.uint8)]
        word = np.repeat(np.arange(len(words)), lengths)
        done_symbols, done_words = [], []
        while len(symbols):
            rank = np.full(len(symbols), _NO_PAIR)
            same = word[1:] == word[:-1]
            hit = self._lookup(symbols[:-1], symbols[1:])
            usable = same & (hit >= 0)
            rank[:-1][usable] = self.pair_ranks[hit[usable]]
            first = np.flatnonzero(np.append(True, ~same))
            best = np.minimum.reduceat(rank, first)
            size = np.diff(np.append(first, len(symbols)))
            live = np.repeat(best != _NO_PAIR, size)
            if not live.all():
                done_symbols.append(symbols[~live])
                done_words.append(word[~live])
            chosen = live & (rank == np.repeat(best, size))
            chosen = _without_overlap(chosen)
            at = np.flatnonzero(chosen)
            symbols = symbols.copy()
            symbols[at] = self.pair_merged[hit[at]]
            keep = live
            keep[at + 1] = False
            symbols, word = symbols[keep], word[keep]
        flat = np.concatenate(done_symbols) if done_symbols else np.zeros(0, np.int64)
        owner = np.concatenate(done_words) if done_words else np.zeros(0, np.int64)
        order = np.argsort(owner, kind="stable")
        offsets = np.zeros(len(words) + 1, dtype=np.int64)
        np.cumsum(np.bincount(owner, minlength=len(words)), out=offsets[1:])
        return flat[order], offsets

    # --- decoding ----------------------------------------------------------

    def decode_bytes(self, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all tokens in one flat array, and the offsets for the given token offsets."""
        start = self.token_at[ids]
        length = self.token_at[ids + 1] - start
        ends = np.zeros(len(ids) + 1, dtype=np.int64)
        np.cumsum(length, out=ends[1:])
        return self.token_bytes[_ranges(start, length, ends)], ends[offsets]


def _ranges(start: np.ndarray, length: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """start[i], start[i] + 1, ... for each i, length[i] values, in one array."""
    return np.arange(ends[-1]) + np.repeat(start - ends[:-1], length)


def reordered(flat: np.ndarray, sizes: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lists that lie in ``order`` (list numbers), put in number order; sizes are by number."""
    at = np.zeros(len(sizes) + 1, dtype=np.int64)
    np.cumsum(sizes, out=at[1:])
    lies = np.zeros(len(sizes), dtype=np.int64)
    lies[order] = np.cumsum(sizes[order]) - sizes[order]
    return flat[_ranges(lies, sizes, at)], at


def _without_overlap(chosen: np.ndarray) -> np.ndarray:
    """Of pairs chosen in direct succession (as in ``aaa``) every second, from the left."""
    if not (chosen[1:] & chosen[:-1]).any():
        return chosen
    at = np.flatnonzero(chosen)
    new = np.ones(len(at), dtype=bool)
    new[1:] = np.diff(at) > 1
    run_start = np.repeat(np.flatnonzero(new), np.diff(np.append(np.flatnonzero(new), len(at))))
    out = np.zeros_like(chosen)
    out[at[(np.arange(len(at)) - run_start) % 2 == 0]] = True
    return out


#: White space that parts chunks searched together; it is a pre-token of its own before a chunk.
_SEPARATOR = "\u2028"


class _Numbers(dict):
    """Numbers keys in the order in which they are first asked for, and lists the new ones."""

    def __init__(self) -> None:
        self.new: list = []

    def __missing__(self, key) -> int:
        self[key] = n = len(self)
        self.new.append(key)
        return n


class _Lists:
    """Growing lists of ids by number, in one flat array."""

    def __init__(self) -> None:
        self.flat = np.zeros(1 << 16, dtype=np.int32)
        self.at = np.zeros(1 << 12, dtype=np.int64)
        self.n = 0

    def add(self, flat: np.ndarray, offsets: np.ndarray) -> None:
        used, more = self.at[self.n], len(offsets) - 1
        self.flat = _room(self.flat, used, len(flat))
        self.at = _room(self.at, self.n + 1, more)
        self.flat[used : used + len(flat)] = flat
        self.at[self.n + 1 : self.n + 1 + more] = used + offsets[1:]
        self.n += more

    def join(self, numbers: np.ndarray, groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Concatenated lists of the numbers, and the offsets of groups of them (groups are offsets into numbers)."""
        start = self.at[numbers]
        length = self.at[numbers + 1] - start
        ends = np.zeros(len(numbers) + 1, dtype=np.int64)
        np.cumsum(length, out=ends[1:])
        return self.flat[_ranges(start, length, ends)], ends[groups]


@dataclass
class _Chunks:
    """Chunks of a block: 64-bit keys, and the bytes themselves (``eight`` are those from any place on, as numbers).

    The second key holds a chunk's length and first eight bytes.
    """

    keys: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    data: np.ndarray  # with eight bytes more
    eight: np.ndarray


class _Table:
    """Numbers of byte strings: open addressing by two 64-bit keys, all strings of a block at once.

    A string is found only where all its bytes are equal, whatever the keys.
    """

    def __init__(self) -> None:
        self.slots = np.full(1 << 16, -1, dtype=np.int32)
        self.keys = np.zeros((1 << 12, 2), dtype=np.uint64)
        self.at = np.zeros(1 << 12, dtype=np.int64)
        self.bytes = np.zeros(1 << 16, dtype=np.uint8)
        self.n = self.used = 0

    def find(self, chunks: _Chunks, asked: np.ndarray) -> np.ndarray:
        """The number of each asked chunk, -1 for unknown ones."""
        keys = chunks.keys[asked]
        out = np.full(len(keys), -1, dtype=np.int64)
        left, mask = np.arange(len(keys)), np.uint64(len(self.slots) - 1)
        slot = keys[:, 0] & mask
        while len(left):
            entry = self.slots[slot.astype(np.int64)]
            there = entry >= 0
            left, slot, entry = left[there], slot[there], entry[there]
            hit = (self.keys[entry] == keys[left]).all(axis=1)
            out[left[hit]] = entry[hit]
            left, slot = left[~hit], (slot[~hit] + np.uint64(1)) & mask
        found = np.flatnonzero(out >= 0)
        a, at = chunks.starts[asked[found]], self.at[out[found]]
        far = chunks.ends[asked[found]] - a - 8  # where the last eight bytes begin; the first eight are in the second key
        eight = _eight(self.bytes)
        long = np.flatnonzero(far > 0)
        step = 8
        while len(long):
            k = np.minimum(far[long], step)
            same = chunks.eight[a[long] + k] == eight[at[long] + k]
            out[found[long[~same]]] = -1
            long = long[same & (far[long] > step)]
            step += 8
        return out

    def add(self, chunks: _Chunks, new: np.ndarray) -> None:
        """Number chunks that are not in the table, distinct in their first keys, in their order."""
        self.keys, self.at = _room(self.keys, self.n, len(new)), _room(self.at, self.n, len(new))
        self.keys[self.n : self.n + len(new)] = chunks.keys[new]
        size = chunks.ends[new] - chunks.starts[new]
        ends = np.zeros(len(new) + 1, dtype=np.int64)
        np.cumsum(size, out=ends[1:])
        self.bytes = _room(self.bytes, self.used, int(ends[-1]) + 8)
        self.bytes[self.used : self.used + int(ends[-1])] = chunks.data[_ranges(chunks.starts[new], size, ends)]
        self.at[self.n : self.n + len(new)] = self.used + ends[:-1]
        self.used += int(ends[-1])
        first, self.n = self.n, self.n + len(new)
        if 2 * self.n > len(self.slots):
            self.slots = np.full(1 << int(4 * self.n - 1).bit_length(), -1, dtype=np.int32)
            first = 0
        number, mask = np.arange(first, self.n), np.uint64(len(self.slots) - 1)
        slot = (self.keys[first : self.n, 0] & mask).astype(np.int64)
        while len(number):
            free = self.slots[slot] < 0
            self.slots[slot[free]] = number[free]  # of several for one slot the last stays
            lost = self.slots[slot] != number
            number, slot = number[lost], (slot[lost] + 1) & int(mask)


_STARTS = np.zeros(256, dtype=bool)
_STARTS[[0x20, 0x0A]] = True
_VISIBLE = np.zeros(256, dtype=bool)
_VISIBLE[0x21:0x7F] = True
_HEADS = np.array([(1 << 8 * k) - 1 for k in range(8)] + [2**64 - 1], dtype=np.uint64)


def _eight(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one number (places up to the eighth from the end)."""
    return np.ndarray((len(data) - 7,), dtype="<u8", buffer=data, strides=(1,))


def _chunks(data: np.ndarray, offsets: np.ndarray) -> tuple[_Chunks, np.ndarray]:
    """The chunks of a block, and the first chunk of each text."""
    mark = _STARTS[data]
    mark[offsets[:-1][np.diff(offsets) > 0]] = True
    starts = np.flatnonzero(mark)
    ends = np.append(starts[1:], len(data)) if len(starts) else starts
    keys = np.empty((len(starts), 2), dtype=np.uint64)
    keys[:, 0] = wordhash.Block(0, data, offsets, starts, ends, offsets).table_keys()
    padded = np.append(data, np.zeros(8, dtype=np.uint8))
    eight = _eight(padded)
    size = ends - starts
    keys[:, 1] = (eight[starts] & _HEADS[np.minimum(size, 8)]) ^ (size.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return _Chunks(keys, starts, ends, padded, eight), np.searchsorted(starts, offsets)


class TextEncoder:
    """Encodes texts from remembered chunks, and chunks from remembered pre-tokens.

    A chunk is a space or line end (none at the text's start) and the
    characters up to the next.  Where no chunk is empty and none begins or ends
    with further white space, pre-tokens never cross chunks, so a text's ids are
    its chunks' ids in order; other texts are split into pre-tokens whole.
    Known chunks are looked up all at once as bytes; only distinct pre-tokens
    reach ``encode_words``.
    """

    def __init__(self, pretokens, encode_words, limit: int = MEMO_CHUNKS):
        self.pretokens = pretokens  # text -> pre-tokens, special tokens as ids
        self.encode_words = encode_words  # pre-tokens -> (flat ids, offsets)
        self.limit = limit
        self._forget_words()
        self._forget_chunks()

    def _forget_words(self) -> None:
        self.words, self.word_ids = _Numbers(), _Lists()

    def _forget_chunks(self) -> None:
        self.table, self.chunk_ids = _Table(), _Lists()
        self.open_ended = np.zeros(1 << 12, dtype=bool)

    def _split(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts by way of their pre-tokens."""
        number, codes = self.words.__getitem__, []
        groups = np.zeros(len(texts) + 1, dtype=np.int64)
        for i, t in enumerate(texts):
            codes += map(number, self.pretokens(t))
            groups[i + 1] = len(codes)
        return self._of_words(np.array(codes, dtype=np.int64), groups)

    def _split_chunks(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """As ``_split`` for texts that neither end with white space nor hold the separator, in one search."""
        joined = _SEPARATOR.join(texts)
        if joined.count(_SEPARATOR) != len(texts) - 1 or self.pretokens.has_special(joined):
            return self._split(texts)
        found = self.pretokens.find(joined)
        code = np.fromiter(map(self.words.__getitem__, found), np.int64, len(found))
        cuts = np.flatnonzero(code == self.words[_SEPARATOR])
        groups = np.concatenate([[0], cuts - np.arange(len(cuts)), [len(code) - len(cuts)]])
        return self._of_words(code[code != self.words[_SEPARATOR]], groups)

    def _of_words(self, code: np.ndarray, groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if self.words.new:
            plain = [w for w in self.words.new if isinstance(w, str)]
            ids, at = self.encode_words(plain)
            if len(plain) < len(self.words.new):
                ids, at = _with_special(self.words.new, ids, at)
            self.word_ids.add(ids, at)
            self.words.new.clear()
        return self.word_ids.join(code, groups)

    def _learn(self, found: _Chunks, new: np.ndarray, chunks: list[str], plain: np.ndarray) -> None:
        odd = np.zeros(len(chunks), dtype=bool)
        for i in np.flatnonzero(~plain).tolist():
            odd[i] = _open_ended(chunks[i])
        good = np.flatnonzero(~odd)
        sizes = np.zeros(len(chunks), dtype=np.int64)
        flat = np.zeros(0, dtype=np.int32)
        if len(good):
            flat, at = self._split_chunks([c for c, o in zip(chunks, odd) if not o])
            sizes[good] = np.diff(at)
        self.open_ended = _room(self.open_ended, self.table.n, len(chunks))
        self.open_ended[self.table.n : self.table.n + len(chunks)] = odd
        self.table.add(found, new)
        self.chunk_ids.add(*reordered(flat, sizes, good))

    def encode_bytes(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a block in one flat array, and the offsets of each text."""
        if self.table.n > MEMO_BYTES_FACTOR * self.limit:
            self._forget_chunks()
        if len(self.words) > self.limit:
            self._forget_words()
        chunks, groups = _chunks(data, offsets)
        code = self.table.find(chunks, np.arange(len(chunks.starts)))
        unknown = np.flatnonzero(code < 0)
        if len(unknown):
            _, first = np.unique(chunks.keys[unknown, 0], return_index=True)
            chosen = unknown[np.sort(first)]
            raw, a, e = data.tobytes(), chunks.starts[chosen], chunks.ends[chosen]
            # chunks whose first and last characters are visible ASCII need no closer look
            first = a + (_STARTS[data[a]] & (e - a > 1))
            plain = _VISIBLE[data[first]] & _VISIBLE[data[e - 1]]
            self._learn(chunks, chosen, [raw[x:y].decode() for x, y in zip(a.tolist(), e.tolist())], plain)
            code[unknown] = self.table.find(chunks, unknown)
            if (code < 0).any():  # equal keys of different chunks
                return self._split([data[a:e].tobytes().decode() for a, e in zip(offsets[:-1], offsets[1:])])
        flat, at = self.chunk_ids.join(code, groups)
        open_chunks = self.open_ended[code]
        if not open_chunks.any():
            return flat, at
        whole = np.unique(np.searchsorted(groups, np.flatnonzero(open_chunks), side="right") - 1)
        extra, extra_at = self._split([data[offsets[i] : offsets[i + 1]].tobytes().decode() for i in whole])
        parts, begin, sizes = [], 0, np.diff(at)
        for k, i in enumerate(whole):
            parts += [flat[begin : at[i]], extra[extra_at[k] : extra_at[k + 1]]]
            begin = at[i + 1]
            sizes[i] = extra_at[k + 1] - extra_at[k]
        parts.append(flat[begin:])
        out = np.zeros(len(sizes) + 1, dtype=np.int64)
        np.cumsum(sizes, out=out[1:])
        return np.concatenate(parts), out

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """As ``encode_bytes`` for a list of texts."""
        return self.encode_bytes(*wordhash.text_bytes(pa.array(texts, pa.string())))

    def encode_column(self, column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each block of a text column (nulls are empty): its first row, flat ids and text offsets."""
        for first, data, offsets in wordhash.byte_blocks(column, BLOCK_BYTES):
            yield first, *self.encode_bytes(data, offsets)


def _open_ended(chunk: str) -> bool:
    """Whether a chunk may share a white-space run with its neighbour."""
    body = chunk[1:] if chunk[0] in " \n" else chunk
    return not body or body[0].isspace() or body[-1].isspace()


def _room(a: np.ndarray, used: int, more: int) -> np.ndarray:
    if used + more <= len(a):
        return a
    grown = np.zeros((max(2 * len(a), used + more), *a.shape[1:]), dtype=a.dtype)
    grown[:used] = a[:used]
    return grown


class Encoder:
    """Whole texts to ids with the batched merge rounds."""

    def __init__(self, path: str):
        self.vocabulary = Vocabulary.load(path)
        self.texts = TextEncoder(self.vocabulary.pretokens, self._merge)

    def _merge(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return self.vocabulary.merge_words([w.encode("utf-8") for w in words])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return self.texts.encode(texts)

    def encode_column(self, column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        return self.texts.encode_column(column)


def _with_special(keys: list, ids: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    parts, sizes, j = [], [], 0
    for k in keys:
        if isinstance(k, str):
            parts.append(ids[at[j] : at[j + 1]])
            j += 1
        else:
            parts.append(np.array([k], dtype=np.int64))
        sizes.append(len(parts[-1]))
    return np.concatenate(parts), np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)


_encoders: dict[str, Encoder] = {}


def worker_encoder(path: str) -> Encoder:
    """The encoder of this Python worker, kept from task to task."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
