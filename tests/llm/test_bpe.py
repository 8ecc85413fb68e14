import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from cairn.llm import bpe, token_files

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(PATH)


CASES = [
    "", " ", "  ", "a", " a", "a ", "aaa aaaa aaaaa", "don't we'll I'd 's", "x  y", "x\ny", "x \n y", "x\n\n y ",
    "tab\there", "über straße ñandú", "日本語 テキスト", "😀 😃😄", "a b  c", "1234567890 12a34",
    "<|endoftext|>", "a<|endoftext|>b <|endoftext|> c", "nul\0byte \0", "!!! ... ,,, ###$$$", "word." * 300,
    "é combining", "\u001c x\u001d y", "end\n", "line\u2028sep x", "\u2028 a", "b \u2028",
]


def check(library, encoder, texts):
    ids, at = encoder.encode(texts)
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    for i, w in enumerate(want):
        assert ids[at[i] : at[i + 1]].tolist() == w, texts[i]
    raw, ends = encoder.vocabulary.decode_bytes(ids, at)
    for i, w in enumerate(want):
        got = raw[ends[i] : ends[i + 1]].tobytes().decode("utf-8", "replace")
        assert got == library.decode(w, skip_special_tokens=False)


def test_special_cases(library, encoder):
    check(library, encoder, CASES)
    check(library, encoder, CASES)  # from memory


def test_random_texts(library, encoder):
    rng = random.Random(5)
    letters = "aabcde  '\n\t.,!12éßñ日😀 st"
    check(library, encoder, ["".join(rng.choices(letters, k=rng.randrange(60))) for _ in range(800)])


def test_forgetting(library):
    small = bpe.Encoder(PATH)
    small.texts.limit = 3
    check(library, small, CASES)
    check(library, small, CASES[::-1])


def test_library_behind_memory(library):
    encoder = token_files._library_encoder(PATH)
    for texts in (CASES, CASES[::-1]):
        ids, at = encoder.encode(texts)
        for i, e in enumerate(library.encode_batch(texts, add_special_tokens=False)):
            assert ids[at[i] : at[i + 1]].tolist() == e.ids, texts[i]


def test_overlapping_pairs():
    chosen = np.array([1, 1, 1, 0, 1, 0, 1, 1], dtype=bool)
    assert bpe._without_overlap(chosen).tolist() == [True, False, True, False, True, False, True, False]


@pytest.mark.parametrize("part, value", [
    ("normalizer", {"type": "NFC"}), ("pre_tokenizer", {"type": "Whitespace"}), ("decoder", None),
    ("pre_tokenizer", {"type": "ByteLevel", "add_prefix_space": True}), ("model", {"type": "BPE", "ignore_merges": True}),
    ("added_tokens", [{"id": 1, "content": "x", "lstrip": True}])])
def test_settings_that_are_not_supported(tmp_path, part, value):
    import json

    spec = {"pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": False}, "decoder": {"type": "ByteLevel"}, "model": {"type": "BPE"}}
    path = tmp_path / "t.json"
    path.write_text(json.dumps(spec))
    assert bpe.read_settings(str(path)) == spec
    path.write_text(json.dumps({**spec, part: value}))
    with pytest.raises(ValueError, match="not supported"):
        bpe.PreTokenizer.load(str(path))
