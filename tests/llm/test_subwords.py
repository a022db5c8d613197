"""Ids put together from pieces are those the library gives for the whole text."""

import random

import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from pulsetide.llm import byte_bpe, subwords
from pulsetide.llm.subwords import Pieces, drops_space_and_case

WORDS = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")).to_str()
PARTS = [
    " ", "  ", "\n", "\t", " ", " ", " ", "\x1c", "\x85", "a", "B", "J", "Word", "ab", "̌", "İ", "I", "̇", "é", "É", "Þ", "×",
    "÷", "E", "́", ",", ".", "*", "-", "(", ")", "$$$", "'s", "'S", "'", "1", "٣", "ß", "ẞ", "Σ", "ς", "한", "ᄒ", "ᅡ",
    "<|endoftext|>", "<|startoftext|>", "\U0001f600", "ﬁ", "K", "‍",
]


@pytest.fixture(params=["words", "bytes"])
def described(request):
    if request.param == "words":
        return WORDS
    ranks = byte_bpe.read_ranks(public_tokenizers.path(byte_bpe.VOCABULARY))
    return byte_bpe.tokenizer_of(ranks, public_tokenizers.PATTERN).to_str()


def test_ids_of_odd_texts(described, monkeypatch):
    monkeypatch.setattr(subwords, "REMEMBERED", 700)
    rng = random.Random(5)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 14))) for _ in range(4000)]
    texts += [None, "", " ", "a" * 50_000, " ".join(f"x{i}, " for i in range(9_000))]
    pieces, library = Pieces(described), Tokenizer.from_str(described)
    for turn in range(2):  # the second time many pieces are remembered
        ids, bounds = pieces.encode(pa.array(texts))
        for nr, text in enumerate(texts):
            assert ids[bounds[nr] : bounds[nr + 1]].tolist() == library.encode(text or "", add_special_tokens=False).ids, (turn, text)
    assert len(pieces.known) <= 700


def test_equal_hashes_are_told_apart_by_text(monkeypatch):
    monkeypatch.setattr(subwords, "hashed", lambda pieces: pc_length(pieces))
    pieces, library = Pieces(WORDS), Tokenizer.from_str(WORDS)
    texts = ["one two six ten", "two six one, zwei", "ten ten two"]
    for _ in range(2):
        ids, bounds = pieces.encode(pa.array(texts))
        assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def pc_length(pieces):
    import numpy as np
    import pyarrow.compute as pc

    return pc.binary_length(pieces).to_numpy().astype(np.uint64)


def test_other_tokenizers_keep_case_and_space():
    assert drops_space_and_case(WORDS)
    assert not drops_space_and_case(WORDS.replace("<|endoftext|>", "<|EndOfText|>"))
    assert not drops_space_and_case(Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")).to_str())
