"""Token ids put together from words and pieces are those of the library for the whole text."""

from __future__ import annotations

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from tableprep.llm import token_files, toxicity

PATH = public_tokenizers.path("word_bpe_49k.json")
WHOLE = Tokenizer.from_file(PATH)
PARTS = ["'", "s", "T", "re", "LL", " ", "\t", "<|", "|>", "<|endoftext|>", "9", "\x00", "\x1c", "\x85", "\xa0", "é", "É", "ß",
         "÷", "²", "ª", "é", "́", "日", "-", "_", "İ", "Σ", "word,"]


def ids_of(words: token_files._Words, string: str) -> list[int]:
    split = string.encode().split()
    words.learn(set(split))
    return np.frombuffer(b"".join(map(words.known.__getitem__, split)), dtype=np.uint32).tolist()


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=15).map("".join))
def test_words_are_encoded_as_whole_texts(string):
    expected = WHOLE.encode(string, add_special_tokens=False).ids if string else []
    assert ids_of(token_files._words(PATH), string) == expected


def test_words_survive_a_full_memory(monkeypatch):
    monkeypatch.setattr(token_files, "MOST_WORDS", 3)
    words = token_files._Words(PATH)
    for string in ["a b c", "c d e", "a f c", "a1 b2 c3 d4 e5", "a", "a b c d e f g h"]:
        assert ids_of(words, string) == WHOLE.encode(string, add_special_tokens=False).ids


@pytest.mark.parametrize("size", [0, 1, toxicity.PIECE - 2, toxicity.PIECE, 3 * toxicity.PIECE + 1])
def test_features_of_long_texts_lose_nothing(size):
    data = bytes(np.random.default_rng(7).integers(97, 123, size, dtype=np.uint8))
    room = np.zeros(1 << toxicity.BITS, dtype=np.int64)
    whole = toxicity._buckets(b" " + data + b" ", room)
    found = toxicity.features(data, room)
    assert len(set(found)) == len(found) and set(found) == set(whole)
