"""What a worker keeps of the transducer from one task to the next."""

import tracemalloc

import numpy as np
import public_tokenizers

from tableprep.llm import bpe

RANKS = bpe.parse_ranks(bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")))


def odd_words(n):
    rng = np.random.default_rng(5)
    return [b" " + bytes(rng.integers(97, 123, rng.integers(4, 12), dtype=np.uint8)) for _ in range(n)]


def test_states_are_small():
    machine, words = bpe.Transducer(RANKS), odd_words(4_000)
    for word in words[:500]:  # the vocabulary's own tables
        machine.encode(word)
    before = len(machine.states)
    tracemalloc.start()
    for word in words[500:]:
        machine.encode(word)
    held, _ = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    made = len(machine.states) - before
    assert made > 5_000
    assert held < 650 * made


def test_forgetting_within_a_word_changes_nothing():
    small, large = bpe.Transducer(RANKS, most_states=7), bpe.Transducer(RANKS)
    for word in odd_words(1_000) + [b"x" * 300, bytes(range(256)) * 2, "é€😀".encode() * 9]:
        assert small.encode(word) == large.encode(word)
        kept = len(small.states)
        assert kept <= 7
