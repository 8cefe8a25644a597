"""The tokenization automaton against plain merging, its bounded tables, and the library's Unicode classes."""

from __future__ import annotations

import random

import numpy as np
import pytest

from tierlake.llm import bpe_automaton, queries


def merged(word: str, merges: list[tuple[str, str]]) -> list[str]:
    """Plain merging: the first rule that applies anywhere, at its leftmost places, until none does."""
    parts = list(word)
    while True:
        rules = [m for m in merges if m in set(zip(parts, parts[1:], strict=False))]
        if not rules:
            return parts
        u, v = rules[0]
        out, k = [], 0
        while k < len(parts):
            both = parts[k : k + 2] == [u, v]
            out.append(u + v if both else parts[k])
            k += 2 if both else 1
        parts = out


def random_merges(rng: random.Random, letters: str, count: int) -> list[tuple[str, str]]:
    known, merges = list(letters), []
    while len(merges) < count:
        u, v = rng.choice(known), rng.choice(known)
        if u + v not in known:
            merges.append((u, v))
            known.append(u + v)
    return merges


@pytest.mark.parametrize("kept", [50_000, 3])
def test_transitions_give_plain_merging(monkeypatch, kept):
    """Also when the table forgets its states all the time."""
    monkeypatch.setattr(bpe_automaton, "KEPT_STATES", kept)
    rng = random.Random(11)
    for _ in range(25):
        merges = random_merges(rng, "abc", rng.randint(1, 12))
        vocabulary = {t: k for k, t in enumerate([*"abc", *(u + v for u, v in merges)])}
        automaton = bpe_automaton.Automaton(vocabulary, merges)
        for _ in range(60):
            word = "".join(rng.choices("abc", [3, 2, 1], k=rng.randint(1, 25)))
            assert automaton.encode(list(word)) == [vocabulary[t] for t in merged(word, merges)]
        assert len(automaton.places) <= kept
    with pytest.raises(ValueError):
        automaton.encode(["z"])


def test_every_code_point_is_encoded_as_by_the_library():
    from tokenizers import Tokenizer

    library, mine = Tokenizer.from_file(queries.WORD_BPE), bpe_automaton.Tokenizer(queries.WORD_BPE)
    chars = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    # Each alone, and between a letter, a number and a sign, in texts of 64 code points.
    for join in (" ", "a", "7x!"):
        for at in range(0, len(chars), 64):
            text = join.join(chars[at : at + 64])
            ids = library.encode(text, add_special_tokens=False).ids
            assert np.frombuffer(mine.encode(text), "<u4").tolist() == ids, hex(at)
