"""The secret scan's field: every token of a text is read, and the fast search gives the plain one's labels."""

from __future__ import annotations

import random

import numpy as np

from tierlake.llm import secret_scan

WORDS = ["the", "token", "=", "password", "is", "a1b2c3d4e5f6", "Zx9QwErTy12", ":", "harbour", "äpfel", "中文", "-", "sk_live_9f8e7d", "'", "☃", "12", "x" * 70]


def field_of(rng: random.Random, spread: float) -> secret_scan.Field:
    """A field that was fitted a little and then shaken, so that no label is rare."""
    some = [[rng.choice(WORDS[:-3]) for _ in range(12)] for _ in range(30)]
    told = [[0 if len(w) > 10 else 2 for w in words] for words in some]
    field = secret_scan.fit([(secret_scan.features(words, 5), tags) for words, tags in zip(some, told, strict=True)])
    noise = np.random.default_rng(rng.randrange(1000))
    field.emit[1:] += noise.normal(0, spread, field.emit[1:].shape)
    field.move += np.where(field.move < -1e8, 0, noise.normal(0, spread, field.move.shape))
    return field


def test_no_part_of_a_text_is_left_out():
    words = ["the", "crocodile", "sat"]
    field = secret_scan.fit([(secret_scan.features(words, 0), [2, 0, 2])] * 4)
    assert secret_scan.stretches("the crocodile sat") == ([], 0)
    assert secret_scan.spans_of("the crocodile sat", field) == [("crf", 4, 13)]


def test_labels_are_those_of_the_plain_search(monkeypatch):
    rng = random.Random(3)
    for spread in (0.1, 1.0, 3.0):
        field = field_of(rng, spread)
        texts = [rng.choice([" ", "", "\n"]).join(rng.choice(WORDS) for _ in range(rng.choice([0, 1, 2, 5, 60, 300]))) for _ in range(60)]
        for part, at_once in ((1_000_000, 65_536), (7, 5)):
            monkeypatch.setattr(secret_scan, "PART", part)
            monkeypatch.setattr(secret_scan, "TOKENS_AT_ONCE", at_once)
            for text, tags in zip(texts, secret_scan._Weights(field).tags(texts), strict=True):
                tokens = secret_scan.TOKEN.findall(text)
                plain = field.tags(tokens, secret_scan.stretches(text)[1]) if tokens else []
                assert [tags.get(i, 2) for i in range(len(tokens))] == plain
