"""Aligned tokenizers against a plain version that compares all byte ranges."""

from __future__ import annotations

import collections
import hashlib
import itertools
import json
import random

import numpy as np
import pytest

from tierlake.llm import queries, token_alignment as A

SCHEMA = "doc_id bigint, text string, pairs string, n_a string"


def texts() -> list[str | None]:
    rng = random.Random(12)
    words = ["the", "of", "über", "naïve", "x", "tokenization", "你好", "🙂🙂", "a1b2", "…", "ﬁ", "  ", "\n", "\t", "'s", "<s>", "<|endoftext|>"]
    mixed = [" ".join(rng.choices(words, k=rng.randint(1, 30))) for _ in range(40)]
    mixed += ["".join(rng.choices("aeiou bcd▁é🙂\r\n\x00", k=rng.randint(1, 25))) for _ in range(40)]
    return [None, "", " ", "   ", "\n", "a", "▁", "a▁b", " lead", "x" * 3000, "word " * 5000, *mixed, mixed[0]]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k, t, "p", "n") for k, t in enumerate(texts())]
    rows += [rows[20], (None, "the same words of the text", None, None), (None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def plain(given: list[tuple]) -> collections.Counter:
    """Every document by comparing the byte ranges of all tokens with the cuts."""
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    one, other = Tokenizer.from_file(queries.BYTE_PIECES), SentencePieceProcessor(model_file=queries.PIECES)
    one.encode_special_tokens = True
    vocabulary = {i: t for t, i in json.load(open(queries.BYTE_PIECES, encoding="utf-8"))["model"]["vocab"].items()}
    letters = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {**{chr(b): b for b in letters}, **{chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in letters)}}
    documents = []
    for doc_id, text in given:
        whole = (" " + (text or "")).encode()
        a = one.encode(" " + text, add_special_tokens=False).ids if text else []
        b = other.encode(text) if text else []
        spell_a = [bytes(letters[c] for c in vocabulary[i]) for i in a]
        pieces = [other.id_to_piece(i) for i in b]
        spell_b = [bytes([int(p[3:5], 16)]) if other.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b, pieces, strict=True)]
        if not text or b"".join(spell_a) != whole or b"".join(spell_b) != whole:
            documents.append((doc_id, [], [], [], []))
            continue
        ends = []
        for spelled in (spell_a, spell_b):
            ends.append(list(itertools.accumulate(map(len, spelled))))
        cuts = sorted(set(ends[0]) & set(ends[1]))
        groups, i, j = [], 0, 0
        for cut in cuts:
            own = ([], [])
            while i < len(a) and ends[0][i] <= cut:
                own[0].append(a[i])
                i += 1
            while j < len(b) and ends[1][j] <= cut:
                own[1].append(b[j])
                j += 1
            groups.append(own)
        documents.append((doc_id, a, b, groups, [(x, y) for xs, ys in groups for x in xs for y in ys]))
    count = collections.Counter(p for *_, links in documents for p in set(links))
    most = collections.defaultdict(int)
    for (x, _), n in count.items():
        most[x] = max(most[x], n)
    return collections.Counter(
        (
            doc_id, len(a), len(b), len(groups), len(links), sum(count[p] == most[p[0]] for p in links), sum(count[p] for p in links),
            hashlib.sha256(";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups).encode()).hexdigest() if a else "",
        )
        for doc_id, a, b, groups, links in documents
    )


@pytest.mark.parametrize("max_sent", [A.MAX_SENT, 0])
def test_report_equals_the_plain_version(docs, max_sent):
    found = A.alignment_report(docs, queries.BYTE_PIECES, queries.PIECES, max_sent).collect()
    expected = plain([(r.doc_id, r.text) for r in docs.collect()])
    assert collections.Counter(tuple(r) for r in found) == expected
    assert sum(row[1] > 0 for row in expected) > 60


def test_given_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = queries.op12_token_alignment(spark, sf_dir).collect()
    assert collections.Counter(tuple(r) for r in found) == plain([(r.doc_id, r.text) for r in docs.collect()])


def test_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert A.alignment_report(none, queries.BYTE_PIECES, queries.PIECES).count() == 0
    assert A.alignment_report(none, queries.BYTE_PIECES, queries.PIECES, -1).count() == 0


def test_groups_of_lists_without_common_ends_inside():
    def groups(*lists):
        return list(A.align(*[np.array(x, np.int64) for x in lists]).slices())

    assert groups([1, 2, 3], [4, 5], [1, 1, 2], [3, 1]) == [([1, 2, 3], [4, 5])]
    assert groups([1, 2], [3, 4], [2, 1], [2, 1]) == [([1], [3]), ([2], [4])]
    assert groups([], [], [], []) == []


def test_links_of_large_groups_equal_expanded_ones():
    ones = [7] * 1000 + [8], [9] * 2000 + [7]
    sizes = [1] * 999 + [1001, 1], [1] * 999 + [1] * 1000 + [1, 1]
    large = A.align(*[np.array(x, np.int64) for x in (*ones, *sizes)])
    pairs, times = A.links(large)
    every = collections.Counter(x << 32 | y for xs, ys in large.slices() for x in xs for y in ys)
    assert dict(zip(pairs.tolist(), times.tolist(), strict=True)) == every and sorted(every) == pairs.tolist()


@pytest.mark.parametrize("block", range(0, 0x110000, 0x44000))
def test_ranked_encoder_equals_the_library_on_every_code_point(block):
    tokenizer = A.ByteTokenizer(queries.BYTE_PIECES)
    letters = [chr(c) for c in range(block, block + 0x44000) if not 0xD800 <= c < 0xE000]
    given = [f"ab{x}cd 12{x}34 {x} -{x}- {x}{x}  {x}  e{x}" for x in letters]
    for at in range(0, len(given), 8192):
        own = tokenizer._library.encode_batch_fast(given[at : at + 8192], add_special_tokens=False)
        assert [tokenizer._ranked.encode_ordinary(t) for t in given[at : at + 8192]] == [e.ids for e in own]


def test_long_words_go_to_the_library():
    tokenizer = A.ByteTokenizer(queries.BYTE_PIECES)
    for text in ("ab" * 30_000, " " * 50_000, "a " * 3000, "\n" * 1500 + "x"):
        assert tokenizer.encode([text]) == [tokenizer._library.encode(" " + text, add_special_tokens=False).ids]
