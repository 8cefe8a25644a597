"""Alignment of two tokenizers over whole texts, and how often their ids are linked in the corpus.

Both tokenizers spell a text's bytes (a space and the text). Each id list gives cumulative ends; a dictionary
from end to index, probed with the other list's ends in order, intersects them, and the sorted common ends slice both lists into
groups: the smallest runs of tokens that cover the same bytes. Tokens of a group are linked, all of one side with
all of the other. An id pair's count is the number of documents of the corpus that link it at least once.

1. Tasks encode and align, one row for each document, written once to the shared folder: counts, the groups' digest
   and the document's distinct id pairs with how often each is linked.
2. Counts: tasks add up the pairs of a batch, one aggregate with map-side combine adds the rest. The best count of
   an A id comes from the same table.
3. Pair counts come back to the documents. While the table has at most ``MAX_SENT`` pairs (16 bytes each) it is
   sent to all tasks; beyond that the documents' pairs are joined with it, hot pairs split over tasks, and
   added up per row. Both ways give equal results.

A text that is null or empty, or whose tokens of either side spell other bytes than a space and the text, has no
tokens: zeros and an empty digest. Strings of special tokens inside of texts are plain text. Rows are documents:
repeated rows count each, a null doc_id passes. An empty table gives no rows. Texts are encoded whole; the links of a large
group are counted by distinct ids, so memory follows the tokens and distinct pairs of a document. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tierlake import scratch
from tierlake.llm import text as T
from tierlake.llm.bpe_automaton import byte_letters
from tierlake.operators.joins import spread_left_join

MAX_SENT = 2_000_000
# Pairs that a task adds up before it hands them on, and the share of texts that it holds as strings.
HELD_PAIRS, TEXTS = 400_000, 64
B_SHIFT = 32
LARGE_GROUP = 1 << 16  # pairs of a group that are expanded one by one
LONG_WORD = 1000


class ByteTokenizer:
    """Ids and their bytes of a byte-level tokenizer file; special tokens of texts are plain text.

    Where the file's merges stand in the order of their ids, the ranked encoder gives the same ids in a fifth of the time
    (a test compares them on every code point). It is quadratic in the longest word, so texts with long ones, and other
    files, go to the library of the file format.
    """

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            self.spec = file.read()

    @cached_property
    def _library(self):
        from tokenizers import Tokenizer

        library = Tokenizer.from_str(self.spec)
        library.encode_special_tokens = True
        library.no_truncation()
        library.no_padding()
        return library

    @cached_property
    def _ranked(self):
        import public_tokenizers
        import tiktoken

        spec = json.loads(self.spec)
        vocabulary, byte = spec["model"]["vocab"], byte_values()
        merges = [m.replace(" ", "", 1) if isinstance(m, str) else "".join(m) for m in spec["model"]["merges"]]
        split = spec["pre_tokenizer"] or {}
        plain = split.get("type") == "ByteLevel" and split.get("use_regex") and not split.get("add_prefix_space") and not spec["normalizer"]
        if not plain or [vocabulary[m] for m in merges] != list(range(256, 256 + len(merges))):
            return None
        ranks = {bytes(byte[c] for c in label): i for label, i in vocabulary.items() if i < 256 + len(merges)}
        return tiktoken.Encoding("bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    @cached_property
    def spelling(self) -> list[bytes]:
        byte, vocabulary = byte_values(), json.loads(self.spec)["model"]["vocab"]
        out = [b""] * (max(vocabulary.values()) + 1)
        for label, token in vocabulary.items():
            # Labels outside of the byte alphabet are special tokens, which texts never get.
            out[token] = bytes(byte[c] for c in label) if all(c in byte for c in label) else label.encode()
        return out

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [self._one(" " + text) for text in texts]

    def _one(self, text: str) -> list[int]:
        words = text.split()
        longest = max(map(len, words), default=0)
        if self._ranked is not None and longest <= LONG_WORD and len(text) - sum(map(len, words)) - len(words) <= LONG_WORD:
            return self._ranked.encode_ordinary(text)
        return self._library.encode(text, add_special_tokens=False).ids

    def __getstate__(self) -> dict:
        return {"spec": self.spec}


def byte_values() -> dict[str, int]:
    return {letter: b for b, letter in enumerate(byte_letters())}


class PieceTokenizer:
    """Ids and their bytes of a piece model, which puts the space before the text itself."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as file:
            self.model = file.read()

    @cached_property
    def _library(self):
        import sentencepiece

        return sentencepiece.SentencePieceProcessor(model_proto=self.model)

    @cached_property
    def spelling(self) -> list[bytes]:
        library = self._library
        return [
            bytes([int(library.id_to_piece(i)[3:5], 16)]) if library.is_byte(i) else library.id_to_piece(i).replace("▁", " ").encode()
            for i in range(library.get_piece_size())
        ]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self._library.encode(texts, num_threads=1)

    def __getstate__(self) -> dict:
        return {"model": self.model}


@dataclass
class Groups:
    """Two id lists and where their groups begin; the last entries are the lists' lengths."""

    a: np.ndarray
    b: np.ndarray
    cuts_a: np.ndarray
    cuts_b: np.ndarray

    def __len__(self) -> int:
        return len(self.cuts_a) - 1

    def slices(self) -> Iterator[tuple[list[int], list[int]]]:
        for k in range(len(self)):
            yield self.a[self.cuts_a[k] : self.cuts_a[k + 1]].tolist(), self.b[self.cuts_b[k] : self.cuts_b[k + 1]].tolist()


def align(a: np.ndarray, b: np.ndarray, a_sizes: np.ndarray, b_sizes: np.ndarray) -> Groups:
    """Groups of two id lists that spell the same bytes; sizes are the bytes of each token (at least 1)."""
    ends_a, ends_b = (np.cumsum(sizes).tolist() for sizes in (a_sizes, b_sizes))
    at_b = dict(zip(ends_b, range(1, len(ends_b) + 1), strict=True))
    # The place of each end of A is its index there; asked for in order, the common ends come out sorted.
    found = np.fromiter(map(at_b.get, ends_a, repeat(0)), np.int64, len(ends_a))
    common = np.flatnonzero(found)
    cuts = [np.zeros(len(common) + 1, np.int64) for _ in range(2)]
    cuts[0][1:], cuts[1][1:] = common + 1, found[common]
    return Groups(a, b, *cuts)


def links(groups: Groups) -> tuple[np.ndarray, np.ndarray]:
    """Distinct linked id pairs (a << 32 | b, ascending) and how often each is linked.

    The pairs of a group are expanded; those of a large one are counted by the distinct ids of its sides, then multiplied.
    """
    n_a, n_b = np.diff(groups.cuts_a), np.diff(groups.cuts_b)
    large = np.flatnonzero(n_a * n_b > LARGE_GROUP)
    n = n_a * n_b
    n[large] = 0
    group = np.repeat(np.arange(len(groups)), n)
    place = np.arange(len(group)) - np.repeat(np.cumsum(n) - n, n)
    i = groups.cuts_a[group] + place // n_b[group]
    j = groups.cuts_b[group] + place % n_b[group]
    pairs, times = np.unique(groups.a[i] << B_SHIFT | groups.b[j], return_counts=True)
    if len(large):
        found = Counter(dict(zip(pairs.tolist(), times.tolist(), strict=True)))
        for k in large:
            own, other = (np.unique(x[c[k] : c[k + 1]], return_counts=True) for x, c in ((groups.a, groups.cuts_a), (groups.b, groups.cuts_b)))
            for x, m in zip(*map(np.ndarray.tolist, own), strict=True):
                for y, o in zip(*map(np.ndarray.tolist, other), strict=True):
                    found[x << B_SHIFT | y] += m * o
        pairs = np.array(sorted(found), np.int64)
        times = np.array([found[p] for p in pairs.tolist()], np.int64)
    return pairs, times


class Numerals:
    """Decimal ids of a vocabulary with the sign that follows them within and at the end of a group."""

    def __init__(self, size: int, end: str) -> None:
        self.within = np.array([f"{k}," for k in range(size)], object)
        self.end = np.array([f"{k}{end}" for k in range(size)], object)


def written(groups: Groups, of_a: Numerals, of_b: Numerals) -> str:
    """``a1,a2|b1;a3|b2,b3``: each id goes to its place in the merged list, behind the other list's earlier groups."""
    if not len(groups):
        return ""
    n_a, n_b = np.diff(groups.cuts_a), np.diff(groups.cuts_b)
    out = np.empty(len(groups.a) + len(groups.b), object)
    for ids, cuts, before, numerals in ((groups.a, groups.cuts_a, groups.cuts_b[:-1], of_a), (groups.b, groups.cuts_b, groups.cuts_a[1:], of_b)):
        places = np.arange(len(ids)) + np.repeat(before, n_a if numerals is of_a else n_b)
        signs = numerals.within[ids]
        signs[cuts[1:] - 1] = numerals.end[ids[cuts[1:] - 1]]
        out[places] = signs
    return "".join(out.tolist())[:-1]


@dataclass
class Aligned:
    n_a: int = 0
    n_b: int = 0
    n_groups: int = 0
    n_links: int = 0
    digest: str = ""
    pairs: bytes = b""  # a << 32 | b of each distinct pair, little-endian 64-bit, ascending
    times: bytes = b""  # how often each is linked, the same way


class Aligner:
    """Aligns texts with two tokenizers; tables are built once in each worker."""

    def __init__(self, one: ByteTokenizer, other: PieceTokenizer) -> None:
        self.one, self.other = one, other

    @cached_property
    def _numerals(self) -> tuple[Numerals, Numerals]:
        return Numerals(len(self.one.spelling), "|"), Numerals(len(self.other.spelling), ";")

    @cached_property
    def _sizes(self) -> tuple[np.ndarray, np.ndarray]:
        return tuple(np.array(list(map(len, t.spelling)), np.int64) for t in (self.one, self.other))

    def __getstate__(self) -> dict:
        return {"one": self.one, "other": self.other}

    def align(self, texts: list[str]) -> list[Aligned]:
        return [self._aligned(*row) for row in zip(texts, self.one.encode(texts), self.other.encode(texts), strict=True)]

    def _aligned(self, text: str, a: list[int], b: list[int]) -> Aligned:
        whole = (" " + text).encode()
        if not text or any(b"".join(map(t.spelling.__getitem__, ids)) != whole for t, ids in ((self.one, a), (self.other, b))):
            return Aligned()
        ids_a, ids_b = np.array(a, np.int64), np.array(b, np.int64)
        groups = align(ids_a, ids_b, self._sizes[0][ids_a], self._sizes[1][ids_b])
        pairs, times = links(groups)
        digest = hashlib.sha256(written(groups, *self._numerals).encode()).hexdigest()
        return Aligned(len(a), len(b), len(groups), int(times.sum()), digest, pairs.astype("<i8").tobytes(), times.astype("<i8").tobytes())


ALIGNED = (
    "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, pairs binary, times binary"
)
REPORT = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"


def align_documents(docs: DataFrame, byte_path: str, piece_path: str) -> DataFrame:
    """One row for each document: counts, digest of the groups, and the distinct linked pairs with how often."""
    sent = docs.sparkSession.sparkContext.broadcast(Aligner(ByteTokenizer(byte_path), PieceTokenizer(piece_path)))

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = sent.value
        for batch in batches:
            ids, texts = T.column(batch, "doc_id"), T.column(batch, "text")
            for at in range(0, len(texts), TEXTS):
                rows = aligner.align([x or "" for x in texts.slice(at, TEXTS).to_pylist()])
                numbers = [pa.array([getattr(r, name) for r in rows], pa.int64()) for name in ("n_a", "n_b", "n_groups", "n_links")]
                rest = [pa.array([r.digest for r in rows], pa.string())]
                rest += [pa.array([getattr(r, name) for r in rows], pa.binary()) for name in ("pairs", "times")]
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(at, TEXTS), *numbers, *rest],
                    ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"],
                )

    given = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return given.mapInArrow(found, ALIGNED)


def _values(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All 64-bit values of a binary column, and how many each row has."""
    parts = [np.frombuffer(x, "<i8") for x in column.to_pylist()]
    return np.concatenate([*parts, np.zeros(0, "<i8")]), np.array([len(p) for p in parts], np.int64)


def pair_counts(found: DataFrame) -> DataFrame:
    """(pair, docs) of every linked id pair: in how many documents of ``align_documents`` it occurs."""

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def summed() -> pa.RecordBatch:
            pairs, docs = np.unique(np.concatenate([*held, np.zeros(0, np.int64)]), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(pairs, pa.int64()), pa.array(docs, pa.int64())], ["pair", "docs"])

        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                values, _ = _values(T.column(batch, "pairs").slice(at, TEXTS))
                held.append(values)
                size += len(values)
                if size >= HELD_PAIRS:
                    yield summed()
                    held, size = [], 0
        yield summed()

    some = found.select("pairs").mapInArrow(added, "pair bigint, docs bigint")
    return some.groupBy("pair").agg(F.sum("docs").alias("docs"))


def _with_best(counts: DataFrame) -> DataFrame:
    """(pair, docs, best): does no other pair of the A id have more documents? An A id has one row per B id at most."""
    a = F.shiftright("pair", B_SHIFT)
    most = counts.groupBy(a.alias("a")).agg(F.max("docs").alias("most"))
    return counts.withColumn("a", a).join(most, "a").select("pair", "docs", (F.col("docs") == F.col("most")).alias("best"))


def _report_by_lookup(found: DataFrame, counts: DataFrame) -> DataFrame:
    """Look pairs up in a table that every task holds."""
    rows = counts.toArrow()
    order = np.argsort(pairs := rows["pair"].to_numpy())
    table = pairs[order], rows["docs"].to_numpy()[order], rows["best"].to_numpy()[order]
    sent = found.sparkSession.sparkContext.broadcast(table)

    def looked_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, docs, best = sent.value
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                part = batch.slice(at, TEXTS)
                values, sizes = _values(T.column(part, "pairs"))
                times, _ = _values(T.column(part, "times"))
                place = np.searchsorted(known, values)
                upto = np.concatenate([[0], np.cumsum(sizes)])
                sums = [np.concatenate([[0], np.cumsum(x)]) for x in (times * best[place], times * docs[place])]
                sums = [pa.array(s[upto[1:]] - s[upto[:-1]], pa.int64()) for s in sums]
                own = {name: T.column(part, name) for name in part.schema.names}
                own |= {"n_best": sums[0], "count_sum": sums[1]}
                names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
                yield pa.RecordBatch.from_arrays([own[n] for n in names], names)

    return found.mapInArrow(looked_up, REPORT)


def _report_by_join(found: DataFrame, counts: DataFrame) -> DataFrame:
    """Join the documents' pairs with their counts, then add up per row."""
    keyed = scratch.stored(found.withColumn("row", F.monotonically_increasing_id()), "aligned")

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                part = batch.slice(at, TEXTS)
                values, sizes = _values(T.column(part, "pairs"))
                times, _ = _values(T.column(part, "times"))
                row = np.repeat(T.column(part, "row").to_numpy(), sizes)
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (row, values, times)], ["row", "pair", "n"])

    own = keyed.select("row", "pairs", "times").mapInArrow(spread, "row bigint, pair bigint, n bigint")
    both = spread_left_join(own, counts, "pair", ["row"])
    sums = both.groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("n_best"), F.sum(F.col("n") * F.col("docs")).alias("count_sum")
    )
    whole = keyed.drop("pairs", "times").join(sums, "row", "left")
    zeros = {name: F.coalesce(name, F.lit(0)) for name in ("n_best", "count_sum")}
    return whole.withColumns(zeros).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def alignment_report(docs: DataFrame, byte_path: str, piece_path: str, max_sent: int = MAX_SENT) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every document."""
    found = scratch.stored(align_documents(docs, byte_path, piece_path), "aligned")
    counts = scratch.stored(_with_best(pair_counts(found)), "pairs")
    report = _report_by_lookup if counts.count() <= max_sent else _report_by_join
    return report(found, counts)
