"""Pack token ids into rows of a fixed length: best fit decreasing with a segment tree over capacities.

A document longer than a row is split into full rows and a rest, losslessly: pieces carry their offset. Pieces
are packed longest first, each into the row whose free space fits it best; a segment tree over free
capacities finds that row in logarithmic time. A task packs what it reads in lots of bounded size, so
texts are not shuffled and memory does not follow the table; each lot leaves one or two open rows.

One result row is one packed row: ids (little-endian unsigned 16-bit, zero after the last), position ids that
restart with each piece, cumulative segment lengths, and the pieces' doc_ids and offsets. Documents without
tokens (null or empty text) fill no row. Repeated rows are packed each; a null doc_id stays null. An
empty table gives no rows. Which pieces meet in a row depends on how Spark splits its input, the ids do not.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tierlake.llm import text as T

LENGTH = 2048
LOT = 4 << 20  # tokens that are packed together
FIRST_BYTE = 3  # ids 0 to 2 are left to padding and marks; a byte b is id b + 3


class Capacities:
    """How many open rows have each free capacity, in a segment tree of counts."""

    def __init__(self, most: int) -> None:
        self.leaves = 1 << most.bit_length()
        self.count = [0] * (2 * self.leaves)

    def add(self, capacity: int, by: int) -> None:
        node = self.leaves + capacity
        while node:
            self.count[node] += by
            node >>= 1

    def least_from(self, capacity: int) -> int | None:
        """The smallest free capacity of at least ``capacity``."""
        node = self.leaves + capacity
        if not self.count[node]:
            while node > 1 and (node & 1 or not self.count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if self.count[2 * node] else 2 * node + 1
        return node - self.leaves


def best_fit_decreasing(sizes: list[int], length: int) -> list[list[int]]:
    """Rows as lists of piece numbers; every size is from 1 to ``length``."""
    tree, open_rows, rows = Capacities(length), defaultdict(list), []
    for piece in sorted(range(len(sizes)), key=lambda k: (-sizes[k], k)):
        size = sizes[piece]
        free = tree.least_from(size)
        if free is None:
            row, free = len(rows), length
            rows.append([])
        else:
            row = open_rows[free].pop()
            tree.add(free, -1)
        rows[row].append(piece)
        if free > size:
            open_rows[free - size].append(row)
            tree.add(free - size, 1)
    return rows


PACKED = (
    "n_tokens int, doc_ids array<bigint>, offsets array<int>, cu_seqlens array<int>, ids binary, position_ids binary"
)


def _packed(batches: Iterator[pa.RecordBatch], length: int, lot: int) -> Iterator[pa.RecordBatch]:
    pieces: list[tuple[int | None, int, np.ndarray]] = []
    tokens = 0
    for batch in batches:
        owners = T.column(batch, "doc_id").to_pylist()
        for row, end, data, offsets in T.slices(T.column(batch, "text")):
            ids = data.astype("<u2") + np.uint16(FIRST_BYTE)
            for owner, a, b in zip(owners[row:end], offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                pieces += [(owner, at - a, ids[at : min(at + length, b)]) for at in range(a, b, length)]
                tokens += b - a
            if tokens >= lot:
                yield _rows(pieces, length)
                pieces, tokens = [], 0
    if pieces:
        yield _rows(pieces, length)


def _rows(pieces: list[tuple[int | None, int, np.ndarray]], length: int) -> pa.RecordBatch:
    columns: list[list] = [[] for _ in range(6)]
    for row in best_fit_decreasing([len(p[2]) for p in pieces], length):
        own = [pieces[k] for k in row]
        ends = np.cumsum([len(p[2]) for p in own])
        ids, positions = np.zeros(length, "<u2"), np.zeros(length, "<u2")
        ids[: ends[-1]] = np.concatenate([p[2] for p in own])
        positions[: ends[-1]] = np.concatenate([np.arange(len(p[2]), dtype="<u2") for p in own])
        row_values = (ends[-1], [p[0] for p in own], [p[1] for p in own], [0, *ends.tolist()], ids.tobytes(), positions.tobytes())
        for column, value in zip(columns, row_values, strict=True):
            column.append(value)
    kinds = [pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.binary(), pa.binary()]
    names = ["n_tokens", "doc_ids", "offsets", "cu_seqlens", "ids", "position_ids"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def pack_documents(docs: DataFrame, length: int = LENGTH, lot: int = LOT) -> DataFrame:
    """Packed rows of the byte ids of every document; ``length`` up to 65,536."""
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(lambda batches: _packed(batches, length, lot), PACKED)
