"""Words of whole texts: SQL expressions, and vectors over the bytes of one Arrow batch.

Words are runs of code points other than U+0020 and U+0009 to U+000D. A null text has no words.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, functions as F

SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Bytes of text that one vector step handles, so that memory follows neither the batch nor the table.
CHUNK_BYTES = 1 << 20

_U = np.uint64
_STEP = _U(0x9E3779B97F4A7C15)
_BASE = _U(0xD6E8FEB86659FD93)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind an expression once for a body that uses it often, also inside lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def text_or_empty() -> Column:
    return F.coalesce(F.col("text"), F.lit(""))


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values so that every bit depends on every other."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LETTER = mix(np.arange(1, 257, dtype=_U) * _STEP)
_LETTER[65:91] = _LETTER[97:123]  # A-Z count as a-z


class _Powers:
    """Powers of the hash base and of its inverse, up to the longest text seen."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(0, _U)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            n = max(n, CHUNK_BYTES)
            inverse = _U(pow(int(_BASE), -1, 1 << 64))
            self.up, self.down = (np.cumprod(np.concatenate([[_U(1)], np.full(n - 1, b, _U)])) for b in (_BASE, inverse))
        return self.up, self.down


_powers = _Powers()


class Words:
    """Where the words of several texts begin and end in their joined bytes, and a hash of each."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray) -> None:
        self.data, self.offsets = data, offsets
        n = len(data)
        space = _SPACE[data]
        edge = np.zeros(n + 1, bool)
        edge[offsets] = True
        before, after = np.ones(n, bool), np.ones(n, bool)
        before[1:], after[:-1] = space[:-1], space[1:]
        self.starts = np.flatnonzero(~space & (before | edge[:-1]))
        self.ends = np.flatnonzero(~space & (after | edge[1:])) + 1
        self.first = np.searchsorted(self.starts, offsets)  # of each text, and one more
        self.text = np.repeat(np.arange(len(offsets) - 1), np.diff(self.first))

    def hashes(self) -> np.ndarray:
        """64 bits for each word, capital A-Z taken as small."""
        up, down = _powers.upto(len(self.data))
        sums = np.zeros(len(self.data) + 1, _U)
        np.cumsum(_LETTER[self.data] * up[: len(self.data)], out=sums[1:])
        return mix((sums[self.ends] - sums[self.starts]) * down[self.starts] + (self.ends - self.starts).astype(_U) * _STEP)


def slices(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Parts of a string column as (first row, end row, bytes, offsets); a null text is empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    if len(texts) == 0:
        return
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(texts):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + CHUNK_BYTES, "right")) - 1)
        yield row, end, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))
