"""Word-piece token counts by a linear longest-match automaton.

The vocabulary is a trie; every node has a failure link to the node where matching goes on when no child
fits, and the number of tokens that the greedy longest match has finished by then. One pass over a
word's bytes, without stepping back and without building a piece, gives its number of tokens.

Pieces that start with a space begin a word, the others continue one, as in byte-level vocabularies; all
single bytes are pieces, so nothing is unknown (a vocabulary without them counts a word that gets stuck
as one token). Words are runs of code points other than U+0020 and U+0009 to U+000D. Null and empty texts
count 0. Rows are independent: repeated rows give equal results; extra columns are ignored; an empty
table gives no rows; texts are read whole. The vocabulary is read on the driver and sent to tasks once.
"""

from __future__ import annotations

import json
import re
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tierlake.llm import text as T
from tierlake.llm.bpe_automaton import byte_letters

KEPT_WORDS = 120_000
_WORD = re.compile(T.WORD)


def pieces_of(path: str) -> list[bytes]:
    """The pieces of a byte-level tokenizer file as bytes."""
    with open(path, encoding="utf-8") as file:
        vocabulary = json.load(file)["model"]["vocab"]
    byte_of = {letter: b for b, letter in enumerate(byte_letters())}
    return [bytes(byte_of[c] for c in label) for label in vocabulary if all(c in byte_of for c in label)]


class LongestMatch:
    """Trie with failure links and counts of finished tokens."""

    def __init__(self, pieces: list[bytes]) -> None:
        # Node 0 begins a word, node 1 continues it.
        self.children: list[dict[int, int]] = [{}, {}]
        final = [False, False]
        for piece in pieces:
            at = 0 if piece[:1] == b" " else 1
            for byte in piece:
                if byte not in self.children[at]:
                    self.children[at][byte] = len(final)
                    self.children.append({})
                    final.append(False)
                at = self.children[at][byte]
            final[at] = True
        self.fail, self.done = [-1] * len(final), [0] * len(final)
        queue = deque([0, 1])
        while queue:
            parent = queue.popleft()
            for byte, node in self.children[parent].items():
                if final[node]:
                    self.fail[node], self.done[node] = 1, 1
                else:
                    at, done = self.fail[parent], self.done[parent]
                    while at >= 0 and byte not in self.children[at]:
                        done += self.done[at]
                        at = self.fail[at]
                    if at >= 0:
                        self.fail[node], self.done[node] = self.children[at][byte], done
                queue.append(node)
        self._known: dict[str, int] = {}

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_known": {}}

    def count(self, word: bytes) -> int:
        """Tokens of a word, which starts with a space."""
        at, tokens, children, fail, done = 0, 0, self.children, self.fail, self.done
        for byte in word:
            while (to := children[at].get(byte)) is None:
                if fail[at] < 0:
                    return 1
                tokens += done[at]
                at = fail[at]
            at = to
        while at != 1:
            if fail[at] < 0:
                return 1
            tokens += done[at]
            at = fail[at]
        return tokens

    def counts(self, text: str) -> tuple[int, int]:
        """Words and tokens of a text."""
        known, total, words = self._known, 0, _WORD.findall(text)
        for word in words:
            n = known.get(word)
            if n is None:
                n = self.count(b" " + word.encode())
                if len(known) >= KEPT_WORDS:
                    known.clear()
                if len(word) <= 64:
                    known[word] = n
            total += n
        return len(words), total


def count_tokens(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_words, n_tokens) of every document."""
    sent = docs.sparkSession.sparkContext.broadcast(LongestMatch(pieces_of(path)))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = T.column(batch, "text")
            found = [sent.value.counts(x or "") for at in range(0, len(texts), 64) for x in texts.slice(at, 64).to_pylist()]
            columns = [pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([T.column(batch, "doc_id"), *columns], ["doc_id", "n_words", "n_tokens"])

    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(counted, "doc_id bigint, n_words bigint, n_tokens bigint")
