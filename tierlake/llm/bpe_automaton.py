"""Byte-pair encoding and decoding by a tokenization automaton.

The automaton reads tokens: its language is the set of correct tokenizations. It starts as one state that
loops over all base symbols. Each merge (u, v) in turn adds a gadget: a copy of the state behind u that
has lost its v arc, to which all u arcs are led, and a uv arc from every state with a u arc to the state
behind v. All arcs of one token always lead to one state, so a gadget is four numbers: the state it
copies, the arc that the copy lost, when, and the state behind the new token. Whether a state has an
arc follows from these tables in a short walk. A merge whose v arc is missing adds nothing, as the plain
algorithm could never apply it.

Encoding reads symbols. Each arc is spelled out by the trie of its token's symbols, and the automaton of all
places (state, trie node) that a word may have reached is made deterministic as it is used: its transitions
(state, symbol) are kept in a table of bounded size. Every beginning of a word has exactly one accepted
tokenization, so a transition also names the one token that ends at its symbol; the tokens of a word are read
off backwards from its end. Each symbol is one look-up, and nothing is tried twice. Decoding emits the labels
of the arcs, joined by spaces as the public library does for vocabularies without a decoder.

Python's Unicode tables are of other versions than the library's. Where a code point's lower case or class
differs, the library's own normalizer and classes, asked once on the driver for every code point, decide.

Vocabulary and merges come from a tokenizer file read on the driver and sent to tasks once (some
megabytes, bounded by the vocabulary). Null texts count as empty: no tokens, hashes of nothing. Rows are
independent, so repeated rows give equal results; an empty table gives no rows; texts are read whole.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from array import array
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from tierlake.llm import text as T

KEPT_WORDS, KEPT_STATES, KEPT_ARCS = 120_000, 150_000, 500_000
_LOW = (1 << 32) - 1
# A letter, a number and a sign that every version knows, beyond ASCII so that no literal of a pattern names them.
STAND_INS = {"L": "é", "N": "½", "": "§"}


def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: itself if printable, else from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(rest)) for b in range(256)]


def base_symbols(label: str, end: str) -> list[str]:
    """Letters of a token or word; a word end belongs to the last letter."""
    if end and label.endswith(end) and len(label) > len(end):
        cut = len(label) - len(end) - 1
        return [*label[:cut], label[cut:]]
    return list(label)


def _runs(codes: Sequence[int]) -> str:
    """The inside of a character set, as ranges."""
    ordered = np.array(sorted(codes))
    cuts = np.flatnonzero(np.diff(ordered) != 1) + 1
    return "".join(f"\\U{part[0]:08x}-\\U{part[-1]:08x}" for part in np.split(ordered, cuts))


def unicode_departures() -> tuple[dict[str, str], dict[int, str]]:
    """Code points that the library normalises otherwise than Python, with its result; those that it puts in another
    class (letter, number, neither) than ``regex``, with a stand-in of the library's class."""
    from tokenizers import Regex, normalizers, pre_tokenizers

    normal = normalizers.Sequence([normalizers.NFC(), normalizers.Lowercase()])
    outside = {kind: pre_tokenizers.Split(Regex(rf"\p{{{kind}}}+"), "removed") for kind in "LN"}
    known = {kind: regex.compile(rf"\p{{{kind}}}+") for kind in "LN"}
    changed, stand_ins = {}, {}
    for at in range(128, 0x110000, 4096):  # a few at a time, so that the driver holds none of the rest
        text = "".join(chr(c) for c in range(at, min(at + 4096, 0x110000)) if not 0xD800 <= c < 0xE000)
        if not text:
            continue
        lower = normal.normalize_str("\n".join(text)).split("\n")
        changed |= {c: x for c, x in zip(text, lower, strict=True) if x != unicodedata.normalize("NFC", c).lower()}
        theirs, mine = [""] * len(text), [""] * len(text)
        for kind in "LN":
            inside = np.ones(len(text), bool)
            for _, (start, stop) in outside[kind].pre_tokenize_str(text):
                inside[start:stop] = False
            for k in np.flatnonzero(inside).tolist():
                theirs[k] = kind
            for found in known[kind].finditer(text):
                mine[found.start() : found.end()] = [kind] * (found.end() - found.start())
        stand_ins |= {ord(c): STAND_INS[x] for c, x, y in zip(text, theirs, mine, strict=True) if x != y}
    return changed, stand_ins


class Automaton:
    """Gadget tables of all merges over the token ids of ``vocabulary``, and the transitions met so far."""

    def __init__(self, vocabulary: dict[str, int], merges: list[tuple[str, str]], end: str = "") -> None:
        size = max(vocabulary.values(), default=-1) + 1
        self.symbols: dict[str, int] = {}
        # The trie of all tokens over numbered symbols: steps of (node, symbol), tokens that end at nodes, nodes with steps.
        self.steps: dict[int, int] = {}
        self.ends, self.inner = [-1], [False]
        self.length = [0] * size
        self.made, self.left, self.dead = [0] * size, [-1] * size, [False] * size
        for label, token in vocabulary.items():
            letters = base_symbols(label, end)
            self._spell([self.symbols.setdefault(x, len(self.symbols)) for x in letters], token)
            self.dead[token] = len(letters) > 1  # until a merge makes it
        self.parent, self.lost, self.born = [0], [-1], [0]
        self.behind = [0] * size
        for turn, (u, v) in enumerate(merges, 1):
            self._add(turn, vocabulary[u], vocabulary[v], vocabulary[u + v])
        # Deterministic states: the places each stands for, its number, and its transitions (next state, token that ends).
        self.places: list[tuple[int, ...]] = [(0,)]
        self.numbers: dict[tuple[int, ...], int] = {(0,): 0}
        self.moves: list[dict[int, int]] = [{}]
        self.arcs: dict[int, bool] = {}  # arcs asked for before

    def _spell(self, symbols: list[int], token: int) -> None:
        node = 0
        for symbol in symbols:
            key = node << 32 | symbol
            if key not in self.steps:
                self.steps[key] = len(self.ends)
                self.inner[node] = True
                self.ends.append(-1)
                self.inner.append(False)
            node = self.steps[key]
        self.ends[node], self.length[token] = token, len(symbols)

    def _add(self, turn: int, u: int, v: int, new: int) -> None:
        self.made[new], self.left[new] = turn, u
        state = self.behind[u]
        self.dead[new] = not self._has_arc(state, v)
        if self.dead[new]:
            return
        self.behind[new] = self.behind[v]
        self.behind[u] = len(self.born)
        self.parent.append(state)
        self.lost.append(v)
        self.born.append(turn)

    def _has_arc(self, state: int, token: int) -> bool:
        made, left, dead, parent, lost, born = self.made, self.left, self.dead, self.parent, self.lost, self.born
        while True:
            if made[token] >= born[state]:  # the arc came after the state: it is there if the left part's is
                if dead[token]:
                    return False
                if left[token] < 0:
                    return True
                token = left[token]
            elif lost[state] == token:
                return False
            else:
                state = parent[state]

    def _move(self, at: int, symbol: int) -> int:
        """The transition from a state by a symbol: next state and token, as one number."""
        reached, ended = [], -1
        for place in self.places[at]:
            node = self.steps.get((place & _LOW) << 32 | symbol)
            if node is None:
                continue
            if self.inner[node]:
                reached.append(place & ~_LOW | node)
            token = self.ends[node]
            if ended < 0 <= token:
                arc = place & ~_LOW | token
                if arc not in self.arcs:
                    if len(self.arcs) >= KEPT_ARCS:
                        self.arcs.clear()
                    self.arcs[arc] = self._has_arc(place >> 32, token)
                if self.arcs[arc]:
                    ended = token
        if ended < 0:
            raise ValueError("no token holds a symbol of the word")
        reached.append(self.behind[ended] << 32)
        key = tuple(reached)
        after = self.numbers.get(key)
        if after is None:
            if len(self.numbers) >= KEPT_STATES:
                self._forget()
                at = -1
            after = self.numbers[key] = len(self.places)
            self.places.append(key)
            self.moves.append({})
        found = after << 32 | ended
        if at >= 0:
            self.moves[at][symbol] = found
        return found

    def _forget(self) -> None:
        """Keep the first state only; the others are found again when met."""
        del self.places[1:], self.moves[1:]
        self.moves[0].clear()
        self.numbers.clear()
        self.numbers[self.places[0]] = 0

    def number(self, name: str) -> int:
        """The number of a base symbol, or -1."""
        return self.symbols.get(name, -1)

    def encode(self, symbols: list[str]) -> list[int]:
        """Ids of a non-empty word of base symbols."""
        return self.read([self.number(name) for name in symbols])

    def read(self, symbols: list[int]) -> list[int]:
        """Ids of a non-empty word of numbered symbols."""
        at, moves, ended = 0, self.moves, []
        for symbol in symbols:
            found = moves[at].get(symbol)
            if found is None:
                found = self._move(at, symbol)
            at = found >> 32
            ended.append(found & _LOW)
        tokens, place, length = [], len(ended), self.length
        while place:
            token = ended[place - 1]
            tokens.append(token)
            place -= length[token]
        return tokens[::-1]


class Tokenizer:
    """Normalise, pre-split and encode whole texts as a word-end BPE tokenizer file says."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.end = model["end_of_word_suffix"] or ""
        self.automaton = Automaton(model["vocab"], merges, self.end)
        self.split = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.labels = {i: label for label, i in [*model["vocab"].items(), *self.added.items()]}
        self.changed, self.stand_ins = unicode_departures()
        self._prepare()

    def _prepare(self) -> None:
        self._split = regex.compile(self.split)
        # The same for ASCII texts, where the standard module's engine is faster.
        spaces = "".join(re.escape(c) for c in map(chr, range(128)) if regex.match(r"\s", c))
        self._split_ascii = re.compile(self.split.replace(r"\p{L}", "a-zA-Z").replace(r"\p{N}", "0-9").replace(r"\s", spaces))
        # Beyond the first plane every code point counts as odd: its ranges would be tried one by one for each character.
        odd = {*map(ord, self.changed), *self.stand_ins}
        self._odd = re.compile(f"[{_runs([c for c in odd if c < 0x10000])}\\U00010000-\\U0010ffff]")
        self._added = re.compile("|".join(re.escape(a) for a in sorted(self.added, key=len, reverse=True)) or "(?!)")
        letters, number = byte_letters(), self.automaton.number
        self._inner, self._last = [number(x) for x in letters], [number(x + self.end) for x in letters]
        self._words: dict[str, bytes] = {}

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if not k.startswith("_")}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self._prepare()

    def _encoded(self, word: str) -> bytes:
        known = self._words.get(word)
        if known is None:
            if len(self._words) >= KEPT_WORDS:
                self._words.clear()
            data = word.encode()
            symbols = [self._inner[b] for b in data]
            symbols[-1] = self._last[data[-1]]
            known = array("I", self.automaton.read(symbols)).tobytes()
            if len(word) <= 64:
                self._words[word] = known
        return known

    def _part(self, text: str) -> bytes:
        known = self._words
        if text.isascii():
            words = self._split_ascii.findall(text.lower())
        elif self._odd.search(text):
            text = "".join([self.changed.get(c) or c.lower() for c in unicodedata.normalize("NFC", text)])
            # Stand-ins are as long as what they stand for, so the places of the words are the same.
            words = [text[m.start() : m.end()] for m in self._split.finditer(text.translate(self.stand_ins))]
        else:
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()  # one by one: no final sigma
            words = self._split.findall(text)
        return b"".join([known.get(w) or self._encoded(w) for w in words])

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers; added tokens stand for themselves."""
        out, at = [], 0
        for m in self._added.finditer(text):
            out += [self._part(text[at : m.start()]), self.added[m[0]].to_bytes(4, "little")]
            at = m.end()
        out.append(self._part(text[at:] if at else text))
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        return " ".join(map(self.labels.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids) of every document, ids as little-endian unsigned 32-bit integers."""
    sent = docs.sparkSession.sparkContext.broadcast(Tokenizer(path))

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = sent.value
        for batch in batches:
            ids, texts = T.column(batch, "doc_id"), T.column(batch, "text")
            for at in range(0, len(texts), 256):
                found = [tokenizer.encode(x or "") for x in texts.slice(at, 256).to_pylist()]
                counts = pa.array([len(x) // 4 for x in found], pa.int64())
                yield pa.RecordBatch.from_arrays([ids.slice(at, 256), counts, pa.array(found, pa.binary())], ["doc_id", "n_tokens", "ids"])

    return _plain(docs).mapInArrow(encoded, "doc_id bigint, n_tokens bigint, ids binary")


def _plain(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) from the ids of ``encode_documents``."""
    sent = encoded.sparkSession.sparkContext.broadcast(Tokenizer(path))

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [sent.value.decode(x) for x in T.column(batch, "ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([T.column(batch, "doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(decoded, "doc_id bigint, text string")


def encode_and_decode(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every document, the round trip in one pass."""
    sent = docs.sparkSession.sparkContext.broadcast(Tokenizer(path))

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = sent.value
        for batch in batches:
            texts, counts, of_ids, of_text = T.column(batch, "text"), [], [], []
            for at in range(0, len(texts), 64):
                for text in texts.slice(at, 64).to_pylist():
                    ids = tokenizer.encode(text or "")
                    counts.append(len(ids) // 4)
                    of_ids.append(hashlib.sha256(ids).hexdigest())
                    of_text.append(hashlib.sha256(tokenizer.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [T.column(batch, "doc_id"), pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return _plain(docs).mapInArrow(digested, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
