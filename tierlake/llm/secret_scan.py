"""Secrets in whole texts: fixed patterns, and a linear-chain conditional random field beside them.

The patterns (kinds assign, access, hex) always count. The field tags tokens as begin, inside or outside
of a secret and adds what the patterns do not cover: its features are shape and length of the
token, the words and signs around it and figures of the file, its decoder is Viterbi's. It is
fitted to pattern matches, drawn apart from texts without any over the whole table (two bounded samples of distinct texts), each
once as it is and then with other secrets, key words and signs in their places, with the words around hidden at random, so that
it learns the look of a secret and of its place and not only the patterns.

The field tags every token of every text, whatever its length. It is learned on the stretches around cues (a digit, a long run of
word characters, a key word, an assignment), which are part of the bounded sample. Weights of all tokens are added up at once; a token at which outside is
best whatever its neighbours are needs no search, and Viterbi's search joins the others (see ``_Weights``). An added span is cut back to
what the patterns leave of it.
Spans are (kind, start, end) in code points, end exclusive; added ones have kind crf and overlap none
of the others. Null texts count as empty and have no spans; rows are independent, so repeated
rows give equal results; an empty table gives no rows; without any match to learn from only the patterns
act.
"""

from __future__ import annotations

import bisect
import hashlib
import itertools
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tierlake import scratch
from tierlake.llm import text as T

# The patterns, the least length that each must reach, and their order.
ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # the same as runs of one or more, then those of 24 or more
LEAST_VALUE, LEAST_ACCESS = 6, 20
KINDS = ("assign", "access", "hex", "crf")
_STEMS = ("passw", "secret", "token", "api")

DIGITS = re.compile(r"[0-9]+")
LONG = re.compile(r"(?<![\w+/-])[\w+/-]{20,}")
ASSIGNED = re.compile(r"\w[\"']?\s?(?:=>?|:)\s?[\"']?\w")
CUE_WORDS = "pass|secret|token|key|auth|cred|pwd|bearer|access|private|login"
CUE_WORD, CUE_WORD_ANY_CASE = re.compile(CUE_WORDS), re.compile(CUE_WORDS, re.IGNORECASE)
BLANK = re.compile(r"\s")
PART, TOKENS_AT_ONCE = 1_000_000, 65_536  # code points of a text, tokens
TOKEN = re.compile(r"[\w+/-]+|[^\w\s]")
REACH = 48  # code points that a stretch goes beyond a cue
# What is a key word: a token without digits, one of whose parts (cut at _ and -, small letters) is one of these or ends in one.
KEY_WORDS = (
    "password", "passwd", "passphrase", "pass", "pwd", "secret", "token", "apikey", "key", "auth", "authorization", "bearer",
    "credential", "credentials", "access", "private", "login",
)
# Put into the places of key words, and of the sign behind them, when learning.
OTHER_KEYS = ("DB_PASS", "auth", "api_key", "login", "access-key", "private_key", "CREDENTIALS", "pwd", "bearer", "clientSecret", "passphrase")
OTHER_SIGNS = (":", "=", "is", "to")
LABELS = BEGIN, INSIDE, OUTSIDE = 0, 1, 2
MAX_DOCUMENTS = 8000
EPOCHS, RATE, PENALTY, HIDE, SEED = 60, 0.1, 1e-3, 0.3, 11
PIECE = 48  # tokens of one training sequence
VERSIONS = 8  # of a training sequence with a secret, beside itself

Span = tuple[str, int, int]


def pattern_spans(text: str) -> list[tuple[str, int, int, int]]:
    """(kind, start, end, start of the secret itself) of every pattern match that is long enough."""
    found = []
    low = text.lower()
    if any(stem in low for stem in _STEMS):
        found += [("assign", m.start(), m.end(), m.start(2)) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_VALUE]
    if "AKIA" in text:
        found += [("access", *m.span(), m.start()) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST_ACCESS]
    found += [("hex", *m.span(), m.start()) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def _cues(text: str) -> Iterator[re.Match]:
    low = text.lower()  # rarely of another length; then its places are not those of the text
    words = CUE_WORD.finditer(low) if len(low) == len(text) else CUE_WORD_ANY_CASE.finditer(text)
    assigned = ASSIGNED.finditer(text) if "=" in text or ":" in text else ()
    return itertools.chain(DIGITS.finditer(text), LONG.finditer(text), words, assigned)


def stretches(text: str) -> tuple[list[tuple[int, int]], int]:
    """Parts of a text around cues, widened to white space, and how many cues the file has."""
    cues = sorted(m.span() for m in _cues(text))
    parts: list[list[int]] = []
    for a, b in cues:
        start, end = max(0, a - REACH), min(len(text), b + REACH)
        if parts and start <= parts[-1][1]:
            if end > parts[-1][1]:
                parts[-1][1] = end
        else:
            parts.append([start, end])
    for part in parts:
        while part[0] > 0 and not text[part[0] - 1].isspace():
            part[0] -= 1
        while part[1] < len(text) and not text[part[1]].isspace():
            part[1] += 1
    joined = []
    for start, end in parts:
        if joined and start <= joined[-1][1]:
            joined[-1] = (joined[-1][0], max(end, joined[-1][1]))
        else:
            joined.append((start, end))
    return joined, len(cues)


_DIGITS, _HEX_DIGITS, _CUT = frozenset("0123456789"), frozenset("0123456789abcdef"), re.compile("[_-]")


def _shape(word: str) -> str:
    if len(word) == 1 and not word.isalnum():
        return word
    lower, upper = word != word.upper(), word != word.lower()
    if word.isalpha():
        return ("a" if lower else "") + ("A" if upper else "") + ("" if word.isascii() else "u")
    digit = not _DIGITS.isdisjoint(word)
    kind = ("0" if digit else "") + ("a" if lower else "") + ("A" if upper else "")
    if digit and not upper and _HEX_DIGITS.issuperset(word):
        kind += "h"
    if not word.isascii():
        kind += "u"
    return kind + ("+" if "+" in word or "/" in word else "") + ("-" if "-" in word or "_" in word else "")


def _name(word: str) -> str:
    """What neighbours see of a token: that it is a key word, a little word that joins, or its shape."""
    if len(word) <= 24 and (word.isalpha() or not any(c.isdigit() for c in word)):
        low = word.lower()
        if low.endswith(KEY_WORDS) or any(part.endswith(KEY_WORDS) for part in _CUT.split(low)[:-1]):
            return "key"
        if low in ("is", "to", "was"):
            return low
    return _shape(word)


_SIZES = (2, 4, 6, 12, 20, 24, 40)


def _size(word: str) -> int:
    return bisect.bisect_right(_SIZES, len(word))


MANY_CUES = 20


def _file(cues: int) -> int:
    return min(cues, 3) if cues < MANY_CUES else 4


def features(tokens: list[str], cues: int) -> list[list[str]]:
    """Names of the features of each token; those that start with k are hidden at random in training."""
    shapes = [_shape(t) for t in tokens]
    sizes = [_size(t) for t in tokens]
    names = [_name(t) if len(t) <= 64 else s for t, s in zip(tokens, shapes, strict=True)]
    names = ["<", "<", "<", *names, ">"]
    file = _file(cues)
    out = []
    for i, shape in enumerate(shapes):
        before, back, further, after = names[i + 2], names[i + 1], names[i], names[i + 4]
        out.append(
            [
                f"s{shape}", f"l{sizes[i]}", f"m{shape},{sizes[i]}", f"w{names[i + 3]}", f"f{file},{shape}",
                f"k1{before}", f"k2{back}", f"k3{further}", f"k4{after}", f"k5{back},{before}",
            ]
        )
    return out


@dataclass
class Field:
    """Weights of the conditional random field; ``index`` numbers the features from 1."""

    index: dict[str, int]
    emit: np.ndarray
    move: np.ndarray

    def tags(self, tokens: list[str], cues: int) -> list[int]:
        """Viterbi's best labels."""
        rows = [[self.index.get(f, 0) for f in one] for one in features(tokens, cues)]
        emit = self.emit[np.array(rows)].sum(axis=1).tolist()
        move = self.move.tolist()
        best, back = [move[3][k] + emit[0][k] for k in LABELS], []
        for own in emit[1:]:
            froms = [max(LABELS, key=lambda j, k=k: best[j] + move[j][k]) for k in LABELS]
            best = [best[froms[k]] + move[froms[k]][k] + own[k] for k in LABELS]
            back.append(froms)
        tag = max(LABELS, key=best.__getitem__)
        tags = [tag]
        for froms in reversed(back):
            tag = froms[tag]
            tags.append(tag)
        return tags[::-1]


class _Weights:
    """A field's weights by kind of token (shape, size and name), and Viterbi's best labels of whole texts from them.

    The labels are those of ``Field.tags``. Where outside beats both other labels by more than all transitions around it can give
    back, every best path passes through outside, so that the path falls into parts which are searched one by one.
    """

    CACHED, START, END = 200_000, 0, 1

    def __init__(self, field: Field) -> None:
        self.index, self.emit, self.move = field.index, field.emit, field.move
        names = ["", *sorted({f[2:] for f in field.index if f[:2] in ("k1", "k2", "k3", "k4")})]
        # Number 0 is every name that was not learned: none of its features has a weight.
        self.names = {name: i for i, name in enumerate(names)}
        self.further, self.after = (np.stack([self._of(f"{k}{name}") for name in names]) for k in ("k3", "k4"))
        self.further[0] = self.after[0] = 0
        near, back = (np.stack([self._of(f"{k}{name}") for name in names]) for k in ("k1", "k2"))
        near[0] = back[0] = 0
        self.near, self.back = near, back
        pairs = [(i, j, f"k5{a},{b}") for i, a in enumerate(names) for j, b in enumerate(names) if i and j and f"k5{a},{b}" in field.index]
        self.pair = np.zeros((len(names), len(names)), np.int32)
        for n, (i, j, _) in enumerate(pairs, start=1):
            self.pair[i, j] = n
        self.paired = np.stack([np.zeros(3), *[self._of(f) for _, _, f in pairs]])
        self.kinds: dict[tuple[str, int, str], int] = {}
        self.rows: list[np.ndarray] = []
        self.name_of: list[int] = []
        self.table, self.name_table = np.zeros((0, 5, 3)), np.zeros(0, np.int32)
        for name in ("<", ">"):
            self._add(("", -1, name), np.zeros((5, 3)), name)
        self.known: dict[str, int] = {}
        m = self.move
        out = [{x: m[j, OUTSIDE] - m[j, x] for x in (BEGIN, INSIDE)} for j in range(4)]
        least = {x: min(o[x] for o in out) for x in (BEGIN, INSIDE)}
        # What the neighbours can take from outside against x: next is begin, outside or nothing; or next is inside, which then becomes begin.
        self.plain = np.array([least[x] + min(0.0, *(m[OUTSIDE, k] - m[x, k] for k in (BEGIN, OUTSIDE))) for x in (BEGIN, INSIDE)])
        going = min(0.0, *(m[BEGIN, k] - m[INSIDE, k] for k in LABELS))
        self.turned = np.array([least[x] + m[OUTSIDE, BEGIN] - m[x, INSIDE] + going for x in (BEGIN, INSIDE)])

    def _of(self, feature: str) -> np.ndarray:
        return self.emit[self.index.get(feature, 0)]

    def _add(self, kind: tuple[str, int, str], row: np.ndarray, name: str) -> int:
        self.kinds[kind] = len(self.rows)
        self.rows.append(row)
        self.name_of.append(self.names.get(name, 0))
        return self.kinds[kind]

    def kind(self, word: str) -> int:
        """Number of a word's kind; short words are kept for next time, up to a bound."""
        shape, size = _shape(word), _size(word)
        name = _name(word) if len(word) <= 64 else shape
        known = shape if f"s{shape}" in self.index else None
        # Kinds without a learned shape differ in size and name only, so that there are not as many as there are signs.
        kind = (known or "", size, name if name in self.names or f"w{name}" in self.index else "")
        number = self.kinds.get(kind)
        if number is None:
            own = self._of(f"l{size}") + self._of(f"w{name}")
            if known is not None:
                own = own + self._of(f"s{shape}") + self._of(f"m{shape},{size}")
            files = np.stack([own + (self._of(f"f{file},{shape}") if known is not None else 0) for file in range(5)])
            number = self._add(kind, files, name)
        if len(word) <= 64:
            if len(self.known) >= self.CACHED:
                self.known.clear()
            self.known[word] = number
        return number

    def numbers(self, text: str) -> np.ndarray:
        """Kinds of a text's tokens; they are strings for a part of a long text only."""
        parts, at = [np.zeros(3, np.int32)], 0
        while at < len(text):
            cut = BLANK.search(text, at + PART)
            end = cut.start() if cut else len(text)
            known, kind = self.known.get, self.kind
            parts.append(np.array([n if (n := known(word)) is not None else kind(word) for word in TOKEN.findall(text, at, end)], np.int32))
            at = end
        return np.concatenate([*parts, np.array([self.END], np.int32)])

    def tags(self, texts: list[str]) -> list[dict[int, int]]:
        """Of each text the tokens, by number, that are begin or inside."""
        numbers = [self.numbers(text) for text in texts]
        if len(self.table) < len(self.rows):
            self.table, self.name_table = np.stack(self.rows), np.array(self.name_of, np.int32)
        files = [_file(sum(1 for _ in itertools.islice(_cues(text), MANY_CUES))) for text in texts]
        found, group, size = [], [], 0
        for number, file in zip(numbers, files, strict=True):
            group.append((number, file))
            size += len(number)
            if size >= TOKENS_AT_ONCE:
                found += self._tags(group)
                group, size = [], 0
        return found + self._tags(group) if group else found

    def _tags(self, group: list[tuple[np.ndarray, int]]) -> list[dict[int, int]]:
        kinds = np.concatenate([number for number, _ in group])
        file = np.repeat(np.array([file for _, file in group], np.int8), [len(number) for number, _ in group])
        ends = np.cumsum([len(number) for number, _ in group])
        real = np.ones(len(kinds), bool)
        real[ends - 1] = False
        for k in range(3):
            real[np.concatenate([[0], ends[:-1]]) + k] = False
        open_places = [np.zeros(0, np.int64)]
        for at in range(0, len(kinds), TOKENS_AT_ONCE):
            # One place more than is decided, as the next token counts.
            stop = min(at + TOKENS_AT_ONCE, len(kinds))
            emit = self._emit(kinds, file, at, min(stop + 1, len(kinds)))
            lead = emit[:, OUTSIDE, None] - emit[:, [BEGIN, INSIDE]]
            after = np.append(emit[1:, BEGIN] - emit[1:, INSIDE], 0.0)
            sure = np.minimum((lead + self.plain).min(axis=1), (lead + self.turned).min(axis=1) + after) > 1e-6
            open_places.append(at + np.flatnonzero(~sure[: stop - at] & real[at:stop]))
        places = np.concatenate(open_places)
        out: list[dict[int, int]] = [{} for _ in group]
        if len(places) == 0:
            return out
        text_of = np.searchsorted(ends, places, "right")
        breaks = np.flatnonzero((np.diff(places) > 1) | (np.diff(text_of) > 0)) + 1
        for run in np.split(np.arange(len(places)), breaks):
            first, last, text = int(places[run[0]]), int(places[run[-1]]), int(text_of[run[0]])
            begins = first - 3 == (ends[text - 1] if text else 0)
            ended = last + 2 == ends[text]
            for n, tag in enumerate(self._best(kinds, file, first, last + 1, begins, ended)):
                if tag != OUTSIDE:
                    out[text][first + n - 3 - int(ends[text - 1] if text else 0)] = tag
        return out

    def _emit(self, kinds: np.ndarray, file: np.ndarray, a: int, b: int) -> np.ndarray:
        """Summed weights of the places from a to b; those of the three before and of the one behind a text mean nothing."""
        names = self.name_table[np.concatenate([np.zeros(max(0, 3 - a), np.int32), kinds[max(0, a - 3) : b + 1], np.ones(max(0, b + 1 - len(kinds)), np.int32)])]
        n = b - a
        before, back, further, after = names[2 : 2 + n], names[1 : 1 + n], names[:n], names[4 : 4 + n]
        emit = self.table[kinds[a:b], file[a:b]]
        for weights, which in ((self.near, before), (self.back, back), (self.further, further), (self.after, after)):
            emit += weights[which]
        return emit + self.paired[self.pair[back, before]]

    def _best(self, kinds: np.ndarray, file: np.ndarray, a: int, b: int, begins: bool, ended: bool) -> list[int]:
        """Best labels of a part between tokens that are outside, or between an end of the text and one."""
        move = self.move.tolist()
        start, emit = move[3] if begins else move[OUTSIDE], self._emit(kinds, file, a, b).tolist()
        best, back = [start[k] + emit[0][k] for k in LABELS], []
        for own in emit[1:]:
            froms = [max(LABELS, key=lambda j, k=k: best[j] + move[j][k]) for k in LABELS]
            best = [best[froms[k]] + move[froms[k]][k] + own[k] for k in LABELS]
            back.append(froms)
        if not ended:
            best = [best[k] + move[k][OUTSIDE] for k in LABELS]
        tag = max(LABELS, key=best.__getitem__)
        tags = [tag]
        for froms in reversed(back):
            tag = froms[tag]
            tags.append(tag)
        return tags[::-1]


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (np.log(np.exp(x - top).sum(axis=axis, keepdims=True)) + top).squeeze(axis)


def fit(sequences: Iterable[tuple[list[list[str]], list[int]]]) -> Field | None:
    """Maximise the penalised likelihood of labelled sequences by Adam with forward-backward sums.

    Sequences are read once and kept as numbers: the driver holds 4 bytes for each feature, and some numbers for each token.
    """
    index: dict[str, int] = {}
    numbered, labelled = [], []
    for rows, labels in sequences:
        numbered.append(np.array([[index.setdefault(f, len(index) + 1) for f in row] for row in rows], np.int32))
        labelled.append(np.array(labels))
    if not any(BEGIN in labels for labels in labelled):
        return None
    n, longest, k = len(numbered), max(map(len, numbered)), numbered[0].shape[1]
    ids = np.zeros((n, longest, k), np.int32)
    gold = np.full((n, longest), OUTSIDE)
    real = np.zeros((n, longest), bool)
    for s, (rows, labels) in enumerate(zip(numbered, labelled, strict=True)):
        ids[s, : len(rows)], gold[s, : len(rows)], real[s, : len(rows)] = rows, labels, True
    del numbered, labelled
    hidden = np.zeros(len(index) + 1, bool)
    hidden[[i for f, i in index.items() if f[0] == "k"]] = True
    rng = np.random.default_rng(SEED)
    weights = [np.zeros((len(index) + 1, 3)), np.zeros((4, 3))]
    first, second = ([np.zeros_like(w) for w in weights] for _ in range(2))
    target = np.eye(3)[gold] * real[..., None]
    for step in range(1, EPOCHS + 1):
        emit, move = weights
        now = np.where(hidden[ids] & (rng.random((n, longest, 1)) < HIDE), np.int32(0), ids)
        # One feature of all tokens at a time, so that no array holds weights for each.
        own = emit[now[..., 0]]
        for j in range(1, k):
            own += emit[now[..., j]]
        own *= real[..., None]
        ahead = np.empty((n, longest, 3))
        ahead[:, 0] = move[3] + own[:, 0]
        for t in range(1, longest):
            going = _log_sum(ahead[:, t - 1, :, None] + move[:3], 1) + own[:, t]
            ahead[:, t] = np.where(real[:, t, None], going, ahead[:, t - 1])
        total = _log_sum(ahead[:, -1], 1)
        behind = np.zeros((n, longest, 3))
        moves = np.zeros((4, 3))
        for t in range(longest - 1, 0, -1):
            pull = move[:3] + (own[:, t] + behind[:, t])[:, None, :]
            behind[:, t - 1] = np.where(real[:, t, None], _log_sum(pull, 2), behind[:, t])
            pair = np.exp(ahead[:, t - 1, :, None] + pull - total[:, None, None]) * real[:, t, None, None]
            moves[:3] += pair.sum(axis=0) - np.einsum("ni,nj->ij", target[:, t - 1], target[:, t])
        chance = np.exp(ahead + behind - total[:, None, None]) * real[..., None]
        moves[3] = chance[:, 0].sum(axis=0) - target[:, 0].sum(axis=0)
        emits = np.zeros_like(emit)
        for c in LABELS:
            off = (chance[..., c] - target[..., c]).reshape(-1)
            for j in range(k):
                emits[:, c] += np.bincount(now[..., j].reshape(-1), off, len(index) + 1)
        emits[0] = 0
        for i, g in enumerate((emits, moves)):
            g = g / n + PENALTY * weights[i]
            first[i] = 0.9 * first[i] + 0.1 * g
            second[i] = 0.99 * second[i] + 0.01 * g * g
            weights[i] = weights[i] - RATE * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.99**step)) + 1e-8)
    move = weights[1].copy()
    move[OUTSIDE, INSIDE] = move[3, INSIDE] = -1e9  # a secret starts with a begin
    return Field(index, weights[0], move)


def _tokens(text: str, start: int, end: int) -> list[tuple[int, int]]:
    return [m.span() for m in TOKEN.finditer(text, start, end)]


def labelled(text: str) -> list[tuple[list[str], list[int], int]]:
    """(tokens, labels, cues of the file) of each stretch: tokens inside of pattern secrets are begin or inside."""
    secrets = [(own, end) for _, _, end, own in pattern_spans(text)]
    parts, cues = stretches(text)
    out = []
    for start, end in parts:
        spans = _tokens(text, start, end)
        tags, open_until = [], -1
        for a, b in spans:
            if a < open_until:
                tags.append(INSIDE)
                continue
            inside = [stop for own, stop in secrets if own < b and a < stop]
            tags.append(BEGIN if inside else OUTSIDE)
            open_until = max(inside, default=-1)
        out.append(([text[a:b] for a, b in spans], tags, cues))
    return out


def sequences(words: list[str], tags: list[int], cues: int) -> list[tuple[list[list[str]], list[int]]]:
    """Training sequences of a stretch; one with a secret comes again with others, other key words and signs in the places."""
    versions = [(words, tags)]
    if BEGIN in tags:
        versions += [_another(words, tags, k) for k in range(VERSIONS)]
    rows = [(features(own, cues), labels) for own, labels in versions]
    return [(one[i : i + PIECE], labels[i : i + PIECE]) for one, labels in rows for i in range(0, len(one), PIECE)]


def _another(words: list[str], tags: list[int], turn: int) -> tuple[list[str], list[int]]:
    """The stretch with each secret, and the key word, sign and quotes around it, exchanged; the same for the same stretch and turn."""
    out = list(zip(words, tags, strict=True))
    for i, tag in enumerate(tags):
        if tag != BEGIN:
            continue
        digest = hashlib.sha256(f"{turn}:{words[i]}".encode()).digest()
        out[i] = _other_secret(words[i], digest), BEGIN
        for j in range(max(0, i - 3), min(i + 2, len(words))):
            if tags[j] == OUTSIDE and _name(words[j]) == "key":
                out[j] = OTHER_KEYS[digest[2] % len(OTHER_KEYS)], OUTSIDE
            elif words[j] in (":", "="):
                out[j] = OTHER_SIGNS[digest[3] % len(OTHER_SIGNS)], OUTSIDE
            elif words[j] in ("'", '"') and digest[3] & 64:
                out[j] = None
    kept = [one for one in out if one is not None]
    return [word for word, _ in kept], [tag for _, tag in kept]


def _other_secret(word: str, digest: bytes) -> str:
    """A secret of another look: mixed letters and digits, with a prefix, small letters with digits, groups, or letters only."""
    capital, small, digits = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
    letters = (capital + small + digits, capital + small + digits, small + digits, small + digits + "-", small)[digest[0] % 5]
    body = "".join(letters[b % len(letters)] for b in digest[4 : 12 + digest[1] % 20])
    return ("", "sk_live_", "ghp_", "")[digest[1] % 4] + body + ("" if letters == small else "7x")


def spans_of(text: str, field: Field | None) -> list[Span]:
    """All spans by start, then kind: pattern matches, and what the field adds where no pattern is."""
    return spans_of_all([text], field and _Weights(field))[0]


def spans_of_all(texts: list[str], weights: _Weights | None) -> list[list[Span]]:
    if weights is None:
        return [_merged(text, {}) for text in texts]
    return [_merged(text, tags) for text, tags in zip(texts, weights.tags(texts), strict=True)]


def _merged(text: str, tags: dict[int, int]) -> list[Span]:
    """The pattern matches of a text and the spans that its tagged tokens make."""
    spans = [s[:3] for s in pattern_spans(text)]
    added = []
    # Places are only looked for in texts that have tagged tokens, and up to the last of these.
    for number, m in enumerate(itertools.islice(TOKEN.finditer(text), max(tags) + 1 if tags else 0)):
        tag = tags.get(number, OUTSIDE)
        if tag == BEGIN:
            added.append([m.start(), m.end()])
        elif tag == INSIDE:
            added[-1][1] = m.end()
    spans += [("crf", a, b) for one in added for a, b in _left(text, *one, spans) if b - a >= LEAST_VALUE]
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


def _left(text: str, start: int, end: int, spans: list[Span]) -> Iterator[tuple[int, int]]:
    """What pattern spans leave of a stretch, without blanks at its ends."""
    for _, a, b in [*sorted((s for s in spans if s[1] < end and start < s[2]), key=lambda s: s[1]), ("", end, end)]:
        piece = text[start : max(start, a)]
        if piece.strip():
            yield start + len(piece) - len(piece.lstrip()), start + len(piece.rstrip())
        start = max(start, b)


# Texts that may have a match, found without Python: more than those that have one.
LIKELY = r"(?i:(password|passwd|secret|token|api_?key)[\"']?\x20*[:=])|AKIA[A-Z0-9]{16}|[0-9a-f]{24}"


def train(docs: DataFrame, max_documents: int = MAX_DOCUMENTS) -> Field | None:
    """Fit the field on stretches of at most ``max_documents`` distinct texts: half of them, if there are as many, with a likely match.

    Texts are drawn by their hash over the whole table, so copies count once; doc_id is not read.
    """
    known = docs.select(F.col("text").cast("string").alias("text")).filter("text <> ''").withColumn("hash", F.xxhash64("text"))
    marked = known.select("hash", F.col("text").rlike(LIKELY).alias("likely"))
    half = max_documents // 2
    chosen = [marked.filter(likely).select("hash").distinct().orderBy("hash").limit(half) for likely in ("likely", "not likely")]
    sample = known.join(F.broadcast(chosen[0].unionByName(chosen[1])), "hash", "left_semi")
    sample = sample.groupBy("hash").agg(F.first("text").alias("text")).select("text")

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.list_(pa.string()), pa.list_(pa.int32()), pa.int32()]
        for batch in batches:
            # A stretch is cut where a training sequence would be, so none is too long to learn from.
            rows = [
                (words[i : i + PIECE], tags[i : i + PIECE], cues)
                for parts in _by_slices(T.column(batch, "text"), lambda texts: map(labelled, texts))
                for words, tags, cues in parts
                for i in range(0, len(words), PIECE)
            ]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], ["words", "tags", "cues"])

    parts = sample.mapInArrow(found, "words array<string>, tags array<int>, cues int")
    parts, with_secret = scratch.stored(parts, "stretches"), F.array_contains("tags", BEGIN)
    order = F.xxhash64("words")
    rows = parts.filter(with_secret).orderBy(order).limit(max_documents // 8).collect()
    rows += parts.filter(~with_secret).orderBy(order).limit(max_documents // 3).collect()
    return fit(s for r in sorted(rows) for s in sequences(*r))


def _by_slices(texts: pa.Array, of: Callable[[list[str]], Iterable]) -> list:
    """Apply to all texts, with few of them as Python strings at a time; null counts as empty."""
    return [found for at in range(0, len(texts), 64) for found in of([x or "" for x in texts.slice(at, 64).to_pylist()])]


def _written(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def scan(docs: DataFrame, field: Field | None) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) of every document."""

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = field and _Weights(field)
        for batch in batches:
            found = _by_slices(T.column(batch, "text"), lambda texts: spans_of_all(texts, weights))
            counts = [pa.array([sum(s[0] == kind for s in spans) for spans in found], pa.int64()) for kind in KINDS[:3]]
            base = [hashlib.sha256(_written([s for s in spans if s[0] != "crf"]).encode()).hexdigest() for spans in found]
            yield pa.RecordBatch.from_arrays(
                [T.column(batch, "doc_id"), *counts, pa.array(base, pa.string()), pa.array(map(_written, found), pa.string())],
                ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
            )

    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(
        scanned, "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string"
    )


def redacted(text: str, field: Field | None) -> str:
    """The text with every secret replaced by its kind in square brackets."""
    return _without(text, spans_of(text, field))


def _without(text: str, spans: list[Span]) -> str:
    parts, at = [], 0
    for kind, start, end in spans:
        if end <= at:
            continue
        parts += [text[at : max(at, start)], f"[{kind}]"]
        at = end
    return "".join([*parts, text[at:]])


def redact(docs: DataFrame, field: Field | None) -> DataFrame:
    """The rows with all their columns, secrets replaced in ``text`` (null stays null)."""

    def cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = field and _Weights(field)
        for batch in batches:
            texts = T.column(batch, "text")
            clean = _by_slices(texts, lambda some: map(_without, some, spans_of_all(some, weights)))
            clean = [c if known else None for c, known in zip(clean, texts.is_valid().to_pylist(), strict=True)]
            at = batch.schema.get_field_index("text")
            yield batch.set_column(at, batch.schema.field(at), pa.array(clean, texts.type))

    return docs.mapInArrow(cleaned, docs.schema)
