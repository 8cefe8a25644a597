"""Repair of conversations by the cheapest edits, found by a rank-convergence parallel Viterbi.

A repaired conversation is empty, or an optional system turn and then pairs of a user and an assistant turn, read by the
first letters of the roles. Edits, in order: Keep (0), Rerole to user or assistant (2), Delete (3), Insert an empty user
or assistant turn anywhere (2); a truncated turn that is not deleted adds 1; blank turns and duplicates must go. Rows of a
conversation are taken by turn (nulls first), then by role and the text's digest; equal rows are adjacent.

The cheapest way from each place to the end is a vector of four costs, one for each state of the pattern (nothing yet, after
system, after user, after assistant). The last vector is known; a row maps it to the one before.

1. Equal rows of a conversation are counted by an aggregate with map-side combine, without their texts; the first row of each
   role and text is found the same way. The counted rows are dealt out by range and sorted, so that each task holds a
   slice of the order, whatever a conversation's length.
2. In a task all slices are cut into chunks of ``CHUNK`` rows. All chunks run at once from the end backward; the last of
   a conversation starts from the known vector, the others from a speculative one. Fix-up passes rerun the chunks whose
   follower now begins with a vector that differs from the assumed one by more than a constant, and stop within a chunk as soon
   as the new vector differs from the old one by a constant: from there on all choices are the same. Rows before that place get
   the constant added. Chunks that still change after ``PASSES`` passes are finished one after the other from the right.
3. A conversation in several tasks: each task runs its part from one speculative vector for each state, the parts (at most two
   a task) are stitched from the right, then each part is traced from each state and stitched from the left. This is two
   narrow jobs and a few numbers a task, whatever the length, and none if no conversation crosses tasks.
4. Tracing goes forward and takes the least letter whose cost fits the stitched costs, so of equally cheap edits the
   ASCII-least audit comes out.
5. Texts are shuffled once, to their conversation's audit, and go by in order, row by row: a digest of a whole conversation
   can only be computed in sequence, so one task reads a conversation through, but holds one text at a time (and the audit,
   which is part of the result).

Null roles and texts count as one space; null turns come first and count in no gap; null conversation ids are one conversation.
A conversation without rows has no audit here; ``repair_report`` lists it with zeros. An empty table gives no rows.
Ties in turn are ordered as above; repeated rows are duplicates. Very long texts pass whole. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tierlake import scratch
from tierlake.llm import text as T

# Characters of white space and of an end, costs, and faults by remainder.
SPACE_CHARACTERS, END_CHARACTERS = " \t\n\x0b\x0c\r", ".!?"
REROLE, DELETE, INSERT, CUT = 2, 3, 2, 1
LEGAL = frozenset(["su", "ua", "au"])
FAULTS, DROPPED, EMPTIED, UNSTOPPED, REPEATED, REROLED = 20, 0, 1, 2, 3, 4

START, SYSTEM, USER, ASSISTANT = STATES = range(4)
S, U, A, OTHER, NOTHING = range(5)  # what a row's role begins with; NOTHING fills up a chunk
AFTER_INSERT = (USER, USER, ASSISTANT, USER)
ROLE = {USER: "user", ASSISTANT: "assistant"}
BEGINS = {"s": S, "u": U, "a": A}
FINAL = np.array([0, 4, 2, 0])
FAR = 1 << 40  # more than any cost
CHUNK, PASSES = 32, 16
HELD_ROWS = 50_000

KEY = ["conv_id", "turn", "role", "digest"]


def damage(conversations: DataFrame) -> DataFrame:
    """The rows with a fault by crc32 of ``conv_id:turn``; null roles and texts become one space."""
    space = F.lit(" ")
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    fault = F.crc32(name.cast("binary")) % FAULTS
    role, text = F.coalesce("role", space), F.coalesce("text", space)
    text = F.when(fault == EMPTIED, "").when(fault == UNSTOPPED, F.translate(text, END_CHARACTERS, "")).otherwise(text)
    copies = F.when(fault == DROPPED, 0).when(fault == REPEATED, 2).otherwise(1)
    return conversations.select(
        "conv_id",
        "turn",
        F.when(fault == REROLED, "user").otherwise(role).alias("role"),
        text.alias("text"),
        F.explode(F.array_repeat(F.lit(0), copies)).alias("_copy"),
    ).drop("_copy")


def _texts(conversations: DataFrame) -> DataFrame:
    space = F.lit(" ")
    text = F.coalesce(F.col("text").cast("string"), space)
    return conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce(F.col("role").cast("string"), space).alias("role"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
        text.alias("text"),
    )


def counted_rows(conversations: DataFrame) -> DataFrame:
    """(key, n, blank, cut, first): equal rows counted, without texts; ``first`` marks the first of its role and text."""
    bare = F.rtrim(F.col("text"), F.lit(SPACE_CHARACTERS))
    rows = _texts(conversations).select(*KEY, (bare == "").alias("blank"), (~F.right(bare, F.lit(1)).isin(*END_CHARACTERS)).alias("cut"))
    rows = rows.groupBy(*KEY).agg(F.count("*").alias("n"), F.bool_or("blank").alias("blank"), F.bool_or("cut").alias("cut"))
    rows = scratch.stored(rows, "turns")
    place = F.struct(F.col("turn").isNotNull(), "turn")
    firsts = rows.groupBy("conv_id", "role", "digest").agg(F.min(place).getField("turn").alias("turn"))
    firsts = firsts.select(*[F.col(c).alias(f"_{c}") for c in KEY], F.lit(True).alias("_found"))
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in KEY])
    return rows.join(firsts, same, "left").select(*rows.columns, F.coalesce("_found", F.lit(False)).alias("first"))


def placed_rows(conversations: DataFrame, partitions: int | None = None) -> DataFrame:
    """Counted rows in order, dealt out by range, with what the edits need: begins (of its role), live and gone rows, part."""
    rows = counted_rows(conversations)
    initial = F.substring("role", 1, 1)
    live = (F.col("first") & ~F.col("blank")).cast("int")
    rows = rows.select(
        *KEY, "n", "blank", "cut", live.alias("live"),
        F.when(initial == "s", S).when(initial == "u", U).when(initial == "a", A).otherwise(OTHER).alias("begins"),
    )
    dealt = rows.repartitionByRange(partitions, *KEY) if partitions else rows.repartitionByRange(*KEY)
    return scratch.checkpointed(dealt.sortWithinPartitions(*KEY)).withColumn("part", F.spark_partition_id())


# -- costs -------------------------------------------------------------------------------------------


def step(after: np.ndarray, begins: np.ndarray, cut: np.ndarray) -> np.ndarray:
    """Vectors before a row from those after it; one line of ``after`` for each chunk."""
    to_user = np.where(begins == U, 0, REROLE) + cut + after[:, USER]
    to_assistant = np.where(begins == A, 0, REROLE) + cut + after[:, ASSISTANT]
    before = after + DELETE
    before[:, START] = np.minimum(before[:, START], np.where(begins == S, np.minimum(cut + after[:, SYSTEM], to_user), to_user))
    before[:, SYSTEM] = np.minimum(before[:, SYSTEM], to_user)
    before[:, USER] = np.minimum(before[:, USER], to_assistant)
    before[:, ASSISTANT] = np.minimum(before[:, ASSISTANT], to_user)
    return np.where((begins == NOTHING)[:, None], after, closed(before))


def closed(v: np.ndarray) -> np.ndarray:
    """With inserts in front."""
    user = np.minimum(v[:, USER], INSERT + v[:, ASSISTANT])
    others = np.minimum(v, INSERT + user[:, None])
    others[:, USER] = user
    return others


def parallel(v: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Do vectors differ by a constant only?"""
    off = v - w
    return (off == off[:, :1]).all(axis=1)


class Chunks:
    """Chunks of several slices and the cost vectors before each of their rows."""

    def __init__(self, begins: list[np.ndarray], cut: list[np.ndarray], ends: list[np.ndarray]) -> None:
        """One entry for each slice: its live rows, and the vector behind its last row."""
        counts = [-(-len(b) // CHUNK) for b in begins]
        self.first = np.concatenate([[0], np.cumsum(counts)]).astype(int)
        n = int(self.first[-1])
        self.begins, self.cut = np.full((n, CHUNK), NOTHING, np.int8), np.zeros((n, CHUNK), np.int64)
        self.last = np.zeros(n, bool)
        self.costs = np.zeros((n, CHUNK + 1, 4), np.int64)  # zeros behind a chunk: the speculative vector
        for k, start in enumerate(self.first[:-1]):
            if not counts[k]:
                continue
            flat, stop = len(begins[k]), int(self.first[k + 1])
            self.begins[start:stop].reshape(-1)[:flat] = begins[k]
            self.cut[start:stop].reshape(-1)[:flat] = cut[k]
            self.last[stop - 1] = True
            self.costs[stop - 1, CHUNK] = ends[k]
        self.reruns = 0
        self._run(np.arange(n), fresh=True)
        self._fix()

    def _run(self, which: np.ndarray, fresh: bool = False) -> None:
        """Run chunks backward from the vectors behind them; not fresh ones stop where they become parallel."""
        now = self.costs[which, CHUNK]
        for t in range(CHUNK - 1, -1, -1):
            now = step(now, self.begins[which, t], self.cut[which, t])
            if not fresh:
                done = parallel(now, self.costs[which, t])
                if done.any():
                    off = (now - self.costs[which, t])[done, 0]
                    self.costs[which[done], : t + 1] += off[:, None, None]
                    which, now = which[~done], now[~done]
                    if not len(which):
                        return
            self.costs[which, t] = now

    def _wrong(self) -> np.ndarray:
        """Chunks whose follower begins with another vector than assumed, by more than a constant."""
        inner = np.flatnonzero(~self.last)
        return inner[~parallel(self.costs[inner + 1, 0], self.costs[inner, CHUNK])] if len(inner) else inner

    def _fix(self) -> None:
        for _ in range(PASSES):
            wrong = self._wrong()
            if not len(wrong):
                return
            self.reruns += len(wrong)
            self.costs[wrong, CHUNK] = self.costs[wrong + 1, 0]
            self._run(wrong)
        for chunk in range(self._wrong().max(initial=-1), -1, -1):
            if not self.last[chunk] and not parallel(self.costs[[chunk + 1], 0], self.costs[[chunk], CHUNK])[0]:
                self.reruns += 1
                self.costs[chunk, CHUNK] = self.costs[chunk + 1, 0]
                self._run(np.array([chunk]))

    def begin(self, k: int, end: np.ndarray) -> np.ndarray:
        """The vector before slice ``k``: that of its first chunk, stitched by the constants between all its chunks."""
        start, stop = self.first[k], self.first[k + 1]
        if start == stop:
            return end
        off = self.costs[start + 1 : stop, 0, 0] - self.costs[start : stop - 1, CHUNK, 0]
        return self.costs[start, 0] + off.sum()

    def trace(self, k: int, n: int, state: int) -> tuple[list[str], int]:
        """The letters of each of the ``n`` live rows of slice ``k``, inserts in front, and the state behind it."""
        letters = []
        chunk = int(self.first[k]) - 1
        for i in range(n):
            t = i % CHUNK
            if t == 0:
                chunk += 1
                costs, begins, cut = self.costs[chunk].tolist(), self.begins[chunk].tolist(), self.cut[chunk].tolist()
            here, after, own = costs[t], costs[t + 1], ""
            while True:
                if DELETE + after[state] == here[state]:
                    own += "D"
                    break
                if INSERT + here[AFTER_INSERT[state]] == here[state]:
                    own += "I"
                    state = AFTER_INSERT[state]
                    continue
                to = kept(state, begins[t])
                if to is not None and cut[t] + after[to] == here[state]:
                    own += "K"
                    state = to
                else:
                    own += "R"
                    state = AFTER_INSERT[state]
                break
            letters.append(own)
        return letters, state


def kept(state: int, begins: int) -> int | None:
    """The state behind a row that keeps its role, None where the pattern has no place for it."""
    if begins == S:
        return SYSTEM if state == START else None
    if begins == U:
        return USER if state != USER else None
    return ASSISTANT if begins == A and state == USER else None


# -- slices of tasks ---------------------------------------------------------------------------------


class Slice:
    """Rows of one conversation in one task."""

    def __init__(self, rows: pa.RecordBatch, first: bool, last: bool) -> None:
        self.rows, self.first, self.last = rows, first, last
        live = T.column(rows, "live").to_numpy(zero_copy_only=False) > 0
        self.live = live
        self.begins = T.column(rows, "begins").to_numpy()[live]
        self.cut = T.column(rows, "cut").to_numpy(zero_copy_only=False)[live].astype(np.int64)

    def name(self) -> tuple[int, bool]:
        """Of a slice at a task's edge: its task, and whether it is the first there."""
        return T.column(self.rows, "part")[0].as_py(), self.first


def _slices(batches: Iterator[pa.RecordBatch], edges_only: bool = False) -> Iterator[list[Slice]]:
    """The conversations of a task in order, whole ones in lists of some rows; the last waits for the task's end."""
    held: list[pa.RecordBatch] = []
    size, first = 0, True

    def cut_up(last: bool) -> tuple[list[Slice], list[pa.RecordBatch]]:
        nonlocal first
        rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        ids = T.column(rows, "conv_id")
        missing, ids = ids.is_null().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy()
        new = np.flatnonzero((ids[1:] != ids[:-1]) | (missing[1:] != missing[:-1])) + 1
        bounds = [0, *new.tolist(), len(ids)]
        parts = [rows.slice(a, b - a) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        rest = [] if last else [parts.pop()]
        found = [Slice(p, first and k == 0, last and k == len(parts) - 1) for k, p in enumerate(parts) if not edges_only or (first and k == 0) or (last and k == len(parts) - 1)]
        first = first and not parts
        return found, rest

    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += batch.num_rows
        if size >= HELD_ROWS:
            found, held = cut_up(False)
            # A conversation that fills all that is held is not cut up again before it has doubled.
            size = 0 if found else -sum(b.num_rows for b in held)
            yield found
    if held:
        yield cut_up(True)[0]


EDGES = "part int, first boolean, last boolean, conv_id bigint, numbers array<bigint>"


def _edge(found: list[tuple[Slice, list[int]]]) -> pa.RecordBatch:
    """One row for each slice at a task's edge."""
    slices = [s for s, _ in found]
    return pa.RecordBatch.from_arrays(
        [
            pa.array([s.name()[0] for s in slices], pa.int32()),
            pa.array([s.first for s in slices], pa.bool_()),
            pa.array([s.last for s in slices], pa.bool_()),
            pa.array([T.column(s.rows, "conv_id")[0].as_py() for s in slices], pa.int64()),
            pa.array([n for _, n in found], pa.list_(pa.int64())),
        ],
        ["part", "first", "last", "conv_id", "numbers"],
    )


def _passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Costs from each state before an edge slice to each state behind it: one run for each state behind."""
    units = closed(np.where(np.eye(4, dtype=bool), 0, FAR))
    for slices in _slices(batches, edges_only=True):
        found = []
        for s in slices:
            chunks = Chunks([s.begins] * 4, [s.cut] * 4, list(units))
            found.append((s, np.concatenate([chunks.begin(k, units[k]) for k in STATES]).tolist()))
        yield _edge(found)


def _exits(ends: dict[tuple[int, bool], list[int]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The state behind an edge slice from each state before it."""
        for slices in _slices(batches, edges_only=True):
            slices = [s for s in slices if s.name() in ends]
            chunks = Chunks([s.begins for s in slices], [s.cut for s in slices], [np.array(ends[s.name()]) for s in slices])
            yield _edge([(s, [chunks.trace(k, len(s.begins), state)[1] for state in STATES]) for k, s in enumerate(slices)])

    return mapped


def _chains(edges: list) -> list[list]:
    """Slices of conversations that cross tasks, in order; each task has two edges at most."""
    chains, last = [], None
    for e in sorted(edges, key=lambda e: (e.part, not e.first)):
        if e.first and last is not None and last.conv_id == e.conv_id:
            if last is chains[-1][-1] if chains else False:
                chains[-1].append(e)
            else:
                chains.append([last, e])
        if e.last:
            last = e
    return chains


def _stitched(placed: DataFrame) -> tuple[dict, dict]:
    """Vectors behind, and states before, the slices of conversations that cross tasks: a few numbers a task."""
    needed = placed.select("conv_id", "begins", "cut", "live", "part")
    chains = _chains(needed.mapInArrow(_passages, EDGES).collect())
    ends: dict[tuple[int, bool], list[int]] = {}
    for chain in chains:
        end = FINAL
        for e in reversed(chain):
            ends[e.part, e.first] = end.tolist()
            by_state = np.array(e.numbers).reshape(4, 4)  # line: state behind, column: state before
            end = (by_state + end[:, None]).min(axis=0)
            end = end - end.min()
    states: dict[tuple[int, bool], int] = {}
    if chains:
        exits = {(e.part, e.first): e.numbers for e in needed.mapInArrow(_exits(ends), EDGES).collect()}
        for chain in chains:
            state = START
            for e in chain:
                states[e.part, e.first] = state
                state = exits[e.part, e.first][state]
            # Only the last slice of a chain ends its conversation.
            for e in chain[:-1]:
                states[e.part, e.first] += 4
    return ends, states


EDITED = "conv_id bigint, turn bigint, role string, digest binary, n bigint, blank boolean, cut boolean, live int, edits string"


def edits(conversations: DataFrame, partitions: int | None = None) -> DataFrame:
    """Counted rows with the letters of their edits: inserts in front, the own letter, a D for each further copy."""
    placed = placed_rows(conversations, partitions)
    ends, states = _stitched(placed)
    names = [c.split(" ")[0] for c in EDITED.split(", ")]

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for slices in _slices(batches):
            behind = [np.array(ends.get(s.name(), FINAL)) if s.first or s.last else FINAL for s in slices]
            chunks = Chunks([s.begins for s in slices], [s.cut for s in slices], behind)
            for k, s in enumerate(slices):
                state = states.get(s.name(), START) if s.first or s.last else START
                goes_on, state = state >= 4, state % 4
                letters, state = chunks.trace(k, len(s.begins), state)
                own = iter(letters)
                written = [(next(own) if live else "") + "D" * (n - live) for live, n in zip(s.live.tolist(), T.column(s.rows, "n").to_pylist(), strict=True)]
                while not goes_on and state not in (START, ASSISTANT):
                    written[-1] += "I"
                    state = AFTER_INSERT[state]
                yield pa.RecordBatch.from_arrays([*[T.column(s.rows, c) for c in names[:-1]], pa.array(written, pa.string())], names)

    return placed.select(*names[:-1], "begins", "part").mapInArrow(_fewer_batches(mapped), EDITED)


def _fewer_batches(mapped: Callable) -> Callable:
    """Conversations are short: hand on many of them in one batch."""

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in mapped(batches):
            held.append(batch)
            size += batch.num_rows
            if size >= 10_000:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held, size = [], 0
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()

    return joined


# -- conversations as a whole ------------------------------------------------------------------------


class _Conversation:
    """Figures and repaired rows of one conversation, from its rows in order."""

    def __init__(self) -> None:
        self.blank = self.duplicate = self.truncated = self.illegal = self.cost = self.distinct = 0
        self.least: int | None = None
        self.most: int | None = None
        self.before: str | None = None
        self.audit: list[str] = []
        self.state = START
        self.waiting: str | None = None  # role of the row whose text comes next
        self.behind: list[str] = []  # roles of inserts behind it

    def row(self, turn: int | None, role: str, n: int, blank: bool, cut: bool, live: int, letters: str) -> Iterator[tuple[str, str]]:
        """Takes a counted row; yields inserted rows that come before its text."""
        self.audit.append(letters)
        if turn is not None:
            self.distinct += turn != self.most
            self.least = turn if self.least is None else self.least
            self.most = turn
        if blank:
            self.blank += n
        else:
            self.duplicate += n - live
            self.truncated += live and cut
        initial = role[:1]
        if self.before is not None:
            self.illegal += self.before + initial not in LEGAL
        self.illegal += n - 1
        self.before = initial
        for letter in letters:
            if letter == "I":
                self.state = AFTER_INSERT[self.state]
                self.cost += INSERT
                if self.waiting is None:
                    yield ROLE[self.state], ""
                else:
                    self.behind.append(ROLE[self.state])
            elif letter == "D":
                self.cost += DELETE
            else:
                self.state = kept(self.state, BEGINS[initial]) if letter == "K" else AFTER_INSERT[self.state]
                self.cost += cut * CUT + (REROLE if letter == "R" else 0)
                self.waiting = role if letter == "K" else ROLE[self.state]

    def text(self, text: str) -> Iterator[tuple[str, str]]:
        """Takes the text of the row before; yields it and the inserts behind it, once for equal rows."""
        if self.waiting is not None:
            yield self.waiting, text
            for role in self.behind:
                yield role, ""
            self.waiting, self.behind = None, []

    def gaps(self) -> int:
        return 0 if self.least is None else self.most - self.least + 1 - self.distinct


# Both kinds of rows of the last pass: a counted row with its edits, and a text behind it.
BOTH = [*KEY, "kind", "n", "blank", "cut", "live", "edits", "text"]


def _in_order(conversations: DataFrame, partitions: int | None) -> DataFrame:
    """Counted rows and texts of each conversation, by conversation and in order."""
    edited = edits(conversations, partitions)
    types = {f.name: f.dataType for f in edited.schema}
    counted = edited.withColumns({"kind": F.lit(0), "text": F.lit(None).cast("string")})
    texts = _texts(conversations).filter(F.rtrim(F.col("text"), F.lit(SPACE_CHARACTERS)) != "").withColumn("kind", F.lit(1))
    texts = texts.withColumns({c: F.lit(None).cast(types[c]) for c in ("n", "blank", "cut", "live", "edits")})
    both = counted.select(*BOTH).unionByName(texts.select(*BOTH))
    return both.repartition("conv_id").sortWithinPartitions(*KEY, "kind")


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, _Conversation, str | None, str | None]]:
    """(conv_id, conversation, role, text) of each repaired row in order; (conv_id, conversation, None, None) at its end."""
    last, now = None, None
    for batch in batches:
        for at in range(0, batch.num_rows, 1000):
            columns = [T.column(batch, c).slice(at, 1000).to_pylist() for c in BOTH if c != "digest"]
            for conv_id, turn, role, kind, n, blank, cut, live, letters, text in zip(*columns, strict=True):
                if now is None or conv_id != last:
                    if now is not None:
                        yield last, now, None, None
                    last, now = conv_id, _Conversation()
                for shown in now.text(text) if kind else now.row(turn, role, n, blank, cut, live, letters):
                    yield last, now, *shown
    if now is not None:
        yield last, now, None, None


def repaired_rows(conversations: DataFrame, partitions: int | None = None) -> DataFrame:
    """(conv_id, place, role, text) of every repaired conversation, places from 0; one that is empty afterwards has no rows."""

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        place = 0
        for conv_id, _, role, text in _conversations(batches):
            if role is None:
                place = 0
                continue
            rows.append((conv_id, place, role, text))
            place += 1
            if len(rows) >= 1000:
                yield _batch(rows, REPAIRED)
                rows = []
        yield _batch(rows, REPAIRED)

    return _in_order(conversations, partitions).mapInArrow(mapped, REPAIRED)


REPAIRED = "conv_id bigint, place bigint, role string, text string"
REPORT = (
    "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, "
    "audit string, repaired_sha256 string"
)
_ARROW = {"bigint": pa.int64(), "string": pa.string()}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [f.split(" ") for f in schema.split(", ")]
    arrays = [pa.array([r[k] for r in rows], _ARROW[kind]) for k, (_, kind) in enumerate(fields)]
    return pa.RecordBatch.from_arrays(arrays, [name for name, _ in fields])


def audits(conversations: DataFrame, partitions: int | None = None) -> DataFrame:
    """Figures, audit and digest of the repaired rows of every conversation that has rows."""

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        digest, separator = hashlib.sha256(), ""
        for conv_id, found, role, text in _conversations(batches):
            if role is not None:
                digest.update(f"{separator}{role}:{text}".encode())
                separator = "\n"
                continue
            numbers = found.gaps(), found.blank, found.duplicate, found.truncated, found.illegal, found.cost
            rows.append((conv_id, *numbers, "".join(found.audit), digest.hexdigest()))
            digest, separator = hashlib.sha256(), ""
            if len(rows) >= 1000:
                yield _batch(rows, REPORT)
                rows = []
        yield _batch(rows, REPORT)

    return _in_order(conversations, partitions).mapInArrow(mapped, REPORT)


def repair_report(conversations: DataFrame, partitions: int | None = None) -> DataFrame:
    """``audits`` of the damaged conversations, with every conversation that there was before."""
    found = audits(damage(conversations), partitions)
    every = conversations.select(F.col("conv_id").cast("bigint").alias("_every")).distinct()
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    empty = F.lit(hashlib.sha256().hexdigest())
    return every.join(found, every["_every"].eqNullSafe(found["conv_id"]), "left").select(
        F.col("_every").alias("conv_id"),
        *[F.coalesce(c, F.lit(0)).alias(c) for c in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", empty).alias("repaired_sha256"),
    )
