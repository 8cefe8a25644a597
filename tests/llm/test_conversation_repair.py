"""Repaired conversations against a plain search over all edits, whatever the tasks that hold them."""

from __future__ import annotations

import collections
import functools
import hashlib
import itertools
import random
import sys
import zlib

import numpy as np
import pytest

from tierlake.llm import conversation_repair as C, queries

SCHEMA = "conv_id bigint, turn bigint, role string, text string, audit string, part string"
WHITE = " \t\n\x0b\x0c\r"


def plain_damage(rows: list[tuple]) -> list[tuple]:
    out = []
    for conv_id, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        fault = zlib.crc32(f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if fault == 1 else "".join(c for c in text if c not in ".!?") if fault == 2 else text
        out += [(conv_id, turn, "user" if fault == 4 else role, text)] * {0: 0, 3: 2}.get(fault, 1)
    return out


def cheapest(rows: list[tuple[str, bool, bool]]) -> tuple[int, str]:
    """(cost, audit) over all edits of (initial, must go, truncated) by plain recursion over places and patterns."""
    sys.setrecursionlimit(100_000)
    fits = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    @functools.cache
    def best(i: int, at: str, inserts: int) -> tuple[int, str]:
        ways = [(0, "")] if i == len(rows) and at in ("", "a") else []
        if inserts < 3:
            for own in "ua":
                if (at, own) in fits:
                    cost, audit = best(i, own, inserts + 1)
                    ways.append((cost + 2, "I" + audit))
        if i < len(rows):
            initial, gone, cut = rows[i]
            cost, audit = best(i + 1, at, 0)
            ways.append((cost + 3, "D" + audit))
            if not gone:
                for own, letter, price in [(initial, "K", 0), ("u", "R", 2), ("a", "R", 2)]:
                    if (at, own) in fits:
                        cost, audit = best(i + 1, own, 0)
                        ways.append((cost + price + cut, letter + audit))
        return min(ways, default=(10**9, ""))

    return best(0, "", 0)


def plain(rows: list[tuple]) -> tuple:
    """The report's row, without its id, of damaged (turn, role, text) rows in order."""
    seen, marked, counts = set(), [], collections.Counter()
    for _, role, text in rows:
        blank, repeated = not text.strip(WHITE), (role, text) in seen
        cut = not blank and text.rstrip(WHITE)[-1] not in ".!?"
        counts["blank" if blank else "duplicate" if repeated else "truncated" if cut else "fine"] += 1
        marked.append((role[:1], blank or repeated, cut))
        seen.add((role, text))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in itertools.pairwise(marked))
    cost, audit = cheapest(marked)
    lines, at, left = [], "", iter(rows)
    for letter in audit:
        own = "a" if at == "u" else "u"
        if letter == "I":
            lines.append({"u": "user", "a": "assistant"}[own] + ":")
            at = own
            continue
        _, role, text = next(left)
        if letter != "D":
            lines.append((role if letter == "K" else {"u": "user", "a": "assistant"}[own]) + ":" + text)
            at = role[0] if letter == "K" else own
    digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, digest


def expected(rows: list[tuple], damaged: bool = True) -> dict:
    found = collections.defaultdict(list)
    for conv_id, *row in plain_damage(rows) if damaged else rows:
        found[conv_id].append(tuple(row))

    def order(row):
        turn, role, text = row
        return turn is not None, turn or 0, role.encode(), hashlib.sha256(text.encode()).digest()

    return {c: plain(sorted(found.get(c, []), key=order)) for c in {r[0] for r in rows}}


def conversations(seed: int, count: int, longest: int) -> list[tuple]:
    rng = random.Random(seed)
    texts = ["Yes.", "no", "What?", "", " \n", "fine !", "So it is. ", "ü…", "x" * 50]
    out = []
    for conv_id in range(count):
        n = rng.randint(0, longest)
        for turn in range(n):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "u", "", "Assistant", None])
            text = rng.choice([None, *texts, *[f"{rng.random()}{end}" for end in ("", ".", "!", "?")] * 3])
            out.append((conv_id, rng.choice([turn, turn, turn, turn * 2, None]), role, text))
    return out


def report(df, partitions=None) -> dict:
    found = C.repair_report(df, partitions).collect()
    assert len({r.conv_id for r in found}) == len(found)
    return {r.conv_id: tuple(r)[1:] for r in found}


def frame(spark, rows):
    return spark.createDataFrame([(*r, "own", "own") for r in rows], SCHEMA).repartition(3)


def test_given_conversations(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    found = {r.conv_id: tuple(r)[1:] for r in queries.op11_conversation_repair(spark, sf_dir).collect()}
    assert found == expected(rows)


@pytest.mark.parametrize("partitions", [1, 7])
def test_awkward_conversations(spark, partitions):
    rows = conversations(1, 150, 12) + [(None, 1, "user", "a."), (None, 2, "assistant", "b."), (None, None, None, None), (999, None, None, None)]
    rows += [rows[3], rows[3], rows[10]]
    assert report(frame(spark, rows), partitions) == expected(rows)


@pytest.mark.parametrize("partitions", [1, 5, 23])
def test_long_conversations_in_many_tasks(spark, partitions):
    rng = random.Random(9)
    rows = [(1, t, rng.choice(["user", "assistant"]), rng.choice([f"{t}.", f"{t}"])) for t in range(700)]
    # Truncated turns of one role: two ways that never become parallel; and rows that all must go.
    rows += [(2, t, "user", f"{t}") for t in range(600)] + [(3, t, "user", "same.") for t in range(500)]
    rows += [(4, t, ("user", "assistant")[t % 2], f"{t}.") for t in range(400)] + [(5, 0, "user", "hi.")] * 300 + conversations(3, 20, 6)
    assert report(frame(spark, rows), partitions) == expected(rows)


def test_repaired_rows_are_what_the_digest_covers(spark):
    rows = [r for r in conversations(4, 40, 10) if None not in r]
    df = frame(spark, rows)
    lines = collections.defaultdict(list)
    for r in sorted(C.repaired_rows(df, 4).collect(), key=lambda r: (r.conv_id, r.place)):
        assert r.place == len(lines[r.conv_id])
        lines[r.conv_id].append((r.role, r.text))
    audits = {r.conv_id: r for r in C.audits(df).collect()}
    assert {k: tuple(r)[1:] for k, r in audits.items()} == expected(rows, damaged=False)
    for conv_id, r in audits.items():
        text = "\n".join(f"{a}:{b}" for a, b in lines[conv_id])
        assert r.repaired_sha256 == hashlib.sha256(text.encode()).hexdigest()
        initials = "".join(a[0] for a, _ in lines[conv_id])
        assert initials.removeprefix("s") == "ua" * (len(initials) // 2) and (initials != "s")


def test_chunks_equal_one_run_from_the_end():
    rng = np.random.default_rng(3)
    for length, kinds in [(1, 4), (31, 4), (32, 4), (33, 4), (1000, 4), (5000, 1), (5000, 3)]:
        begins, cut = rng.integers(1 if kinds == 1 else 0, 2 if kinds == 1 else kinds, length), rng.integers(1 if kinds == 1 else 0, 2, length)
        chunks = C.Chunks([begins, begins[:0], begins[::-1]], [cut, cut[:0], cut[::-1]], [C.FINAL] * 3)
        for k, (b, c) in enumerate([(begins, cut), (begins[:0], cut[:0]), (begins[::-1], cut[::-1])]):
            after = C.FINAL[None]
            for i in range(len(b) - 1, -1, -1):
                after = C.step(after, b[i : i + 1], c[i : i + 1])
            assert (after[0] == chunks.begin(k, C.FINAL)).all()
        assert kinds == 1 or chunks.reruns <= 2 * len(chunks.last)


def test_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert C.repair_report(none).collect() == [] and C.repaired_rows(none).collect() == []
