"""Conversation repair: the banded table against all edit sequences, and whole reports."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from functools import cache

import cases
import pytest
from pyspark.sql import functions as F

from remanente.llm import turn_repair
from remanente.llm.turn_repair import Turns, align

SHAPE = "conv_id long, turn long, role string, text string"


def cheapest(turns: Turns) -> tuple[int, str]:
    """Least (cost, audit) over all edits, by the state of the grammar."""
    after = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    @cache
    def best(i: int, state: str, inserted: int) -> tuple[int, str]:
        ends = [(0, "")] if i == len(turns) and state in ("", "a") else [(1 << 30, "")]

        def add(cost: int, letter: str, at: int, to: str, n: int = 0) -> None:
            rest, audit = best(at, to, n)
            ends.append((cost + rest, letter + audit))

        if inserted < 3:
            for symbol in "ua":
                if (state, symbol) in after:
                    add(5, "I", i, symbol, inserted + 1)
        if i < len(turns):
            add(2, "D", i + 1, state)
            if not turns.forced[i]:
                extra = 5 * turns.cut[i]
                if (state, turns.initial[i]) in after:
                    add(extra, "K", i + 1, turns.initial[i])
                for symbol in "ua":
                    if (state, symbol) in after:
                        add(extra + 1, "R", i + 1, symbol)
        return min(ends)

    return best(0, "", 0)


def drawn(draw: random.Random, n: int) -> Turns:
    turns = Turns()
    letters = draw.choice(["ua", "uas", "uuaast", ["u", "a", "", " "]])
    for _ in range(n):
        turns.add(draw.choice(letters), draw.random() < 0.15, draw.random() < 0.3)
    return turns


@pytest.mark.parametrize("kept", [4_000_000, 10])
def test_alignment_equals_all_edits(monkeypatch, kept):
    monkeypatch.setattr(turn_repair, "KEPT_CELLS", kept)
    draw = random.Random(kept)
    for _ in range(4000):
        turns = drawn(draw, draw.randrange(11))
        assert align(turns) == cheapest(turns), turns


def test_long_conversation(monkeypatch):
    draw = random.Random(2)
    turns = Turns()
    for k in range(400):
        if draw.random() > 0.05:
            turns.add("ua"[k % 2], draw.random() < 0.1, draw.random() < 0.05)
    whole = align(turns)
    monkeypatch.setattr(turn_repair, "KEPT_CELLS", 10)
    assert align(turns) == whole
    table = turn_repair.Table(turns)
    low, high = table.band(200)
    assert high - low < 200  # the band leaves most of the table out


def brute(rows: list[tuple]) -> dict:
    """The report, row by row in Python."""
    by_conv: dict = {}
    for conv, turn, role, text in rows:
        own = by_conv.setdefault(conv, [])
        named = ":".join(" " if x is None else str(x) for x in (conv, turn))
        kind = zlib.crc32(named.encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        own += [(turn, role, text)] * (2 if kind == 3 else 1)
    out = {}
    for conv, own in by_conv.items():
        own.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1], hashlib.md5(x[2].encode()).hexdigest()))
        turns, seen, faults, illegal = Turns(), set(), [], 0
        for k, (_, role, text) in enumerate(own):
            bare = text.rstrip(" \t\n\x0b\f\r")
            fault = (
                "blank" if not bare else "duplicate" if (role, text) in seen
                else "truncated" if bare[-1] not in ".!?" else ""
            )
            seen.add((role, text))
            faults.append(fault)
            illegal += k > 0 and own[k - 1][1][:1] + role[:1] not in ("su", "ua", "au")
            turns.add(role[:1], fault in ("blank", "duplicate"), fault == "truncated")
        cost, audit = cheapest(turns)
        left, lines, last = list(own), [], ""
        for letter in audit:
            other = "assistant" if last == "u" else "user"
            role, text = (other, "") if letter == "I" else left.pop(0)[1:]
            if letter != "D":
                role = other if letter == "R" else role
                lines.append(f"{role}:{text}")
                last = role[:1]
        times = [t for t, _, _ in own if t is not None]
        out[conv] = {
            "conv_id": conv,
            "gaps": max(times) - min(times) + 1 - len(set(times)) if times else 0,
            **{f: faults.count(f) for f in ("blank", "duplicate", "truncated")},
            "illegal": illegal,
            "cost": cost,
            "audit": audit,
            "repaired_sha256": hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        }
    return out


def conversations(n: int = 60) -> list[tuple]:
    draw = random.Random(4)
    out: list[tuple] = []
    for conv in range(n):
        for turn in range(draw.randrange(1, 9)):
            role = draw.choice(["user", "assistant", "assistant", "system", "tool", None, ""])
            role = ("user", "assistant")[turn % 2] if draw.random() < 0.8 else role
            text = draw.choice(["Yes.", "No!", "why", "", " \t", None, "á?\n", cases.prose(draw, 20)])
            when = None if draw.random() < 0.05 else turn * draw.choice([1, 1, 3])
            out.append((conv, when, role, text))
            if draw.random() < 0.05:
                out.append(out[-1])
    out += [(None, 1, "user", "Hi."), (None, 0, "system", "x."), (None, None, None, None)]
    return [*out, (900, 0, "user", "word " * 50_000 + "."), (900, 1, "assistant", "Yes.")]


def test_report_equals_brute_force(spark):
    rows = conversations()
    df = spark.createDataFrame(rows, SHAPE).repartition(4)
    df = cases.crowded(df, "audit", "digest", "part", "kind", "own_id", "place")
    found = turn_repair.report(df).collect()
    want = brute(rows)
    assert len(found) == len(want)
    for row in found:
        assert row.asDict() == want[row.conv_id]


def test_repaired_turns(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "There!"), (1, 2, "assistant", ""), (2, 0, "tool", "x.")]
    df = spark.createDataFrame(rows, SHAPE)
    out = turn_repair.repaired(df).orderBy("conv_id", "place").collect()
    assert [(r.conv_id, r.place, r.edit, r.role, r.text) for r in out] == [
        (1, 0, "K", "user", "Hi."),
        (1, 1, "R", "assistant", "There!"),
    ]


def test_lost_and_empty(spark):
    lost = next(k for k in range(1000) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    df = spark.createDataFrame([(lost, 0, "user", "Hi.")], SHAPE)
    row = turn_repair.report(df).collect()[0]
    assert (row.cost, row.audit, row.repaired_sha256) == (0, "", hashlib.sha256(b"").hexdigest())
    assert turn_repair.report(df.where(F.lit(False))).collect() == []
