"""Conversation repair by Wagner-Fischer alignment to an alternating target.

A repaired conversation is empty, or an optional system turn and then user and assistant in turn,
ending with the assistant. Turns are kept (0), get the role that the target asks for (1), are
deleted (2; blank and duplicate turns must be), or an empty turn is inserted (5); a truncated turn
that stays costs 5 more. The cheapest repair wins; of equally cheap ones that whose audit, the
initials of its edits (Keep, Rerole, Delete, Insert) in order, is least.

The target of a length is one string, and the last L turns of any target are the same string. So one
edit-distance table, filled from the end, holds the costs of all lengths: entry (i, L) is the price
of turning the rows from i on into the last L turns. A second layer holds those that still need
their system turn. A quick repair gives the incumbent cost; an entry whose lower bound (forced and
truncated rows cost 2 each at least, too many rows 2 each, too few 3 or 5 each) exceeds it cannot
lie on a cheapest path, which leaves a band around the diagonal and few feasible lengths. Each
length of least cost is traced back, and the audits are compared.

Spark deals rows out by conversation and sorts them, first without their texts: only flags, role and
a 128-bit digest travel. The alignment of a conversation holds its flags, not its texts, and
table rows at every root-of-n-th turn, from which the others are made again when the audit is read.
Then audits and texts are streamed side by side, so a conversation with a large part of all rows
takes one task's time, but not its memory.

Nulls: a null role, text or (in keys of ``damaged``) id or turn counts as one space; null ids form one
conversation; null turns come first. Ties in turn are ordered by role, then digest of the text, so
repeated rows lie side by side and the later ones are duplicates. A role counts by its first letter;
an empty one fits nothing. Very long texts are hashed as they come. Other columns than the four are
left out, so none can clash. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from math import isqrt
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from remanente.llm.common import findable, written

RULES = 20
DROPPED, EMPTIED, UNSTOPPED, REPEATED, REROLED = range(5)
#: What blank texts consist of, and how a turn ends that is not truncated.
BLANKS = " \t\n\x0b\f\r"
STOPS = (".", "!", "?")

REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: Larger than any cost; not so large that sums overflow.
NEVER = 1 << 60
#: Table entries that are kept at once without making them again.
KEPT_CELLS = 4_000_000


@dataclass
class Turns:
    """What the alignment needs of each turn: role initial, must go, truncated."""

    initial: list[str] = field(default_factory=list)
    forced: list[bool] = field(default_factory=list)
    cut: list[bool] = field(default_factory=list)

    def __len__(self) -> int:
        return len(self.initial)

    def add(self, initial: str, forced: bool, cut: bool) -> None:
        self.initial.append(initial)
        self.forced.append(forced)
        self.cut.append(cut and not forced)


def quick_cost(turns: Turns) -> int:
    """Cost of a repair found in one pass: the incumbent."""
    stay = [k for k in range(len(turns)) if not turns.forced[k]]
    cost, wanted, first, paired = DELETE * (len(turns) - len(stay)), "u", True, False
    for at, k in enumerate(stay):
        initial = turns.initial[k]
        extra = TRUNCATED * turns.cut[k]
        if first and initial == "s":
            cost, first = cost + extra, False
            continue
        if initial != wanted:
            after = turns.initial[stay[at + 1]] if at + 1 < len(stay) else ""
            if after == wanted:
                cost += DELETE
                continue
            extra += REROLE
        cost, first, paired = cost + extra, False, True
        wanted = "a" if wanted == "u" else "u"
    if wanted == "a":
        cost += INSERT
    elif not first and not paired:
        cost += 2 * INSERT  # a system turn alone stayed
    return min(cost, DELETE * len(turns))


@dataclass
class Row:
    """Entries of one table row from target length ``low`` on: without and with a system turn to come."""

    low: int
    plain: np.ndarray
    system: np.ndarray

    def cost(self, length: int, system: bool) -> int:
        cells, at = self.system if system else self.plain, length - self.low
        return int(cells[at]) if 0 <= at < len(cells) else NEVER


def window(row: Row, cells: np.ndarray, low: int, high: int) -> np.ndarray:
    """``cells`` of ``row`` for lengths low to high; NEVER where it has none."""
    out = np.full(high - low + 1, NEVER)
    a, b = max(low, row.low), min(high + 1, row.low + len(cells))
    if a < b:
        out[a - low : b - low] = cells[a - row.low : b - row.low]
    return out


class Table:
    """The banded table of a conversation."""

    def __init__(self, turns: Turns):
        self.turns, n = turns, len(turns)
        clean = [not (f or c) for f, c in zip(turns.forced, turns.cut, strict=True)]
        #: Of the rows from i on: how many are clean, how many truncated.
        self.clean = np.append(np.cumsum(clean[::-1], dtype=int)[::-1], 0).tolist()
        self.cut = np.append(np.cumsum(turns.cut[::-1], dtype=int)[::-1], 0).tolist()
        self.slack = quick_cost(turns) - DELETE * (n - self.clean[0])
        self.every = n if n * (self.slack + 4) <= KEPT_CELLS else isqrt(n) + 1

    def band(self, i: int) -> tuple[int, int]:
        """Least and largest length whose lower bound is within the incumbent.

        One more at the lower end, as a system turn uses a clean row without shortening the rest.
        """
        clean, cut, slack = self.clean[i], self.cut[i], self.slack
        dear = TRUNCATED - DELETE
        low = max(0, clean - slack // DELETE - 1)
        return low, clean + min(cut, slack // dear) + max(0, slack - dear * cut) // INSERT

    def last(self) -> Row:
        low, high = self.band(len(self.turns))
        plain = INSERT * np.arange(low, high + 1)
        return Row(low, plain, np.full(len(plain), NEVER))

    def before(self, after: Row, i: int) -> Row:
        """Row i from row i + 1."""
        low, high = self.band(i)
        lengths = np.arange(low, high + 1)
        initial, forced = self.turns.initial[i], self.turns.forced[i]
        extra = TRUNCATED * self.turns.cut[i]
        below = window(after, after.plain, low, high)
        plain = below + DELETE
        system = window(after, after.system, low, high) + DELETE
        if not forced:
            odd = (lengths % 2).astype(bool)  # an odd number of turns to come starts with "a"
            other = np.where(odd, initial != "a", initial != "u")
            plain = np.minimum(plain, window(after, after.plain, low - 1, high - 1) + extra + other * REROLE)
            if initial == "s":
                here = np.where(~odd & (lengths >= 2), below + extra, NEVER)
                system = np.minimum(system, here)
        # Inserting in front: the cheapest shorter rest, and 5 for each turn more.
        plain = np.minimum.accumulate(plain - INSERT * lengths) + INSERT * lengths
        return Row(low, np.minimum(plain, NEVER), np.minimum(system, NEVER))

    def rows(self, after: Row, high: int, low: int) -> list[Row]:
        """Rows low to high, given row ``high``."""
        out = [after]
        for i in range(high - 1, low - 1, -1):
            out.append(self.before(out[-1], i))
        return out[::-1]

    def marks(self) -> dict[int, Row]:
        """Every ``every``-th row, the first and the last."""
        n, row = len(self.turns), self.last()
        kept = {n: row}
        for i in range(n - 1, -1, -1):
            row = self.before(row, i)
            if i % self.every == 0:
                kept[i] = row
        return kept


@dataclass
class Trace:
    """A target that is being traced back: how much of it is to come, and the edits so far."""

    length: int
    system: bool
    edits: list[str] = field(default_factory=list)


def edit(trace: Trace, turns: Turns, here: Row, after: Row, i: int) -> bool:
    """Takes the least letter that stays on a cheapest path; whether row i is used up."""
    cost, extra = here.cost(trace.length, trace.system), TRUNCATED * turns.cut[i]
    if after.cost(trace.length, trace.system) + DELETE == cost:
        trace.edits.append("D")
        return True
    if trace.system:
        trace.edits.append("K")
        trace.system = False
        return True
    if trace.length and here.cost(trace.length - 1, False) + INSERT == cost:
        trace.edits.append("I")
        trace.length -= 1
        return False
    kept = turns.initial[i] == ("a" if trace.length % 2 else "u")
    assert after.cost(trace.length - 1, False) + extra + (not kept) * REROLE == cost
    trace.edits.append("K" if kept else "R")
    trace.length -= 1
    return True


def align(turns: Turns) -> tuple[int, str]:
    """Least cost, and the least audit of that cost."""
    n = len(turns)
    if not n:
        return 0, ""
    table = Table(turns)
    marks = table.marks()
    top = marks[0]
    ends = [
        (top.cost(length, system), length, system)
        for length in range(top.low + top.low % 2, top.low + len(top.plain), 2)
        for system in (False, True)
    ]
    cost = min(ends)[0]
    traces = [Trace(length, system) for c, length, system in ends if c == cost]
    for start in range(0, n, table.every):
        stop = min(start + table.every, n)
        rows = table.rows(marks[stop], stop, start)
        for trace in traces:
            for i in range(start, stop):
                while not edit(trace, turns, rows[i - start], rows[i - start + 1], i):
                    pass
    return cost, min("".join(t.edits) + "I" * t.length for t in traces)


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text after damage by the CRC of ``conv_id:turn``, modulo 20.

    0 drops the row, 1 empties its text, 2 takes out its sentence ends, 3 repeats it, 4 makes it the
    user's.
    """
    id_, turn = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn"))
    kind = F.crc32(F.concat(id_, F.lit(":"), turn)) % RULES
    role, text = (F.coalesce(c, F.lit(" ")) for c in ("role", "text"))
    return (
        conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), kind.alias("kind"))
        .where(F.col("kind") != DROPPED)
        .select(
            "conv_id",
            "turn",
            F.when(F.col("kind") == REROLED, "user").otherwise(F.col("role")).alias("role"),
            F.when(F.col("kind") == EMPTIED, "")
            .when(F.col("kind") == UNSTOPPED, F.translate("text", "".join(STOPS), ""))
            .otherwise(F.col("text"))
            .alias("text"),
            F.explode(F.sequence(F.lit(1), F.when(F.col("kind") == REPEATED, 2).otherwise(1))).alias("copy"),
        )
        .drop("copy")
    )


def filled(rows: DataFrame) -> DataFrame:
    role, text = (F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text"))
    return rows.select("conv_id", "turn", role, text).withColumn("digest", F.md5("text"))


ORDER = ("turn", "role", "digest")
FIGURES = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
LEGAL = {"su", "ua", "au"}


class Conversation:
    """Counts and flags of one conversation, row by row."""

    def __init__(self) -> None:
        self.turns = Turns()
        self.seen: set[tuple[str, str]] = set()
        self.counts = dict.fromkeys(FIGURES, 0)
        self.places: list[int] = []  # first, last, number of different turns

    def add(self, turn: int | None, role: str, digest: str, blank: bool, cut: bool) -> None:
        if turn is not None:
            if not self.places:
                self.places = [turn, turn, 1]
            elif turn != self.places[1]:
                self.places = [self.places[0], turn, self.places[2] + 1]
        twin = (role, digest) in self.seen
        self.seen.add((role, digest))
        fault = "blank" if blank else "duplicate" if twin else "truncated" if cut else None
        if fault:
            self.counts[fault] += 1
        if len(self.turns) and self.turns.initial[-1] + role[:1] not in LEGAL:
            self.counts["illegal"] += 1
        self.turns.add(role[:1], blank or twin, fault == "truncated")

    def result(self) -> tuple[str, dict[str, int]]:
        cost, audit = align(self.turns)
        first, last, different = self.places or (1, 0, 0)
        return audit, self.counts | {"cost": cost, "gaps": last - first + 1 - different}


def streamed(
    df: DataFrame, rows: Callable[[Iterator[tuple]], Iterator[tuple]], shape: T.StructType, most: int = 2048
) -> DataFrame:
    """``rows`` over a partition's rows as tuples, in order; at most ``most`` results in a batch."""
    findable(df.sparkSession)
    kinds = [to_arrow_type(f.dataType) for f in shape]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        each = (row for b in batches for row in zip(*[c.to_pylist() for c in b.columns], strict=True))
        made: list[tuple] = []
        size = 0
        for row in rows(each):
            made.append(row)
            size += sum(len(x) for x in row if isinstance(x, str))
            if len(made) == most or size > 1 << 24:
                yield batch(made)
                made, size = [], 0
        if made:
            yield batch(made)

    def batch(made: list[tuple]) -> pa.RecordBatch:
        columns = zip(*made, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=list(shape.names)
        )

    return df.mapInArrow(run, shape)


def groups(rows: Iterable[tuple]) -> Iterator[tuple[Any, Iterator[tuple]]]:
    """(id, its rows) of rows sorted by their first column; null is an id like others."""
    rows = iter(rows)
    held = next(rows, None)

    def of(key: Any) -> Iterator[tuple]:
        nonlocal held
        while held is not None and held[0] == key:
            row, held = held, None
            yield row
            held = next(rows, None)

    while held is not None:
        key = held[0]
        own = of(key)
        yield key, own
        for _ in own:  # what the reader left
            pass


def audits(rows: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit of turns as they are."""
    bare = F.rtrim(F.col("text"), F.lit(BLANKS))
    flags = (
        filled(rows)
        .select(
            "conv_id",
            "turn",
            "role",
            "digest",
            (bare == "").alias("blank"),
            (~F.right(bare, F.lit(1)).isin(*STOPS)).alias("cut"),
        )
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", *ORDER)
        .withColumn("turn", F.col("turn").cast("long"))
    )

    def run(each: Iterator[tuple]) -> Iterator[tuple]:
        for key, own in groups(each):
            conversation = Conversation()
            for _, turn, role, digest, blank, cut in own:
                conversation.add(turn, role, digest, blank, cut)
            audit, figures = conversation.result()
            yield (key, *figures.values(), audit)

    shape = T.StructType(
        [rows.schema["conv_id"], *[T.StructField(c, T.LongType()) for c in FIGURES]]
        + [T.StructField("audit", T.StringType())]
    )
    return streamed(flags, run, shape)


def replayed(rows: Iterator[tuple]) -> Iterator[tuple[str, str, str | None]]:
    """(edit, role, text) of each turn that stays, from the audit's row and then the turns."""
    *_, audit, _, _ = next(rows)
    last = ""
    for letter in audit:
        role = "assistant" if last == "u" else "user"
        text: str | None = ""
        if letter != "I":
            *_, own, text = next(rows)
            if letter == "D":
                continue
            role = own if letter == "K" else role
        last = role[:1]
        yield letter, role, text


def side_by_side(rows: DataFrame, found: DataFrame) -> DataFrame:
    """conv_id, audit, role, text: each conversation's audit, and then its turns in order."""
    schema = rows.schema
    heads = found.select(
        "conv_id",
        F.lit(0).alias("part"),
        F.lit(None).cast(schema["turn"].dataType).alias("turn"),
        F.lit(None).cast("string").alias("role"),
        F.lit(None).cast("string").alias("text"),
        F.lit(None).cast("string").alias("digest"),
        "audit",
    )
    turns = filled(rows).select(
        "conv_id", F.lit(1).alias("part"), "turn", "role", "text", "digest", F.lit(None).alias("audit")
    )
    return (
        heads.unionByName(turns)
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "part", *ORDER)
        .select("conv_id", "audit", "role", "text")
    )


def repaired(rows: DataFrame, found: DataFrame | None = None) -> DataFrame:
    """conv_id, place, edit, role, text of the turns after repair; ``found``: their audits, if at hand."""

    def run(each: Iterator[tuple]) -> Iterator[tuple]:
        for key, own in groups(each):
            for place, (letter, role, text) in enumerate(replayed(own)):
                yield key, place, letter, role, text

    shape = T._parse_datatype_string("place long, edit string, role string, text string")
    found = written(audits(rows), "audits") if found is None else found
    return streamed(side_by_side(rows, found), run, T.StructType([rows.schema["conv_id"], *shape]))


def digests(rows: DataFrame, found: DataFrame) -> DataFrame:
    """conv_id, audit, repaired_sha256 of the repaired ``role:text``, newline-joined."""

    def run(each: Iterator[tuple]) -> Iterator[tuple]:
        for key, own in groups(each):
            digest = hashlib.sha256()
            for place, (_, role, text) in enumerate(replayed(own)):
                digest.update(f"{'\n' * (place > 0)}{role}:{text}".encode())
            yield key, digest.hexdigest()

    shape = T.StructType([rows.schema["conv_id"], T.StructField("repaired_sha256", T.StringType())])
    return streamed(side_by_side(rows, found), run, shape)


def report(conversations: DataFrame) -> DataFrame:
    """One row for each original conv_id, after damage: counts, cost, audit, repaired_sha256."""
    rows = damaged(conversations)
    found = written(audits(rows), "audits")
    hashes = digests(rows, found)
    every = conversations.select("conv_id").distinct()
    out = every
    for part in (found, hashes):
        named = part.withColumnRenamed("conv_id", "own_id")
        out = out.join(named, F.col("conv_id").eqNullSafe(F.col("own_id")), "left").drop("own_id")
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    return out.select(
        "conv_id",
        *[F.coalesce(c, F.lit(0)).alias(c) for c in FIGURES],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", nothing).alias("repaired_sha256"),
    )
