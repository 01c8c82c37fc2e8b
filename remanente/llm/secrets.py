"""Secrets in texts: all rules in one deterministic automaton, one pass over a text's bytes.

Each rule's regex becomes a position automaton (a state for each letter of the regex, no empty
moves). Subset construction runs all rules side by side: a combined state holds, for each rule, the
sets of positions of the attempts still open, leftmost first, or the one attempt that has matched
and grows until it dies. States that no further text can tell apart are merged. The result is one
array of next states and one of events, by state and byte; scanning is one look-up for each byte.

A rule must be *settled by its first match*: once an attempt can end, every further byte either
lets it end there too or kills it, and no attempt further left may still be open. Rules for which
that fails are refused when the automaton is built, so leftmost-longest matches need no way back.
Where a match begins is found from its first possible end, by running the rule backwards.

Matches of one rule do not overlap. A match is dropped, not retried, if it has fewer than ``tail``
bytes from its first possible end on. Base rules come first and are reported as they are; the others
add the forms of well-known issuers and key files.

Null text counts as empty: no spans. Repeated rows each give their row. Very long texts are scanned
like others; memory is one text. Only doc_id and text are used, so other columns cannot clash. An
empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
from pyspark.sql import DataFrame

from remanente.llm.common import over_texts, texts


@dataclass(frozen=True)
class Rule:
    """``tail``: least number of bytes of a match from its first possible end on."""

    name: str
    pattern: str
    tail: int = 1


#: The base forms, whose order is the order of kinds.
BASE = (
    Rule(
        "assign",
        r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+""",
        tail=12,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", tail=14),
    # A run is 16 long with 11 more bytes from its sixth on; shorter runs are too common for events.
    Rule("hex", r"[0-9a-f]{6,}", tail=11),
)
#: Forms of keys that well-known issuers give out, and heads of private key files.
ADDED = (
    Rule("github", r"gh[opsur]_[A-Za-z0-9]+", tail=36),
    Rule("stripe", r"[rs]k_(live|test)_[A-Za-z0-9]+", tail=16),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", tail=10),
    Rule("google", r"AIza[A-Za-z0-9_-]+", tail=35),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", tail=16),
    Rule("private_key", r"-----BEGIN ([A-Z]+ )*PRIVATE KEY-----"),
)
#: Most combined states; rules that need more are refused rather than built for hours.
MOST_STATES = 20_000

_REPEAT = re.compile(r"\{(\d+)(,?)(\d*)\}")
_FEW = {"?": (0, 1), "*": (0, None), "+": (1, None)}


class _Reader:
    """Trees of a small regex syntax: sets, groups, ``|``, ``(?i:``, ``? * +`` and ``{m,n}``.

    A tree is ("set", bytes), ("all", trees), ("any", trees) or ("rep", tree, least, most).
    """

    def __init__(self, pattern: str):
        self.text, self.at, self.fold = pattern, 0, False

    def peek(self) -> str:
        return self.text[self.at : self.at + 1]

    def take(self) -> str:
        if self.at == len(self.text):
            raise ValueError(f"regex ends too early: {self.text}")
        self.at += 1
        return self.text[self.at - 1]

    def choice(self) -> tuple:
        options = [self.series()]
        while self.peek() == "|":
            self.take()
            options.append(self.series())
        return ("any", options)

    def series(self) -> tuple:
        parts = []
        while self.peek() not in ("", "|", ")"):
            part = self.atom()
            while m := _REPEAT.match(self.text, self.at):
                self.at = m.end()
                least = int(m[1])
                part = ("rep", part, least, int(m[3]) if m[3] else None if m[2] else least)
            if self.peek() and self.peek() in _FEW:
                part = ("rep", part, *_FEW[self.take()])
            parts.append(part)
        return ("all", parts)

    def atom(self) -> tuple:
        c = self.take()
        if c == "(":
            before = self.fold
            if self.text.startswith("?i:", self.at):
                self.at, self.fold = self.at + 3, True
            tree = self.choice()
            if self.take() != ")":
                raise ValueError(f"group without end: {self.text}")
            self.fold = before
            return tree
        if c == "[":
            return ("set", self.members())
        if c in _FEW or c in ".^$)]{":
            raise ValueError(f"{c} at {self.at - 1} is not supported: {self.text}")
        return ("set", self.folded({self.letter(c)}))

    def letter(self, c: str) -> int:
        if c == "\\":
            c = self.take()
            if c == "x":
                return int(self.take() + self.take(), 16)
            if c.isalnum():
                raise ValueError(f"\\{c} is not supported: {self.text}")
        if ord(c) > 127:
            raise ValueError(f"only ASCII letters are supported: {self.text}")
        return ord(c)

    def folded(self, found: set[int]) -> frozenset[int]:
        if self.fold:
            found |= {ord(chr(b).swapcase()) for b in found if chr(b).isalpha()}
        return frozenset(found)

    def members(self) -> frozenset[int]:
        found: set[int] = set()
        while self.peek() != "]":
            first = self.letter(self.take())
            last = first
            if self.peek() == "-" and self.text[self.at + 1 : self.at + 2] != "]":
                self.take()
                last = self.letter(self.take())
            found |= set(range(first, last + 1))
        self.take()
        return self.folded(found)


@dataclass
class Positions:
    """A rule's position automaton: bytes of each position, first and last ones, who follows whom."""

    sets: list[frozenset[int]] = field(default_factory=list)
    follow: list[set[int]] = field(default_factory=list)
    first: frozenset[int] = frozenset()
    last: frozenset[int] = frozenset()

    @classmethod
    def of(cls, pattern: str) -> Positions:
        reader = _Reader(pattern)
        tree = reader.choice()
        if reader.peek():
            raise ValueError(f"group without start: {pattern}")
        made = cls()
        empty, first, last = made.add(tree)
        if empty:
            raise ValueError(f"matches the empty text: {pattern}")
        made.first, made.last = frozenset(first), frozenset(last)
        return made

    def add(self, tree: tuple) -> tuple[bool, set[int], set[int]]:
        """(can be empty, first positions, last positions) of a tree, added to this automaton."""
        kind = tree[0]
        if kind == "set":
            self.sets.append(tree[1])
            self.follow.append(set())
            here = {len(self.sets) - 1}
            return False, here, here
        if kind == "any":
            parts = [self.add(t) for t in tree[1]]
            first, last = (set().union(*[p[k] for p in parts]) for k in (1, 2))
            return any(p[0] for p in parts), first, last
        if kind == "rep":
            _, inner, least, most = tree
            parts = [self.add(inner) for _ in range(max(least, most or 1, 1))]
            for k in range(least, len(parts)):
                parts[k] = (True, *parts[k][1:])
            joined = self.joined(parts)
            if most is None:
                _, first, last = parts[-1]
                for p in last:
                    self.follow[p] |= first
            return joined
        return self.joined([self.add(t) for t in tree[1]])

    def joined(self, parts: list[tuple[bool, set[int], set[int]]]) -> tuple[bool, set[int], set[int]]:
        empty, first, last = True, set(), set()
        for part_empty, part_first, part_last in parts:
            for p in last:
                self.follow[p] |= part_first
            if empty:
                first = first | part_first
            last = last | part_last if part_empty else set(part_last)
            empty = empty and part_empty
        return empty, first, last

    def start(self, data: bytes, end: int, floor: int) -> int:
        """Leftmost start, not before ``floor``, of a match whose last byte is at ``end``."""
        before: list[set[int]] = [set() for _ in self.sets]
        for p, after in enumerate(self.follow):
            for q in after:
                before[q].add(p)
        at, found = end, -1
        here = {p for p in self.last if data[at] in self.sets[p]}
        while here:
            if here & self.first:
                found = at
            at -= 1
            if at < floor:
                break
            here = {q for p in here for q in before[p] if data[at] in self.sets[q]}
        return found


#: Events of a rule on one byte.
MATCHED, ENDED = 1, 2
#: A rule's part of a combined state: whether it has matched, and the open attempts, leftmost first.
Part = tuple[bool, tuple[frozenset[int], ...]]


def step(rule: Rule, form: Positions, part: Part, byte: int) -> tuple[Part, int]:
    """The rule's next part and its events on a byte."""
    matched, attempts = part
    moved: list[frozenset[int]] = []
    seen: set[int] = set()
    for attempt in attempts:
        # A position that an attempt further left holds has the same future and wins.
        after = {q for p in attempt for q in form.follow[p] if byte in form.sets[q]} - seen
        if after:
            moved.append(frozenset(after))
            seen |= after
    if matched and moved:
        if not moved[0] & form.last:
            raise ValueError(f"rule {rule.name} can go on beyond its end without matching")
        return (True, tuple(moved)), 0
    events = ENDED if matched else 0
    fresh = {p for p in form.first if byte in form.sets[p]} - seen
    if fresh:
        moved.append(frozenset(fresh))
    for k, attempt in enumerate(moved):
        if attempt & form.last:
            if k:
                raise ValueError(f"rule {rule.name} can match while an earlier attempt is open")
            return (True, (attempt,)), events | MATCHED
    return (False, tuple(moved)), events


def classes(forms: list[Positions]) -> np.ndarray:
    """A number for each byte; bytes that all rules treat alike share one."""
    every = {s for f in forms for s in f.sets}
    marks: dict[tuple[bool, ...], int] = {}
    return np.array([marks.setdefault(tuple(b in s for s in every), len(marks)) for b in range(256)])


def merged(nexts: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """The block of each state: states in one block give the same events on every text."""
    _, block = np.unique(marks, axis=0, return_inverse=True)
    block = block.reshape(-1)
    while True:
        _, finer = np.unique(np.column_stack([block, block[nexts]]), axis=0, return_inverse=True)
        finer = finer.reshape(-1)
        if finer.max() == block.max():
            return finer
        block = finer


class Automaton:
    """All rules as arrays: next state and event number by state and class of bytes.

    ``events[k]`` lists (rule, MATCHED and/or ENDED); event 0 is none. ``open_at_end[state]`` lists
    the rules whose match ends with the text.
    """

    def __init__(self, rules: Iterable[Rule]):
        self.rules = tuple(rules)
        self.forms = [Positions.of(r.pattern) for r in self.rules]
        self.classes = classes(self.forms)
        sample = [int(np.argmax(self.classes == c)) for c in range(self.classes.max() + 1)]
        start: tuple[Part, ...] = tuple((False, ()) for _ in self.rules)
        numbers, queue = {start: 0}, [start]
        memo: dict[tuple[int, Part, int], tuple[Part, int]] = {}
        kinds: dict[tuple[tuple[int, int], ...], int] = {(): 0}
        nexts, marks = [], []
        for state in queue:
            to, event = [], []
            for byte in sample:
                parts, found = [], []
                for r, part in enumerate(state):
                    if (key := (r, part, byte)) not in memo:
                        memo[key] = step(self.rules[r], self.forms[r], part, byte)
                    after, what = memo[key]
                    parts.append(after)
                    if what:
                        found.append((r, what))
                after_all = tuple(parts)
                if after_all not in numbers:
                    if len(queue) == MOST_STATES:
                        raise ValueError(f"these rules need more than {MOST_STATES} states")
                    numbers[after_all] = len(queue)
                    queue.append(after_all)
                to.append(numbers[after_all])
                event.append(kinds.setdefault(tuple(found), len(kinds)))
            nexts.append(to)
            marks.append(event)
        wide, held = np.array(nexts), np.array([[m for m, _ in s] for s in queue]).reshape(len(queue), -1)
        block = merged(wide, np.column_stack([np.array(marks), held]))
        block = _from_zero(block)
        first = np.array([int(np.argmax(block == b)) for b in range(block.max() + 1)])
        self.next = block[wide[first]].astype(np.int32)
        self.event = np.array(marks)[first].astype(np.int32)
        self.events = list(kinds)
        self.open_at_end = [tuple(np.flatnonzero(held[f]).tolist()) for f in first]

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "rows"}

    @cached_property
    def rows(self) -> list[list]:
        """A list for each pair of state and event with which it is entered.

        Element b is the list entered on byte b; element 256 the number of the event, 257 the state.
        """
        pairs = {(0, 0): 0}
        entered = np.unique(np.column_stack([self.next.ravel(), self.event.ravel()]), axis=0)
        for state, event in entered.tolist():
            pairs.setdefault((state, event), len(pairs))
        rows: list[list] = [[] for _ in pairs]
        by_byte = self.classes.tolist()
        for (state, event), k in pairs.items():
            after = [
                rows[pairs[pair]]
                for pair in zip(self.next[state].tolist(), self.event[state].tolist(), strict=True)
            ]
            rows[k].extend([after[c] for c in by_byte])
            rows[k].extend([event, state])
        return rows

    def scan(self, data: bytes) -> list[tuple[int, int, int]]:
        """(start, rule, end) of every match, in order, as places in the bytes."""
        found: list[tuple[int, int, int]] = []
        begun, done = {}, [0] * len(self.rules)

        def end(rule: int, at: int) -> None:
            start, first_end = begun.pop(rule)
            done[rule] = at
            if at - first_end >= self.rules[rule].tail:
                found.append((start, rule, at))

        row = self.rows[0]
        for at, byte in enumerate(data):
            row = row[byte]
            if row[256]:
                for rule, what in self.events[row[256]]:
                    if what & ENDED:
                        end(rule, at)
                    if what & MATCHED:
                        begun[rule] = (self.forms[rule].start(data, at, done[rule]), at)
        for rule in self.open_at_end[row[257]]:
            end(rule, len(data))
        return sorted(found)

    def spans(self, text: str) -> list[tuple[int, int, int]]:
        """(start, rule, end) of every match, in order, as code points."""
        data = text.encode()
        found = self.scan(data)
        if not found or len(data) == len(text):
            return found
        places = sorted({p for s, _, e in found for p in (s, e)})
        points, count, last = {}, 0, 0
        for p in places:
            count += len(data[last:p].decode())
            points[p], last = count, p
        return [(points[s], r, points[e]) for s, r, e in found]


def _from_zero(block: np.ndarray) -> np.ndarray:
    """The same blocks, that of state 0 being number 0."""
    swapped = block.copy()
    swapped[block == block[0]], swapped[block == 0] = 0, block[0]
    return swapped


def shown(spans: list[tuple[int, int, int]], rules: tuple[Rule, ...]) -> str:
    return ",".join(f"{rules[r].name}:{a}:{b}" for a, r, b in spans)


def scan(docs: DataFrame, base: Iterable[Rule] = BASE, added: Iterable[Rule] = ADDED) -> DataFrame:
    """doc_id, n_ of each base rule, base_sha256, spans, n_added.

    The hash is of the base spans, ``kind:start:end`` by start, then kind as listed, comma-joined.
    """
    base = tuple(base)
    automaton = Automaton((*base, *added))
    shared = docs.sparkSession.sparkContext.broadcast(automaton)

    def rows(batch: list[str]) -> dict[str, list]:
        automaton = shared.value
        out: dict[str, list] = {f"n_{rule.name}": [] for rule in base}
        out |= {"base_sha256": [], "spans": [], "n_added": []}
        for text in batch:
            every = automaton.spans(text)
            own = [s for s in every if s[1] < len(base)]
            for k, rule in enumerate(base):
                out[f"n_{rule.name}"].append(sum(s[1] == k for s in own))
            out["base_sha256"].append(hashlib.sha256(shown(own, automaton.rules).encode()).hexdigest())
            out["spans"].append(shown(every, automaton.rules))
            out["n_added"].append(len(every) - len(own))
        return out

    counts = ", ".join(f"n_{rule.name} long" for rule in base)
    return over_texts(texts(docs), rows, f"{counts}, base_sha256 string, spans string, n_added long")
