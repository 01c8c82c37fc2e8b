"""Benchmark passages in training text, found with a generalised suffix automaton.

The automaton holds every run of words of the benchmark items. Training words stream through it;
its state gives the longest run of item words that ends at each word. A run of 13 words or more
marks its last 13 words as hit; an item of fewer words marks them where all of it occurs.

Null text has no words. An item without words never occurs. Repeated rows each give their row;
equal item_ids count as one item. Only ids and texts are used, so other columns cannot clash. Empty
tables give no rows, or no hits.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from remanente.llm.common import over_texts, packed, restored

WINDOW = 13
#: Words of the items that one automaton holds. More items take more automata, each with a pass.
AUTOMATON_WORDS = 100_000

#: Letters of words stay, A-Z lower-cased; every other byte becomes a blank.
_TO_WORDS = bytes(
    b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32
    for b in range(256)
)
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def words(text: str) -> list[bytes]:
    return text.encode().translate(_TO_WORDS).split()


class SuffixAutomaton:
    """All runs of words of some items; ``ends`` and ``windows`` tell which items they belong to."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.ids: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        known = [(name, [self.ids.setdefault(w, len(self.ids)) for w in ws]) for name, ws in items]
        for _, run in known:
            last = 0
            for w in run:
                last = self.extend(last, w)
        # The state that holds the last 13 words of a state's runs.
        self.at_window = [-1] * len(self.next)
        order = sorted(range(1, len(self.next)), key=self.length.__getitem__)
        for s in order:
            if self.length[s] >= window:
                up = self.at_window[self.link[s]]
                self.at_window[s] = up if up >= 0 else s
        self.windows: dict[int, set[str]] = {}
        self.ends: dict[int, list[tuple[int, str]]] = {}
        for name, run in known:
            state = 0
            for k, w in enumerate(run, 1):
                state = self.next[state][w]
                if k >= window:
                    self.windows.setdefault(self.at_window[state], set()).add(name)
            if 0 < len(run) < window:
                self.ends.setdefault(state, []).append((len(run), name))
        for s in order:  # whole short items that end with a state's runs
            if above := self.ends.get(self.link[s]):
                self.ends[s] = self.ends.get(s, []) + above
        sizes = [min(len(run), window) for _, run in known if run]
        self.shortest = min(sizes, default=math.inf)

    def extend(self, last: int, w: int) -> int:
        """The state after one more word of an item."""
        there = self.next[last].get(w)
        if there is not None and self.length[there] == self.length[last] + 1:
            return there
        if there is not None:
            return self.split(last, w, there)
        new = self.state(self.length[last] + 1, {}, 0)
        p = last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = new
            p = self.link[p]
        if p >= 0:
            there = self.next[p][w]
            fits = self.length[there] == self.length[p] + 1
            self.link[new] = there if fits else self.split(p, w, there)
        return new

    def split(self, p: int, w: int, there: int) -> int:
        """A state for the shorter runs of ``there``, those that come from ``p``."""
        short = self.state(self.length[p] + 1, dict(self.next[there]), self.link[there])
        self.link[there] = short
        while p >= 0 and self.next[p].get(w) == there:
            self.next[p][w] = short
            p = self.link[p]
        return short

    def state(self, length: int, following: dict[int, int], link: int) -> int:
        self.next.append(following)
        self.length.append(length)
        self.link.append(link)
        return len(self.next) - 1

    def matches(self, found: list[bytes]) -> Iterator[tuple[int, int, int]]:
        """Place after each matched word, state, and length of the longest match there.

        A word that no item has starts the automaton again, and a stretch between two such words
        that is shorter than any window cannot hold one.
        """
        ids = list(map(self.ids.get, found))
        if self.shortest == math.inf:
            return
        step, at, n = int(self.shortest), 0, len(ids)
        while at + step <= n:
            # Look from the end of the shortest window backwards for a word no item has.
            k = at + step - 1
            while k >= at and ids[k] is not None:
                k -= 1
            if k >= at:
                at = k + 1
                continue
            state = length = 0
            while at < n and (w := ids[at]) is not None:
                while w not in self.next[state]:
                    state = self.link[state]  # the root follows every known word
                    length = self.length[state]
                state = self.next[state][w]
                length += 1
                at += 1
                yield at, state, length

    def hits(self, found: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Merged spans of hit words, end exclusive, and the items whose windows occur."""
        spans: list[tuple[int, int]] = []
        names: set[str] = set()
        seen: set[int] = set()
        for end, state, length in self.matches(found):
            size = 0
            if length >= self.window:
                size, top = self.window, self.at_window[state]
                if top not in seen:
                    seen.add(top)
                    names |= self.windows[top]
            for n, name in self.ends.get(state, ()):
                if n <= length:
                    names.add(name)
                    size = max(size, n)
            if size:
                spans.append((end - size, end))
        return merged_spans(spans), names


def merged_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def automata(items: DataFrame, limit: int = AUTOMATON_WORDS) -> Iterator[SuffixAutomaton]:
    """Automata that hold at most about ``limit`` words each, and together all items."""
    rows = items.select(F.col("item_id").cast("string").alias("item"), "text").where(
        F.col("text").isNotNull()
    )
    total = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(total / 2 / limit))  # a word and its blank take two letters at least
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(blocks)))
    for block in range(blocks):
        pieces, size = [], 0
        for row in dealt.where(F.col("block") == block).toLocalIterator():
            run = words(row["text"])
            # A long item is cut so that each window lies in one piece.
            step = limit if len(run) > limit else max(1, len(run))
            for at in range(0, len(run), step):
                piece = run[at : at + step + (WINDOW - 1 if len(run) > limit else 0)]
                if at and len(piece) < WINDOW:
                    continue
                if size and size + len(piece) > 2 * limit:
                    yield SuffixAutomaton(pieces)
                    pieces, size = [], 0
                pieces.append((row["item"] or "", piece))
                size += len(piece)
        yield SuffixAutomaton(pieces)


def find_hits(docs: DataFrame, items: DataFrame, text: str = "text") -> DataFrame:
    """All columns of ``docs``, and ``hit``: n_words, spans of hit words, items that occur."""
    shape = "n_words long, spans array<struct<a:long,b:long>>, items array<string>"

    def one_pass(df: DataFrame, automaton: SuffixAutomaton, name: str) -> DataFrame:
        shared = df.sparkSession.sparkContext.broadcast(automaton)

        def rows(batch: list[str]) -> dict[str, list]:
            made = []
            for t in batch:
                found = words(t)
                spans, names = shared.value.hits(found)
                pairs = [{"a": a, "b": b} for a, b in spans]
                made.append({"n_words": len(found), "spans": pairs, "items": sorted(names)})
            return {name: made}

        return over_texts(df, rows, f"{name} struct<{shape}>", text, keep_text=True)

    taken = {c.lower() for c in docs.columns}
    parts: list[str] = []
    out = docs
    for k, automaton in enumerate(automata(items)):
        name = f"hit_{k}"
        while name in taken:
            name += "_"
        out = one_pass(out, automaton, name)
        parts.append(name)
    joined = F.struct(
        F.col(parts[0])["n_words"].alias("n_words"),
        F.flatten(F.array(*[F.col(p)["spans"] for p in parts])).alias("spans"),
        F.array_distinct(F.flatten(F.array(*[F.col(p)["items"] for p in parts]))).alias("items"),
    )
    return out.withColumn("hit_all", joined).drop(*parts)


def merged_column(spans: Column) -> Column:
    """Spans without overlap, in order."""
    empty = F.array().cast("array<struct<a:bigint,b:bigint>>")

    def add(done: Column, x: Column) -> Column:
        last = F.element_at(done, -1)
        longer = F.concat(
            F.slice(done, 1, F.size(done) - 1),
            F.array(F.struct(last["a"].alias("a"), F.greatest(last["b"], x["b"]).alias("b"))),
        )
        apart = F.concat(done, F.array(x))
        return F.when(F.size(done) == 0, F.array(x)).otherwise(
            F.when(x["a"] <= last["b"], longer).otherwise(apart)
        )

    return F.aggregate(F.array_sort(spans), empty, add)


def measured(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``find_hits`` with merged spans: hit_all of n_words, n_hit, spans, items, contaminated."""
    found = find_hits(docs, items)
    hit = F.col("hit_all")
    spans = F.when(F.size(hit["spans"]) < 2, hit["spans"]).otherwise(merged_column(hit["spans"]))
    found = found.withColumn(
        "hit_all",
        F.struct(
            hit["n_words"].alias("n_words"),
            spans.alias("spans"),
            hit["items"].alias("items"),
        ),
    )
    n_hit = F.aggregate(hit["spans"], F.lit(0).cast("long"), lambda n, x: n + x["b"] - x["a"])
    found = found.withColumn("hit_all", F.col("hit_all").withField("n_hit", n_hit))
    bad = (hit["n_hit"] > 0) & (20 * hit["n_hit"] >= hit["n_words"])
    return found.withColumn("hit_all", hit.withField("contaminated", bad))


def report(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    hit = F.col("hit_all")
    names = F.concat_ws(",", F.array_sort(hit["items"]))
    return measured(docs.select("doc_id", "text"), items).select(
        "doc_id",
        hit["n_words"].alias("n_words"),
        hit["n_hit"].alias("n_hit"),
        F.size(hit["items"]).cast("long").alias("n_items"),
        F.sha2(names, 256).alias("items_sha256"),
        hit["contaminated"].alias("contaminated"),
    )


def without_words(text: str, spans: list[tuple[int, int]]) -> str:
    """Text without the words in ``spans`` and what stands between them."""
    raw = text.encode()
    places = [m.span() for m in _WORD.finditer(raw)]
    kept, at = [], 0
    for a, b in spans:
        kept.append(raw[at : places[a][0]])
        at = places[b - 1][1]
    return b"".join([*kept, raw[at:]]).decode()


def cleaned(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Documents without the contaminated ones; from the others the hit spans are cut.

    Columns stay as they are, but for ``text``, and ``n_chars`` where there is one.
    """
    found = measured(packed(docs), items).where(~F.col("hit_all")["contaminated"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [
                without_words(t, [(s["a"], s["b"]) for s in spans]) if spans else t
                for t, spans in zip(
                    batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True
                )
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(made, pa.string())], ["row", "text"]
            )

    slim = found.select("row", "text", F.col("hit_all")["spans"].alias("spans"))
    return restored(slim.mapInArrow(cut, slim.select("row", "text").schema), docs)
