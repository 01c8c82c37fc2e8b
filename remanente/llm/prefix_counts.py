"""Exact token counts of every prefix, by dynamic programming.

Within a word, ``open`` holds for each prefix its last token and count, with the word still going
on, and ``closed`` the count if the word ended there. The last token of a prefix is the one that
ends there and that the tokenizer keeps apart from the last token of the prefix before it; only one
token does. Counts over words add up, so the counts of all prefixes of a text answer how many tokens
any cut leaves, and where to cut for a budget, without encoding again.

Null text counts as empty: 0 bytes, 0 tokens, not over the limit. Repeated rows each give their row.
Only key and text are used, so other columns cannot clash. An empty table gives no rows.
"""

from __future__ import annotations

from functools import cache

import numpy as np
from pyspark.sql import DataFrame

from remanente.llm.bpe import BITS, MEMORY, WordBpe, chunks, tokenizer
from remanente.llm.common import over_texts, texts


class PrefixCounts:
    def __init__(self, bpe: WordBpe):
        self.bpe = bpe
        suffix = bpe.suffix
        shown = {s: i for s, i in bpe.vocab.items()}
        self.open = {s: i for s, i in shown.items() if not s.endswith(suffix)}
        self.closing = {s[: -len(suffix)]: i for s, i in shown.items() if s.endswith(suffix)}
        self.longest = max(map(len, [*self.open, *self.closing]))
        self.pairs: dict[int, bool] = {}
        self.own: dict[int, list[int]] = {}
        self.counts: dict[str, int] = {}
        self.chunk_totals: dict[str, int] = {}

    def start(self, token: int) -> list[int]:
        """Single symbols of a token."""
        if token not in self.own:
            text, suffix = self.bpe.strings[token], self.bpe.suffix
            ended = text.endswith(suffix)
            letters = list(text[: -len(suffix)] if ended else text)
            if ended:
                letters[-1] += suffix
            self.own[token] = [self.bpe.vocab[c] for c in letters]
        return self.own[token]

    def apart(self, left: int, right: int) -> bool:
        """Whether the tokenizer keeps these two tokens when they meet; left < 0 is a word's start."""
        key = left << BITS | right
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) > 8 * MEMORY:
                self.pairs.clear()
            both = [right] if left < 0 else [left, right]
            symbols = [s for t in both for s in self.start(t)]
            known = self.pairs[key] = self.bpe.merged(symbols) == both
        return known

    def opened(self, letters: str, end: int) -> tuple[list[int], list[int]]:
        """Last token and count of each prefix shorter than ``end``, with the word going on."""
        last, count = [-1], [0]
        token_of, apart, longest = self.open.get, self.apart, self.longest
        for i in range(1, end):
            for j in range(i - longest if i > longest else 0, i):
                t = token_of(letters[j:i])
                if t is not None and apart(last[j], t):
                    last.append(t)
                    count.append(count[j] + 1)
                    break
        return last, count

    def closed(self, letters: str, i: int, last: list[int], count: list[int]) -> int:
        """Tokens of the prefix of length ``i`` if the word ends there."""
        token_of, apart = self.closing.get, self.apart
        for j in range(max(0, i - self.longest), i):
            t = token_of(letters[j:i])
            if t is not None and apart(last[j], t):
                return count[j] + 1
        return 0

    def tokens(self, word: str) -> int:
        """Tokens of a whole word."""
        known = self.counts.get(word)
        if known is None:
            if len(self.counts) > MEMORY:
                self.counts.clear()
            letters = "".join([self.bpe.letters[b] for b in word.encode()])
            n = len(letters)
            known = 1 if letters in self.closing and self.apart(-1, self.closing[letters]) else 0
            known = known or self.closed(letters, n, *self.opened(letters, n))
            self.counts[word] = known
        return known

    def word(self, word: str) -> list[int]:
        """Tokens of each prefix of a word, by its bytes, from the empty one on."""
        letters = "".join([self.bpe.letters[b] for b in word.encode()])
        last, count = self.opened(letters, len(letters))
        return [0, *(self.closed(letters, i, last, count) for i in range(1, len(letters) + 1))]

    def total(self, chunk: str) -> int:
        known = self.chunk_totals.get(chunk)
        if known is None:
            if len(self.chunk_totals) > MEMORY:
                self.chunk_totals.clear()
            parts = self.bpe.parts(chunk)
            known = sum([1 if isinstance(p, int) else self.tokens(p) for p in parts])
            self.chunk_totals[chunk] = known
        return known

    def prefixes(self, chunk: str) -> list[int]:
        """Tokens of chunk[:i] for every i from 0 to its length.

        Where a cut leaves the words before it as they are, only the last word's counts are looked
        up; special strings and letters that change under normalisation take the plain sum.
        """
        plain = chunk.isascii() and not self.bpe.special_at.search(chunk)
        out, done, at = [0], 0, 0
        if not plain:
            return [self.total(chunk[:i]) for i in range(len(chunk) + 1)]
        lower = chunk.lower()
        for m in self.bpe.ascii_words_at.finditer(lower):
            out += [done] * (m.start() - at)  # letters outside words
            counts = self.word(m.group())
            if m.group()[0] == "'" and m.group()[1:].isalpha():  # a cut leaves two words
                tail = [1 + self.tokens(m.group()[1:i]) for i in range(2, len(m.group()))]
                out += [done + c for c in [counts[1], *tail, counts[-1]]]
            else:
                out += [done + c for c in counts[1:]]
            done += counts[-1]
            at = m.end()
        return out + [done] * (len(chunk) - at)

    def text(self, text: str) -> np.ndarray:
        """Tokens of text[:i] for every i."""
        out, done = [0], 0
        for k, chunk in enumerate(chunks(text)):
            own = self.prefixes(chunk)
            out += [done] * (k > 0) + [done + c for c in own[1:]]
            done += own[-1]
        return np.array(out, np.int64)

    def cut(self, text: str, found: list[str], totals: list[int], limit: int) -> int:
        """Length of the longest prefix of at most ``limit`` tokens."""
        done = at = 0
        for k, (chunk, n) in enumerate(zip(found, totals, strict=True)):
            if done + n > limit:
                fits = [i for i, c in enumerate(self.prefixes(chunk)) if done + c <= limit]
                return at + fits[-1]
            done, at = done + n, at + len(chunk) + (k < len(found) - 1)
        return at


@cache
def counter(path: str) -> PrefixCounts:
    """One for each worker process."""
    return PrefixCounts(tokenizer(path))


def count_tokens(df: DataFrame, path: str, limit: int = 2048) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit, and ``cut_chars``: the longest prefix in the limit."""

    def rows(batch: list[str]) -> dict[str, list]:
        c, n, cuts = counter(path), [], []
        for text in batch:
            found, known = chunks(text), c.chunk_totals
            try:
                totals = [known[chunk] for chunk in found]
            except KeyError:
                totals = [c.total(chunk) for chunk in found]
            n.append(sum(totals))
            cuts.append(len(text) if n[-1] <= limit else c.cut(text, found, totals, limit))
        return {
            "n_bytes": [len(t.encode()) for t in batch],
            "n_tokens": n,
            "over_limit": [k > limit for k in n],
            "cut_chars": cuts,
        }

    adds = "n_bytes long, n_tokens long, over_limit boolean, cut_chars long"
    return over_texts(texts(df), rows, adds)


def count_prefixes(df: DataFrame, path: str) -> DataFrame:
    """doc_id and ``counts``: tokens of every prefix by its length in letters."""

    def rows(batch: list[str]) -> dict[str, list]:
        return {"counts": [counter(path).text(t) for t in batch]}

    return over_texts(texts(df), rows, "counts array<long>")
