"""Byte-pair encoding and decoding with merges taken from a priority queue.

A word is a doubly linked list of symbols. The queue holds the merge rank of each adjacent pair;
an entry whose symbols have changed since is stale and skipped. Decoding joins vocabulary strings.

Null text counts as empty: no ids, empty decoded text. Repeated rows each give their row. Only the
key and text columns are used, so other columns cannot clash. An empty table gives no rows.
"""

from __future__ import annotations

import heapq
import json
import re
import sys
from array import array
from collections.abc import Iterator
from functools import cache

import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Regex, Tokenizer, pre_tokenizers

from remanente.llm.common import over_texts, remembered, texts

#: Entries a worker keeps before it starts its memory of words again.
MEMORY = 400_000
#: Code points that are asked for at once.
BLOCK = 0x1000
#: Bits of a symbol in a packed number; a place in a word has twice as many.
BITS = 20
LOW, PLACES = (1 << BITS) - 1, (1 << 2 * BITS) - 1
#: Letters of Latin-1, and marks after them.
_LETTERS, _MARKS = "A-Za-zÀ-ÖØ-öø-ÿ", "!-&(-/:;=-@[-`{-~"
PLAIN = re.compile(f"([{_LETTERS}]+)([{_MARKS}]*)").fullmatch
SOME_PLAIN = re.compile(f"[{_LETTERS}]*[{_MARKS}]*").fullmatch


def byte_letters() -> list[str]:
    """Letter that stands for each byte: printable Latin-1 itself, the rest from 256 upwards."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in plain else next(spare)) for b in range(256)]


@cache
def letter_classes() -> dict[str, str]:
    """Ranges of white space, letters and digits in the Unicode version of the tokenizer library."""
    out = {}
    for name in (r"\s", r"\p{L}", r"\p{N}"):
        split = pre_tokenizers.Split(Regex(name + "+"), "removed", invert=True)
        spans: list[tuple[int, int]] = []
        # Block by block: at once, the library's answer would be the most that a worker ever holds.
        for low in range(0, 0x110000, BLOCK):
            every = "".join(chr(p) for p in range(low, low + BLOCK) if not 0xD800 <= p < 0xE000)
            for found, _ in split.pre_tokenize_str(every):
                a, b = ord(found[0]), ord(found[-1])
                if spans and spans[-1][1] + 1 == a:
                    a = spans.pop()[0]
                spans.append((a, b))
        out[name] = "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in spans)
    return out


class WordBpe:
    """A tokenizer file with word ends, lower case and dropped white space."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix: str = model["end_of_word_suffix"] or ""
        self.strings = {i: s for s, i in self.vocab.items()}
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.merges = {
            self.vocab[a] << BITS | self.vocab[b]: rank << 3 * BITS | self.vocab[a + b]
            for rank, (a, b) in enumerate(merges)
        }
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings |= {i: s for s, i in self.special.items()}
        # A special string that PLAIN could take as letters and marks rules the short way out.
        self.plain = re.compile("(?!)").fullmatch if any(SOME_PLAIN(c) for c in self.special) else PLAIN
        self.special_at = regex.compile("|".join(map(regex.escape, self.special)) or "(?!)")
        self.normalizer = Tokenizer.from_file(path).normalizer
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.ascii_words_at = regex.compile(pattern)
        for name, ranges in letter_classes().items():
            pattern = pattern.replace(name, ranges)
        self.words_at = regex.compile(pattern)
        self.letters = byte_letters()
        self.words: dict[str, list[int]] = {}
        self.shown: dict[str, tuple[bytes, str]] = {}

    def split(self, text: str) -> list[str]:
        """Normalised words of text without special strings."""
        if text.isascii():
            return self.ascii_words_at.findall(text.lower())
        return self.words_at.findall(self.normalizer.normalize_str(text))

    def parts(self, chunk: str) -> Iterator[str | int]:
        """Normalised words and special ids, in order."""
        at = 0
        for m in self.special_at.finditer(chunk):
            yield from self.split(chunk[at : m.start()])
            yield self.special[m.group()]
            at = m.end()
        yield from self.split(chunk[at:])

    def symbols(self, word: str) -> list[int]:
        """Ids of the single bytes, the last one with the word's end."""
        found = [self.letters[b] for b in word.encode()]
        found[-1] += self.suffix
        return [self.vocab[s] for s in found if s in self.vocab]

    def merged(self, ids: list[int]) -> list[int]:
        """Symbols after all merges, lowest rank first, then leftmost.

        An entry of the queue is one number: rank, place of the left symbol, merged symbol.
        """
        n, merge_of, push = len(ids), self.merges.get, heapq.heappush
        ids, queue = list(ids), []
        offered = [-1] * n  # the entry last queued for the pair that starts here
        for i in range(n - 1):
            if (found := merge_of(ids[i] << BITS | ids[i + 1])) is not None:
                offered[i] = entry = found | i << BITS
                queue.append(entry)
        if not queue:
            return ids
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heapq.heapify(queue)
        while queue:
            entry = heapq.heappop(queue)
            left = (entry >> BITS) & PLACES
            if offered[left] != entry:
                continue  # stale
            new, right = entry & LOW, after[left]
            ids[left], ids[right], offered[right] = new, -1, -1
            right = after[left] = after[right]
            if right < n:
                before[right] = left
                found = merge_of(new << BITS | ids[right])
                if found is not None:
                    offered[left] = entry = found | left << BITS
                    push(queue, entry)
                else:
                    offered[left] = -1
            left = before[left]
            if left >= 0:
                found = merge_of(ids[left] << BITS | new)
                if found is not None:
                    offered[left] = entry = found | left << BITS
                    push(queue, entry)
                else:
                    offered[left] = -1
        return [i for i in ids if i >= 0]

    def encode_word(self, word: str) -> list[int]:
        found = self.words.get(word)
        if found is None:
            if len(self.words) > MEMORY:
                self.words.clear()
            found = self.words[word] = self.merged(self.symbols(word))
        return found

    def shown_word(self, word: str) -> tuple[bytes, str]:
        """Ids of a normalised word as bytes, and their decoded text."""
        found = self.shown.get(word)
        if found is None:
            if len(self.shown) > MEMORY:
                self.shown.clear()
            ids = self.merged(self.symbols(word))
            found = self.shown[word] = (array("I", ids).tobytes(), self.decode(ids))
        return found

    def shown_chunk(self, chunk: str) -> tuple[bytes, str]:
        """Ids of a chunk as bytes, and their decoded text.

        Letters that normalising only lowers, and a run of marks after them, are words of their own.
        Any other chunk is split.
        """
        if m := self.plain(chunk):
            word, marks = m.groups()
            ids, back = self.shown_word(word.lower())
            if marks:
                more, after = self.shown_word(marks)
                return ids + more, f"{back} {after}"
            return ids, back
        own = self.encode_chunk(chunk)
        return array("I", own).tobytes(), self.decode(own)

    def encode_chunk(self, chunk: str) -> list[int]:
        out: list[int] = []
        for part in self.parts(chunk):
            if isinstance(part, int):
                out.append(part)
            else:
                out += self.encode_word(part)
        return out

    def encode(self, text: str) -> list[int]:
        return [i for chunk in chunks(text) for i in self.encode_chunk(chunk)]

    def decode(self, ids) -> str:
        """Vocabulary strings with a blank between, as a file without a decoder asks for."""
        return " ".join(self.strings[int(i)] for i in ids)


def chunks(text: str) -> list[str]:
    """Text cut at blanks and line ends, which no word or special string crosses."""
    return text.replace("\n", " ").split(" ")


@remembered
def tokenizer(path: str) -> WordBpe:
    """One for each worker process at work here."""
    return WordBpe(path)


@remembered
def memory(path: str) -> dict[str, tuple[bytes, str]]:
    """Chunks that this worker has met, with their ids and decoded text."""
    return {}


def encoded(texts_: list[str], path: str) -> Iterator[tuple[bytes, str]]:
    """Ids as 32-bit little-endian bytes, and the text decoded from them, of each text."""
    assert sys.byteorder == "little" and array("I").itemsize == 4
    bpe, known = tokenizer(path), memory(path)
    for t in texts_:
        found = chunks(t)
        if len(known) > MEMORY:
            known.clear()
        try:
            pairs = [known[c] for c in found]
        except KeyError:
            for chunk in found:
                if chunk not in known:
                    known[chunk] = bpe.shown_chunk(chunk)
            pairs = [known[c] for c in found]
        ids, back = zip(*pairs, strict=True)
        yield b"".join(ids), " ".join([s for s in back if s])


def encode_decode(df: DataFrame, path: str, text: str = "text") -> DataFrame:
    """Other columns, and ids (bytes), n_tokens and the text ``decoded`` from them."""

    def rows(batch: list[str]) -> dict[str, list]:
        made = list(encoded(batch, path))
        return {
            "ids": [ids for ids, _ in made],
            "n_tokens": [len(ids) // 4 for ids, _ in made],
            "decoded": [back for _, back in made],
        }

    return over_texts(df, rows, "ids binary, n_tokens long, decoded string", text)


def encode_decode_digests(df: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, and SHA-256 of the ids and of the decoded text."""
    return encode_decode(texts(df), path).select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )
