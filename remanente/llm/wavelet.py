"""Token ids in shards, each one compressed file that holds a wavelet matrix.

Level by level, from the highest bit of the ids, a plane keeps one bit of each token; then tokens
with a 0 move before those with a 1, in order. Counts of ones per block of 512 bits give rank and
select, and with them access to a token, counts and places of an id, without unpacking the shard.

Null text counts as empty and holds only the end id. Documents stand in ascending doc_id order,
null first; repeated doc_ids follow the hash of their texts. Only key and text are used, so other
columns cannot clash. An empty table gives no shards and no rows.
"""

from __future__ import annotations

import os
import re
import struct
import sys
import zlib
from array import array
from collections.abc import Callable, Iterable, Iterator
from functools import cache
from itertools import islice

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from remanente.llm.bpe import MEMORY, byte_letters
from remanente.llm.common import findable, texts, written

MAGIC = b"WVM1"
BLOCK = 512
HEAD = struct.Struct("<4sQQB")
#: Tokens after which a shard ends with the document at hand.
SHARD_TOKENS = 1 << 20

_ONES = np.array([bin(b).count("1") for b in range(256)], np.uint8)


class WaveletMatrix:
    def __init__(self, n: int, planes: list[np.ndarray], zeros: list[int], ranks: list[np.ndarray]):
        self.n, self.planes, self.zeros, self.ranks = n, planes, zeros, ranks
        self.levels = len(planes)

    @classmethod
    def build(cls, tokens: np.ndarray) -> WaveletMatrix:
        levels = max(1, int(tokens.max(initial=0)).bit_length())
        x = tokens.astype(np.uint16 if levels <= 16 else np.uint32)
        planes, zeros, ranks = [], [], []
        for level in range(levels - 1, -1, -1):
            ones = (x & x.dtype.type(1 << level)) != 0
            plane = np.packbits(ones, bitorder="little")
            planes.append(plane)
            ranks.append(block_ranks(plane))
            # Places are found without a branch for each bit, unlike by a mask.
            low = x.take(np.flatnonzero(~ones))
            zeros.append(len(low))
            x = np.concatenate([low, x.take(np.flatnonzero(ones))])
        return cls(len(tokens), planes, zeros, ranks)

    def bit(self, level: int, i: int) -> int:
        return int(self.planes[level][i >> 3]) >> (i & 7) & 1

    def ones(self, level: int, i: int) -> int:
        """Ones among the first ``i`` bits of a plane."""
        block, plane = i // BLOCK, self.planes[level]
        first, last = block * BLOCK // 8, i >> 3
        n = int(self.ranks[level][block]) + int(_ONES[plane[first:last]].sum())
        return n + (int(plane[last]) & ((1 << (i & 7)) - 1)).bit_count() if i & 7 else n

    def __getitem__(self, i: int) -> int:
        """The token at place ``i``."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        token = 0
        for level in range(self.levels):
            bit, ones = self.bit(level, i), self.ones(level, i)
            token = token << 1 | bit
            i = self.zeros[level] + ones if bit else i - ones
        return token

    def span(self, token: int, start: int, end: int) -> tuple[int, int]:
        """Where the token's occurrences in [start, end) stand below the last plane."""
        if token < 0 or token >> self.levels:
            return 0, 0
        for level in range(self.levels):
            a, b = self.ones(level, start), self.ones(level, end)
            if token >> (self.levels - 1 - level) & 1:
                start, end = self.zeros[level] + a, self.zeros[level] + b
            else:
                start, end = start - a, end - b
        return start, end

    def count(self, token: int, start: int = 0, end: int | None = None) -> int:
        a, b = self.span(token, start, self.n if end is None else end)
        return b - a

    def select_bit(self, level: int, bit: int, k: int) -> int:
        """Place of the k-th (from 0) bit of this kind in a plane, by halving on rank."""
        low, high = 0, self.n
        while low < high:
            mid = (low + high) // 2
            ones = self.ones(level, mid + 1)
            if (ones if bit else mid + 1 - ones) > k:
                high = mid
            else:
                low = mid + 1
        return low

    def select(self, token: int, k: int) -> int:
        """Place of the token's k-th occurrence, from 0."""
        start, end = self.span(token, 0, self.n)
        if not 0 <= k < end - start:
            raise IndexError(k)
        at = start + k
        for level in range(self.levels - 1, -1, -1):
            bit = token >> (self.levels - 1 - level) & 1
            at = self.select_bit(level, bit, at - self.zeros[level] if bit else at)
        return at

    def occurrences(self, token: int) -> list[int]:
        return [self.select(token, k) for k in range(self.count(token))]

    def tokens(self) -> np.ndarray:
        """All tokens: each level's move of zeros before ones is undone, from the last level up."""
        kind = np.uint16 if self.levels <= 16 else np.uint32
        x = np.zeros(self.n, kind)
        for level in range(self.levels - 1, -1, -1):
            ones = np.unpackbits(self.planes[level], count=self.n, bitorder="little").view(bool)
            back = np.empty(self.n, kind)
            back[np.flatnonzero(~ones)] = x[: self.zeros[level]]
            back[np.flatnonzero(ones)] = x[self.zeros[level] :] | kind(1 << (self.levels - 1 - level))
            x = back
        return x.astype(np.uint32)


def block_ranks(plane: np.ndarray) -> np.ndarray:
    """Ones before each block of a plane, and one entry beyond the last."""
    size = BLOCK // 8
    padded = np.zeros(-(-len(plane) // size) * size, np.uint8)
    padded[: len(plane)] = plane
    ones = np.bitwise_count(padded.view(np.uint64)).reshape(-1, size // 8)
    return np.concatenate([[0], ones.sum(1, dtype=np.uint32).cumsum()]).astype(np.uint32)


def to_file(doc_ids: list[int | None], counts: list[int], tokens: np.ndarray) -> bytes:
    """One shard: header, documents and planes with their rank directories, each compressed."""
    matrix, pack = WaveletMatrix.build(tokens), zstandard.ZstdCompressor(level=1).compress
    known = np.array([d is not None for d in doc_ids], np.uint8)
    parts = [
        known.tobytes(),
        np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
        np.array(counts, "<u8").tobytes(),
        np.array(matrix.zeros, "<u8").tobytes(),
    ]
    for plane, ranks in zip(matrix.planes, matrix.ranks, strict=True):
        parts += [plane.tobytes(), ranks.astype("<u4").tobytes()]
    out = [HEAD.pack(MAGIC, len(tokens), len(doc_ids), matrix.levels)]
    for part in map(pack, parts):
        out += [struct.pack("<Q", len(part)), part]
    return b"".join(out)


def from_file(data: bytes) -> tuple[list[int | None], np.ndarray, WaveletMatrix]:
    """Document ids, their token counts, and the matrix of a shard."""
    magic, n, n_docs, levels = HEAD.unpack_from(data)
    if magic != MAGIC:
        raise ValueError("not a wavelet shard")
    unpack, at, parts = zstandard.ZstdDecompressor().decompress, HEAD.size, []
    while at < len(data):
        (size,) = struct.unpack_from("<Q", data, at)
        parts.append(unpack(data[at + 8 : at + 8 + size]) if size else b"")
        at += 8 + size
    known, ids = np.frombuffer(parts[0], np.uint8), np.frombuffer(parts[1], "<i8")
    docs = [int(d) if k else None for k, d in zip(known, ids, strict=True)]
    planes = [np.frombuffer(parts[4 + 2 * i], np.uint8) for i in range(levels)]
    ranks = [np.frombuffer(parts[5 + 2 * i], "<u4") for i in range(levels)]
    zeros = np.frombuffer(parts[3], "<u8").tolist()
    if len(docs) != n_docs:
        raise ValueError("damaged wavelet shard")
    return docs, np.frombuffer(parts[2], "<u8"), WaveletMatrix(n, planes, zeros, ranks)


class Known(dict):
    """Ids of chunks, made when they are first asked for; in use are the latest ones.

    A full memory becomes the former one, from which chunks that come again are taken over.
    """

    def __init__(self, make: Callable[[str], bytes]):
        super().__init__()
        self.make, self.former = make, {}

    def __missing__(self, chunk: str) -> bytes:
        ids = self.former.get(chunk)
        ids = self[chunk] = self.make(chunk) if ids is None else ids
        return ids

    def turn(self) -> None:
        self.former = dict(self)
        self.clear()


class ChunkEncoder:
    """The library's ids of whole texts, joined from chunks that a worker remembers.

    A single blank between two letters that are not white space always starts a new word of a
    byte-level tokenizer, so texts are cut before such blanks. A chunk that is a blank, plain letters
    and a run of marks holds one word, which goes straight to the library's model, and the run, which
    is one more; any other chunk takes the library's whole way. Two such words with a line end between
    them are two words, and a line end, which is a token of its own before a letter.
    """

    blanks = [c for c in map(chr, range(sys.maxunicode + 1)) if c.isspace() and c != " "]
    cut = re.compile(r"(?<=\S) (?=\S)")
    plain = re.compile(
        "([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?#$%&*|]{0,8})(?:\n([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?#$%&*|]{0,8}))?"
    )

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        letters = byte_letters()
        self.letters = {c: "".join([letters[b] for b in c.encode()]) for c in map(chr, range(256))}
        self.blank = self.letters[" "]
        self.marks = Known(lambda run: self.whole([run])[0])
        self.marks[""] = b""
        self.line_end = self.whole(["\n"])[0]
        self.first: dict[str, bytes] = {}
        self.later = {}
        self.below = Known(lambda letters: self.word(letters, ""))

    @property
    def later(self) -> Known:
        return self._later

    @later.setter
    def later(self, known: dict[str, bytes]) -> None:
        """Takes what is known at first; chunks that are not get their ids when asked for."""
        self._later = Known(self.after_blank)
        self._later.update(known)

    def pieces(self, text: str) -> list[str]:
        odd = text[:1] == " " or text[-1:] == " " or "  " in text
        odd = odd or any([b in text and (f" {b}" in text or f"{b} " in text) for b in self.blanks])
        return self.cut.split(text) if odd else text.split(" ")

    def whole(self, asked: list[str]) -> list[bytes]:
        made = self.library.encode_batch_fast(asked, add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in made]

    def word(self, letters: str, before: str) -> bytes:
        """Ids of a word of plain letters, with ``before`` (a blank's letter or nothing) at its start."""
        shown = letters if letters.isascii() else "".join(map(self.letters.get, letters))
        return array("I", [t.id for t in self.library.model.tokenize(before + shown)]).tobytes()

    def after_blank(self, chunk: str) -> bytes:
        if chunk.isascii() and chunk.isalpha():
            return self.word(chunk, self.blank)
        if not (m := self.plain.fullmatch(chunk)):
            return self.whole([" " + chunk])[0]
        letters, mark, below, last = m.groups()
        if letters == chunk:
            return self.word(letters, self.blank)
        ids = self.later[letters] + self.marks[mark]
        return ids + self.line_end + self.below[below] + self.marks[last] if below else ids

    def encode(self, batch: list[str]) -> list[np.ndarray]:
        if len(self.first) > MEMORY:
            self.first.clear()
        for known in (self.later, self.below, self.marks):
            if len(known) > MEMORY:
                known.turn()
        found, first, later = [self.pieces(t) for t in batch], self.first, self.later.__getitem__
        asked = list({p[0] for p in found if p[0] not in first})
        first.update(zip(asked, self.whole(asked), strict=True))
        made = []
        for p in found:
            rest = map(later, islice(p, 1, None))
            made.append(np.frombuffer(first[p[0]] + b"".join(rest), "<u4"))
        return made


@cache
def encoder(path: str) -> ChunkEncoder:
    """One for each worker process."""
    return ChunkEncoder(path)


def write_shards(
    df: DataFrame, path: str, shard_tokens: int = SHARD_TOKENS, end_id: int = 0
) -> DataFrame:
    """Written shards of the texts' ids, each with the end id, read back: part, shard, n_tokens, file.

    Texts are dealt to tasks by ranges of doc_id, so that ``part`` and then ``shard`` follow
    ascending doc_id; a task holds the ids of one shard at a time.
    """

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        part, shard = TaskContext.get().partitionId(), 0
        docs, counts, ids, n = [], [], [], 0

        def done() -> pa.RecordBatch:
            tokens = np.concatenate(ids)
            row = {"part": part, "shard": shard, "n_tokens": n}
            row["file"] = to_file(docs, counts, tokens)
            return pa.RecordBatch.from_pylist([row], schema=SHARD_SCHEMA)

        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                made = encoder(path).encode([x or "" for x in batch.column("text").to_pylist()])
                for doc, tokens in zip(batch.column("doc_id").to_pylist(), made, strict=True):
                    docs.append(doc)
                    counts.append(len(tokens) + 1)
                    ids += [tokens, end]
                    n += len(tokens) + 1
                    if n >= shard_tokens:
                        yield done()
                        docs, counts, ids, n, shard = [], [], [], 0, shard + 1
        if docs:
            yield done()

    findable(df.sparkSession)
    end = np.array([end_id], "<u4")
    order = [F.col("doc_id"), F.xxhash64("text")]
    dealt = texts(df).repartitionByRange(*order).sortWithinPartitions(*order)
    made = dealt.mapInArrow(
        shards, "part long, shard long, n_tokens long, file binary"
    )
    return written(made, "wavelet")


SHARD_SCHEMA = pa.schema(
    [("part", pa.int64()), ("shard", pa.int64()), ("n_tokens", pa.int64()), ("file", pa.binary())]
)


def starts(files: DataFrame) -> DataFrame:
    """part, shard, first: ids before each shard. One task sees one row per part, not per shard."""
    sizes = files.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = F.coalesce(
        F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0),
    )
    parts = sizes.select("part", before.alias("part_first"))
    inside = Window.partitionBy("part").orderBy("shard")
    own = F.sum("n_tokens").over(inside.rowsBetween(Window.unboundedPreceding, -1))
    return (
        files.select("part", "shard", "n_tokens")
        .join(parts, "part")
        .select(
            "part", "shard", (F.col("part_first") + F.coalesce(own, F.lit(0))).alias("first")
        )
    )


DOC_SCHEMA = pa.schema(
    [
        ("part", pa.int64()),
        ("shard", pa.int64()),
        ("doc_id", pa.int64()),
        ("offset", pa.int64()),
        ("n_tokens", pa.int64()),
        ("ids_crc32", pa.int64()),
    ]
)


def read_documents(files: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of each document, from the shards' files."""

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                docs, counts, matrix = from_file(batch.column("file")[i].as_py())
                raw = memoryview(matrix.tokens().astype("<u4").tobytes())
                ends = np.cumsum(counts).astype(np.int64)
                begins = ends - counts.astype(np.int64)
                crcs = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(begins, ends, strict=True)]
                place = [[batch.column(c)[i].as_py()] * len(docs) for c in ("part", "shard")]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(values, kind)
                        for values, kind in zip(
                            [*place, docs, begins, counts.astype(np.int64), crcs],
                            DOC_SCHEMA.types,
                            strict=True,
                        )
                    ],
                    schema=DOC_SCHEMA,
                )

    rows = files.mapInArrow(
        documents,
        "part long, shard long, doc_id long, offset long, n_tokens long, ids_crc32 long",
    )
    return rows.join(starts(files), ["part", "shard"]).select(
        "doc_id", (F.col("first") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32"
    )
