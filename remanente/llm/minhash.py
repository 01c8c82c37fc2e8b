"""Near-duplicate documents: SuperMinHash signatures, bands, exact check, grouping.

Every shingle draws a random permutation of the signature's places and offers each place its rank
plus a random fraction; a place keeps the smallest offer. Ranks are drawn in rounds, and a document
is done when no place can still improve, for most documents after two or three rounds. Signatures
are cut into bands; documents that agree on a band are candidates, and links are confirmed on the
full shingle sets.

Equal sets form one class, and only classes are compared. Within a band's bucket all are compared
with the smallest one first; what that leaves in different groups is compared with more and more
members, at last with all, so that no link is lost and groups of linked texts cost few comparisons.
Such pairs first pass an odd sketch: ODD_BITS bits, each the parity of the shingles that fall on it.
Bits that differ are at most as many as shingles that only one text has, so a pair with more of them
than a link allows is dropped for certain, inside the join, and no link with it.

Null or blank text has an empty set: linked with nothing, kept. Rows without doc_id link nothing and
are kept, with component_id null. Rows that share a doc_id count as one linked document. Only doc_id
and text are used, so other columns cannot clash. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from remanente.llm.common import maybe_in, over_texts, texts, written
from remanente.llm.components import Part, bucket_groups, first_keys, first_met, star_links

SHINGLE = 5
#: A pair at similarity 0.75 shares no band with a chance of (1 - 0.75**5) ** 48, or 2 in a million.
BANDS, ROWS = 48, 5
#: Least similarity, as a percentage.
PERCENT = 75
#: Bits of an odd sketch.
ODD_BITS = 1024

_draw = np.random.default_rng(20240501)
_BYTE = _draw.integers(0, 2**64, 256, np.uint64)
_PLACE = _draw.integers(0, 2**63, SHINGLE, np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def multiple(k: int) -> np.uint64:
    return np.uint64(k * int(_BASE) % 2**64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(text: str) -> np.ndarray:
    """64-bit hashes of the words, cut at ASCII white space, with A-Z as a-z."""
    raw = np.frombuffer(text.encode().lower(), np.uint8)
    blank = (raw == 32) | ((raw >= 9) & (raw <= 13))
    edges = np.flatnonzero(np.diff(blank, prepend=True, append=True))
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.empty(0, np.uint64)
    lengths = ends - starts
    first = np.zeros(len(raw), np.int64)
    first[starts] = starts
    place = np.arange(len(raw)) - np.maximum.accumulate(first)
    powers = np.cumprod(np.full(int(lengths.max()) + 1, _BASE))
    place = np.minimum(place, len(powers) - 1)  # blanks count nothing
    values = np.where(blank, np.uint64(0), _BYTE[raw] * powers[place])
    sums = np.add.reduceat(values, starts)
    return mixed(sums + lengths.astype(np.uint64) * _BASE)


def shingles(text: str) -> np.ndarray:
    """Sorted distinct hashes of five-word shingles; fewer words make one shingle."""
    words = word_hashes(text)
    if not len(words):
        return words
    n = max(1, len(words) - SHINGLE + 1)
    size = min(SHINGLE, len(words))
    sums = np.full(n, multiple(size))
    for k in range(size):
        sums += words[k : k + n] * _PLACE[k]
    return np.unique(mixed(sums))


def signatures(sets: list[np.ndarray], m: int) -> np.ndarray:
    """SuperMinHash signatures, one row for each set that is not empty."""
    sizes = np.array([len(s) for s in sets], np.int64)
    out = np.full((len(sets), m), np.inf)
    flat, x = out.reshape(-1), np.concatenate(sets) if len(sets) else np.empty(0, np.uint64)
    doc = np.repeat(np.arange(len(sets)), sizes)
    drawn: list[np.ndarray] = []
    for rank in range(m):
        bits = mixed(x + multiple(2 * rank + 1))
        fraction = (bits >> np.uint64(11)).astype(np.float64) * 2.0**-53
        bits = mixed(x + multiple(2 * rank + 2)) >> np.uint64(32)
        choice = (bits * np.uint64(m - rank) >> np.uint64(32)).astype(np.int16) + np.int16(rank)
        # What stands at the chosen place of the permutation after the swaps made so far.
        place = choice.copy()
        for earlier in range(rank - 1, -1, -1):
            place[drawn[earlier] == place] = earlier
        drawn.append(choice)
        np.minimum.at(flat, doc * m + place, fraction + rank)
        open_ = out.max(axis=1) >= rank + 1
        stay = open_[doc]
        if not stay.any():
            break
        if not stay.all():
            x, doc = x[stay], doc[stay]
            drawn = [d[stay] for d in drawn]
    return out


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key for each band; different bands have different keys."""
    bits = signature.view(np.uint64).reshape(len(signature), bands, rows)
    keys = np.zeros((len(signature), bands), np.uint64)
    for r in range(rows):
        keys = mixed(keys * _BASE + bits[:, :, r])
    return mixed(keys + np.arange(1, bands + 1, dtype=np.uint64) * _BASE)


def odd_sketch(found: np.ndarray) -> np.ndarray:
    """Parities of the numbers of hashes that share their highest bits, in 64-bit words."""
    place = (found >> np.uint64(64 - ODD_BITS.bit_length() + 1)).astype(np.int64)
    odd = (np.bincount(place, minlength=ODD_BITS) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.int64)


def features(docs: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, n_shingles, set_id (digest of the set, null if empty), bands, odd (its sketch)."""

    def made(batch: list[str]) -> dict[str, list]:
        sets = [shingles(t) for t in batch]
        full = [s for s in sets if len(s)]
        keys = iter(band_keys(signatures(full, bands * rows), bands, rows).view(np.int64))
        return {
            "n_shingles": [len(s) for s in sets],
            "set_id": [
                hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None
                for s in sets
            ],
            "bands": [next(keys) if len(s) else None for s in sets],
            "odd": [odd_sketch(s) if len(s) else None for s in sets],
        }

    adds = "n_shingles long, set_id binary, bands array<long>, odd array<long>"
    return over_texts(texts(docs), made, adds, slice_rows=1024)


def similar(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those pairs (a, b) of nodes whose full sets are similar enough."""
    left = sets.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = sets.select(F.col("node").alias("b"), F.col("text").alias("text_b"))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        last, known = None, np.empty(0, np.uint64)
        for batch in batches:
            keep = []
            for i in range(batch.num_rows):
                b = batch.column("b")[i].as_py()
                if b != last:
                    last, known = b, shingles(batch.column("text_b")[i].as_py())
                own = shingles(batch.column("text_a")[i].as_py())
                both = len(np.intersect1d(own, known, assume_unique=True))
                keep.append(100 * both >= percent * (len(own) + len(known) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.join(left, "a").join(right, "b").mapInArrow(check, "a long, b long")


def odd_fit(one: Part, other: Part, percent: int) -> Column:
    """Whether two sketches differ in no more bits than linked sets have shingles of their own.

    With n shingles in both sets together, d of them in one only: similarity is (n - d) / (n + d).
    """
    apart = [
        F.bit_count(F.get(one("odd"), F.lit(k)).bitwiseXOR(F.get(other("odd"), F.lit(k))))
        for k in range(ODD_BITS // 64)
    ]
    n = one("n_shingles") + other("n_shingles")
    return (100 + percent) * sum(apart[1:], apart[0]) <= (100 - percent) * n


def links(docs: DataFrame, classes: DataFrame, percent: int = PERCENT) -> DataFrame:
    """node, label: groups of classes, for classes that are linked to another one."""
    rows = classes.select("node", "n_shingles", F.explode("bands").alias("key"))
    buckets = rows.groupBy("key").agg(F.min("node").alias("rep"), F.max("node").alias("most"))
    buckets = buckets.where("rep < most")
    members = written(rows.join(buckets, "key").select("key", "node", "n_shingles"), "buckets")
    wanted = members.select(F.col("node").alias("doc_id")).distinct()
    sets = written(
        maybe_in(texts(docs), "doc_id", wanted)
        .join(wanted, "doc_id")
        .select(F.col("doc_id").alias("node"), "text"),
        "candidates",
    )

    def sizes_fit(one: Part, other: Part) -> Column:
        n, m = one("n_shingles"), other("n_shingles")
        return 100 * F.least(n, m) >= percent * F.greatest(n, m)

    def sketches_fit(one: Part, other: Part) -> Column:
        return sizes_fit(one, other) & odd_fit(one, other, percent) & first_met(one, other)

    def confirmed(pairs: DataFrame) -> DataFrame:
        return similar(pairs, sets, percent)

    first = star_links(members, sizes_fit, confirmed)
    sketches = classes.select("node", "odd", first_keys(F.col("bands")).alias("firsts"))
    return bucket_groups(members, first, sketches_fit, confirmed, step=32, known=sketches)


def groups(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept."""
    made = written(features(docs), "signatures")
    named = made.where("doc_id IS NOT NULL AND n_shingles > 0")
    least = named.groupBy("set_id").agg(F.min("doc_id").alias("node"))
    classes = named.join(least, "set_id")
    alone = classes.where("doc_id = node").select("node", "n_shingles", "bands", "odd")
    labels = links(docs, alone, percent)
    found = made.drop("bands", "odd").join(least, "set_id", "left").join(labels, "node", "left")
    group = F.when(
        F.col("doc_id").isNotNull(), F.coalesce("label", "node", F.col("doc_id"))
    ).alias("component_id")
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept")
    return found.select("doc_id", "n_shingles", group).select("*", kept)


def deduplicated(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One document of each group, with all its columns: the one with the smallest doc_id.

    Of rows that share a doc_id one stays.
    """
    found = written(groups(docs, percent).where("doc_id IS NOT NULL"), "groups")
    gone = found.where("NOT kept").select("doc_id").distinct()
    stay = docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
    many = found.groupBy("doc_id").count().where("count > 1").select("doc_id")
    once = stay.join(many, "doc_id", "left_anti").select(*docs.columns)
    return once.union(
        stay.join(many, "doc_id", "left_semi").select(*docs.columns).dropDuplicates(["doc_id"])
    )
