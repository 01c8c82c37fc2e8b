"""Audit of five filters in every order, as a stream of counts that take earlier ones back.

The files of a table are read as available-now micro-batches, each file once. A worker turns each
text into a mask of the conditions A to D that it fails (bits 1, 2, 4, 8) and a 128-bit digest.
State is kept for each digest: the least doc_id so far and the documents that have it, by part and
labels. Digests are dealt by their hash to BUCKETS groups, whose state is one value each, as a group
costs the stream far more than a text. A document with a larger id than the least counts with E (bit 16), one with the least
without. When a smaller id arrives, the documents counted without E are taken back (negative counts)
and counted with E. Each micro-batch's counts by part, mask and labels are summed and written under
its number, so that a batch that runs again replaces its own; their sum over all batches is the
state of the table, and is at most 128 rows for each part. The 120 orders are read off those sums.

Copies of one text in a reader's batch are combined before the shuffle: only those with the least id
of their part and labels travel with it, the others as a count, so a text that a third of all
documents share comes to its state in few rows. Labels are joined by doc_id in each micro-batch, so
batches should be large (``files`` a batch); a batch also writes the state of all buckets that it meets.

Null text counts as empty, as do all empty texts, which are equal. Null source is the part "". A
null doc_id is neither smaller nor larger than others: such a document never fails E and makes none
fail it. Repeated rows each count; those with the least id all count without E. A document with
several labels is good (toxic) if one of them says so. Very long texts are held one at a time.
Only doc_id, text and source are used, so other columns cannot clash. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import re
import uuid
from collections.abc import Iterable, Iterator
from functools import lru_cache
from typing import Any

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from remanente.llm.common import findable
from remanente.session import shared_folder

FILTERS = "ABCDE"
BIT = {letter: 1 << k for k, letter in enumerate(FILTERS)}
ORDERS = ["".join(p) for p in itertools.permutations(FILTERS)]
LEAST_WORDS = 50
LEAST_DISTINCT = 65
MOST_CAPITALS = 5
#: Letters of which a text may hold none.
SYMBOLS = re.compile(rb"[#$%&*|]")

_CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
_WITHIN = bytes(range(0x80, 0xC0))  # bytes that go on with a code point

#: Files of one micro-batch.
FILES = 64
#: Groups that digests are dealt to; 30 GB of texts put some thousand digests in each.
BUCKETS = 1 << 13


def failures(text: bytes) -> int:
    """Mask of the conditions A to D that a UTF-8 text fails."""
    words = text.split()  # bytes are split at ASCII blanks only
    points = len(text.translate(None, _WITHIN))
    capitals = len(text) - len(text.translate(None, _CAPITALS))
    mask = BIT["A"] * (len(words) < LEAST_WORDS)
    mask += BIT["B"] * (100 * len(set(words)) < LEAST_DISTINCT * len(words))
    mask += BIT["C"] * (100 * capitals > MOST_CAPITALS * points)
    return mask + BIT["D"] * (SYMBOLS.search(text) is not None)


def masked(docs: DataFrame) -> DataFrame:
    """doc_id, part, digest and mask of each document."""
    part = F.coalesce(F.col("source").cast("string"), F.lit(""))
    thin = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), part.alias("part"), F.col("text").cast("binary").alias("text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            digests, masks = [], []
            for text in batch.column("text"):
                data = text.as_py() or b""
                digests.append(hashlib.blake2b(data, digest_size=16).digest())
                masks.append(failures(data))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("part"), pa.array(digests, pa.binary()), pa.array(masks, pa.int32())],
                names=["doc_id", "part", "digest", "mask"],
            )

    return thin.mapInArrow(run, "doc_id long, part string, digest binary, mask int")


def labelled(masks: DataFrame, labels: DataFrame) -> DataFrame:
    """With ``good`` and ``toxic``, 0 or 1."""
    each = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"),
        F.max((F.col("toxic") == 1).cast("int")).alias("toxic"),
    )
    return masks.join(each, "doc_id", "left").select(
        *masks.columns, *[F.coalesce(c, F.lit(0)).alias(c) for c in ("good", "toxic")]
    )


#: Between the fields of a packed row; the last field, the part, may hold it.
MARK = "|"


def combined(marks: DataFrame) -> DataFrame:
    """bucket and ``row``: rows of one text, part and labels in a batch as one.

    A row is packed into one text (digest, least id, rows with it, rows in all, mask, good, toxic,
    part), as the stateful step pays for every column of every group.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        names = ["digest", "mask", "good", "toxic", "part"]
        for batch in batches:
            found: dict[tuple, list] = {}
            rows = zip(*[batch.column(c).to_pylist() for c in ["doc_id", *names]], strict=True)
            for doc, *key in rows:
                own = found.setdefault((*key, doc is None), [doc, 0, 0])
                if doc is not None and doc < own[0]:
                    own[:2] = [doc, 0]
                own[1] += doc == own[0]
                own[2] += 1
            buckets = [int.from_bytes(key[0][:4], "big") % BUCKETS for key in found]
            packed = [
                MARK.join(map(str, (key[0].hex(), "" if doc is None else doc, n_least, n, *key[1:-1])))
                for key, (doc, n_least, n) in found.items()
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array(buckets, pa.int32()), pa.array(packed, pa.string())], names=["bucket", "row"]
            )

    return marks.mapInArrow(run, "bucket int, row string")


Count = tuple[str, int, int]


def changes(
    least: int | None, held: dict[Count, int], rows: Iterable[tuple[Any, ...]]
) -> tuple[int | None, dict[Count, int], dict[tuple[str, int, int, bool], int]]:
    """New least id and its documents, and changes of counts by part, labels and whether E fails.

    ``rows``: (part, good, toxic, doc_id, n_least, n) of one text.
    """
    out: dict[tuple[str, int, int, bool], int] = {}

    def count(key: Count, copy: bool, n: int) -> None:
        out[(*key, copy)] = out.get((*key, copy), 0) + n

    held = dict(held)
    for part, good, toxic, doc, n_least, n in rows:
        key = (part, good, toxic)
        if doc is None:
            count(key, False, n)
            continue
        count(key, True, n - n_least)
        if least is not None and doc > least:
            count(key, True, n_least)
            continue
        if least is None or doc < least:
            for earlier, m in held.items():
                count(earlier, False, -m)
                count(earlier, True, m)
            least, held = doc, {}
        held[key] = held.get(key, 0) + n_least
        count(key, False, n_least)
    return least, held, {k: n for k, n in out.items() if n}


def updated(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Changes of the part counters for the texts of one bucket, whose state is updated."""
    known: dict[str, list] = json.loads(state.get[0]) if state.exists else {}
    rows: dict[str, list[tuple]] = {}
    masks: dict[str, int] = {}
    for frame in frames:
        for packed in frame["row"].tolist():
            digest, doc, n_least, n, mask, good, toxic, part = packed.split(MARK, 7)
            masks[digest] = int(mask)
            row = (part, int(good), int(toxic), int(doc) if doc else None, int(n_least), int(n))
            rows.setdefault(digest, []).append(row)
    total: dict[tuple, int] = {}
    for digest, own in rows.items():
        least, *shown = known.get(digest, [None])
        least, held, found = changes(least, {(p, g, t): n for p, g, t, n in shown}, own)
        if least is not None:
            known[digest] = [least, *[[*k, n] for k, n in held.items()]]
        for (p, g, t, e), n in found.items():
            place = (masks[digest] + BIT["E"] * e, g, t, p)
            total[place] = total.get(place, 0) + n
    if known:
        state.update((json.dumps(known),))
    found = [(m, g, t, n, p) for (m, g, t, p), n in sorted(total.items()) if n]
    if found:
        yield changed(tuple(MARK.join(map(str, row)) for row in found))


@lru_cache(1 << 14)
def changed(rows: tuple[str, ...]) -> pd.DataFrame:
    """A frame of packed changes. Small buckets often make the same ones, and frames are dear."""
    return pd.DataFrame({"change": rows})


def unpacked(changes_: DataFrame) -> DataFrame:
    """part, mask, good, toxic, n of packed changes."""
    fields = F.split("change", re.escape(MARK), 5)
    named = {"mask": "int", "good": "int", "toxic": "int", "n": "long", "part": "string"}
    return changes_.select(*[fields[k].cast(t).alias(c) for k, (c, t) in enumerate(named.items())])


def counted(docs: DataFrame, labels: DataFrame, checkpoint: str, sink: str) -> None:
    """Runs the stream ``docs`` to its end; each micro-batch's counts are written below ``sink``."""
    findable(docs.sparkSession)
    texts = combined(labelled(masked(docs), labels))
    deltas = texts.groupBy("bucket").applyInPandasWithState(
        updated, "change string", "held string", "append", GroupStateTimeout.NoTimeout
    )

    def store(batch: DataFrame, number: int) -> None:
        summed = unpacked(batch).groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n"))
        summed.write.mode("overwrite").parquet(f"{sink}/batch={number}")

    stream = deltas.writeStream.outputMode("append").foreachBatch(store)
    stream = stream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    stream.start().awaitTermination()


def file_stream(spark: SparkSession, path: str, files: int = FILES) -> DataFrame:
    """The Parquet file or folder at ``path`` as a stream of ``files`` files a micro-batch.

    The source takes a folder or a pattern, so a path is given as the pattern that it alone matches.
    """
    schema, path = spark.read.parquet(path).schema, path.rstrip("/")
    pattern = f"{path[:-1]}[{path[-1]}]"
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(pattern)


def masks_of(spark: SparkSession, path: str, labels: DataFrame, files: int = FILES) -> DataFrame:
    """part, mask, good, toxic, n: the documents at ``path`` by the conditions that they fail."""
    folder = f"{shared_folder(spark).rstrip('/')}/filter-audit-{uuid.uuid4().hex}"
    counted(file_stream(spark, path, files), labels, f"{folder}/progress", f"{folder}/counts")
    shape = "part string, mask int, good int, toxic int, n long"
    keys = ("part", "mask", "good", "toxic")
    counts = spark.read.schema(shape).option("recursiveFileLookup", "true").parquet(f"{folder}/counts")
    return counts.groupBy(*keys).agg(F.sum("n").alias("n")).where("n != 0")


def interactions(masks: DataFrame) -> DataFrame:
    """One row for each part, order of the filters and step, from counts of masks.

    The counts of a part are gathered in one row of three arrays with a place for each of 32 masks.
    """

    def places(n: Column) -> Column:
        return F.array(*[F.sum(F.when(F.col("mask") == m, n).otherwise(0)) for m in range(32)])

    per_part = masks.groupBy("part").agg(
        places(F.col("n")).alias("docs"),
        places(F.col("n") * F.col("good")).alias("goods"),
        places(F.col("n") * F.col("toxic")).alias("toxics"),
    )
    steps = [
        (order, k + 1, BIT[letter], sum(BIT[c] for c in order[:k]))
        for order in ORDERS
        for k, letter in enumerate(order)
    ]
    shape = "array<struct<filter_order string, step int, own int, earlier int>>"
    table = F.from_json(F.lit(json.dumps([dict(zip(("filter_order", "step", "own", "earlier"), s)) for s in steps])), shape)
    each = per_part.select("part", "docs", "goods", "toxics", F.explode(table).alias("s")).select(
        "part", "docs", "goods", "toxics", "s.*"
    )

    def total(values: str, condition: str) -> Column:
        """Sum over the masks ``m`` for which the condition holds."""
        picked = f"transform({values}, (n, m) -> if({condition}, n, 0L))"
        return F.expr(f"aggregate({picked}, 0L, (a, n) -> a + n)")

    removed = "m & own != 0 and m & earlier = 0"
    share = "transform(docs, (n, m) -> if(m & own != 0, n * (120 div bit_count(m)), 0L))"
    return each.select(
        "part",
        "filter_order",
        "step",
        total("docs", "m & (own | earlier) = 0").alias("kept"),
        total("docs", removed).alias("removed"),
        total("docs", "m & own != 0 and m & earlier != 0").alias("redundant"),
        total("docs", "m = own").alias("unique_fails"),
        total("goods", removed).alias("good_lost"),
        total("toxics", removed).alias("toxic_lost"),
        F.expr(f"aggregate({share}, 0L, (a, n) -> a + n)").alias("shapley"),
    )


def report(spark: SparkSession, path: str, labels: DataFrame, files: int = FILES) -> DataFrame:
    """The audit of the documents at ``path``, all columns of the contract."""
    return interactions(masks_of(spark, path, labels, files))


#: The same from whole tables, in DuckDB.
SQL = r"""
WITH texts AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents
),
split AS (
  SELECT *, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words,
    min(doc_id) OVER (PARTITION BY text) AS least
  FROM texts
),
masks AS (
  SELECT doc_id, part,
    CASE WHEN len(words) < 50 THEN 1 ELSE 0 END
    + CASE WHEN 100 * len(list_distinct(words)) < 65 * len(words) THEN 2 ELSE 0 END
    + CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text) THEN 4 ELSE 0 END
    + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END
    + CASE WHEN doc_id > least THEN 16 ELSE 0 END AS mask
  FROM split
),
marks AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good,
    max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id
),
counts AS (
  SELECT part, mask, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic
  FROM masks LEFT JOIN marks USING (doc_id) GROUP BY part, mask
),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c, unnest([1, 2, 4, 8, 16]) AS b),
orders AS (
  SELECT c1.c || c2.c || c3.c || c4.c || c5.c AS filter_order, [c1.b, c2.b, c3.b, c4.b, c5.b] AS bits
  FROM letters c1
  JOIN letters c2 ON c2.b <> c1.b
  JOIN letters c3 ON c3.b NOT IN (c1.b, c2.b)
  JOIN letters c4 ON c4.b NOT IN (c1.b, c2.b, c3.b)
  JOIN letters c5 ON c5.b NOT IN (c1.b, c2.b, c3.b, c4.b)
),
steps AS (
  SELECT filter_order, k AS step, bits[k] AS own, coalesce(list_sum(bits[:k - 1]), 0)::BIGINT AS earlier
  FROM orders, unnest([1, 2, 3, 4, 5]) AS t(k)
),
sizes AS (
  SELECT part, own, CAST(sum(n * (120 // bit_count(mask::INT))) AS BIGINT) AS shapley
  FROM counts JOIN (SELECT b AS own FROM letters) ON mask & own <> 0 GROUP BY part, own
)
SELECT c.part, s.filter_order, CAST(s.step AS INT) AS step,
  CAST(sum(CASE WHEN mask & (s.own | earlier) = 0 THEN n ELSE 0 END) AS BIGINT) AS kept,
  CAST(sum(CASE WHEN mask & s.own <> 0 AND mask & earlier = 0 THEN n ELSE 0 END) AS BIGINT) AS removed,
  CAST(sum(CASE WHEN mask & s.own <> 0 AND mask & earlier <> 0 THEN n ELSE 0 END) AS BIGINT) AS redundant,
  CAST(sum(CASE WHEN mask = s.own THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
  CAST(sum(CASE WHEN mask & s.own <> 0 AND mask & earlier = 0 THEN good ELSE 0 END) AS BIGINT) AS good_lost,
  CAST(sum(CASE WHEN mask & s.own <> 0 AND mask & earlier = 0 THEN toxic ELSE 0 END) AS BIGINT) AS toxic_lost,
  CAST(coalesce(any_value(z.shapley), 0) AS BIGINT) AS shapley
FROM counts c CROSS JOIN steps s LEFT JOIN sizes z ON z.part = c.part AND z.own = s.own
GROUP BY c.part, s.filter_order, s.step
"""
