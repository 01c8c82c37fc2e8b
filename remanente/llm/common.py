"""Reading the given tables, functions over texts, and written tables that cut lineage."""

from __future__ import annotations

import gc
import os
import uuid
from collections.abc import Callable, Iterable, Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from remanente.session import shared_folder

Query = Callable[[SparkSession, str], DataFrame]


def findable(spark: SparkSession) -> None:
    """Lets Python workers import this package where it is not installed but its folder is there."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def texts(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Only key and text, so that no other column can clash with what an operator adds."""
    return df.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))


#: Whether shuffle files go as soon as a write is done; else they stay until the driver happens to
#: collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, kind: str = "step") -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back, with its lineage cut."""
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/{kind}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


#: What this process keeps between tasks, and the module that it worked for last.
_remembered: list[Callable] = []
_worked_for = ""


def remembered(make: Callable) -> Callable:
    """``make`` with its results kept in a worker process until that works for another module."""
    kept = cache(make)
    _remembered.append(kept)
    return kept


def work_for(module: str) -> None:
    """Forgets what this process keeps for other modules.

    Spark gives the workers of one stage to the next, so that what each keeps would add up.
    """
    global _worked_for
    if module != _worked_for:
        _worked_for = module
        for kept in _remembered:
            if kept.__module__ != module:
                kept.cache_clear()
        gc.collect()
        pa.default_memory_pool().release_unused()


def over_texts(
    df: DataFrame,
    rows: Callable[[list[str]], dict[str, list]],
    adds: str,
    text: str = "text",
    keep_text: bool = False,
    slice_rows: int = 512,
) -> DataFrame:
    """All columns but the text, and those that ``rows`` makes from a list of texts (null: empty)."""
    findable(df.sparkSession)
    added = T._parse_datatype_string(adds)
    kept = [f for f in df.schema if keep_text or f.name != text]
    names = [f.name for f in kept]
    kinds = [(f.name, to_arrow_type(f.dataType)) for f in added]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        work_for(rows.__module__)
        for whole in batches:
            for at in range(0, whole.num_rows, slice_rows):
                part = whole.slice(at, slice_rows)
                made = rows([t or "" for t in part.column(text).to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in names] + [pa.array(made[c], t) for c, t in kinds],
                    names + [c for c, _ in kinds],
                )

    return df.mapInArrow(run, T.StructType(kept + list(added)))


def packed(docs: DataFrame) -> DataFrame:
    """``row`` with all columns but the text, and ``text``: nothing an operator adds can clash."""
    kept = [F.col(c) for c in docs.columns if c != "text"] or [F.lit(None).alias("none")]
    return docs.select(F.struct(*kept).alias("row"), F.col("text"))


def restored(made: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` from ``row`` and the new ``text``; n_chars follows the text."""
    out = []
    for c in docs.columns:
        if c == "text":
            out.append(F.col("text"))
        elif c == "n_chars":
            n = F.length("text").cast(docs.schema[c].dataType)
            out.append(F.coalesce(n, F.col("row")[c]).alias(c))
        else:
            out.append(F.col("row")[c].alias(c))
    return made.select(*out)


#: Bits of a key filter: a fixed size, whatever the number of keys.
FILTER_BITS = 1 << 22


def _filter_place(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(FILTER_BITS))


def maybe_in(df: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """Rows of ``df`` whose key may be among ``keys`` (a column of the same name).

    No row with such a key is lost; the others go but for chance hits. What is broadcast is a bitmap
    of FILTER_BITS bits in 64-bit words, so it cannot grow with the data.
    """
    at = _filter_place(key)
    bitmap = (
        keys.select(F.shiftright(at, 6).alias("filter_word"), (at % 64).cast("int").alias("bit"))
        .groupBy("filter_word")
        .agg(F.expr("bit_or(shiftleft(1L, bit))").alias("filter_bits"))
    )
    hit = F.getbit("filter_bits", (at % 64).cast("int")) == 1
    return (
        df.withColumn("filter_word", F.shiftright(at, 6))
        .join(F.broadcast(bitmap), "filter_word")
        .where(hit)
        .drop("filter_word", "filter_bits")
    )
