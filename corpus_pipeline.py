"""Documents through toxicity, line dedup, near-dedup, decontamination and encoding.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it kept. All but the last
return the columns of ``documents``. Null, blank and repeated texts, extra columns and empty tables
are treated as each operator's module says.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from remanente.llm import bpe, decontaminate, line_dedup, minhash, toxicity
from remanente.llm.common import table, written

#: SQL cannot express the fitted, iterated and tokenizing stages.
ORACLE_SQL = None


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not toxic."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that repeat an earlier one; gone are those that lose every line."""
    return line_dedup.deduplicated(docs)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return minhash.deduplicated(docs)


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated; shorter benchmark passages are cut from the others."""
    return decontaminate.cleaned(docs, table(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, ids as 32-bit bytes, n_tokens, and SHA-256 of the decoded text."""
    path = public_tokenizers.path("word_bpe_49k.json")
    return bpe.encode_decode(docs.select("doc_id", "lang", "source", "text"), path).select(
        "doc_id",
        "lang",
        "source",
        "ids",
        "n_tokens",
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )


STAGES = [
    ("toxicity", clean),
    ("line_dedup", without_repeated_lines),
    ("minhash_near_dedup", one_of_each_group),
    ("benchmark_decontamination", without_benchmarks),
    ("bpe_encode_decode", encoded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again as the next one's."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
