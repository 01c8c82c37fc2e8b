"""One query for each operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from remanente.llm import (
    bpe,
    decontaminate,
    filter_audit,
    line_dedup,
    minhash,
    paragraph_sketch,
    pii,
    prefix_counts,
    secrets,
    toxicity,
    turn_repair,
    url_filter,
    wavelet,
)
from remanente.llm.common import Query, table

QUERIES: dict[str, Query] = {}
STATEMENTS: dict[str, str] = {}


def query(name: str) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        QUERIES[name] = build
        return build

    return register


@query("op8_bpe_encode_decode")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return bpe.encode_decode_digests(table(spark, folder, "documents"), path)


@query("op10_token_counts")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return prefix_counts.count_tokens(table(spark, folder, "documents"), path)


@query("op4_wavelet_shards")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return wavelet.read_documents(wavelet.write_shards(table(spark, folder, "documents"), path))


@query("op6_benchmark_decontamination")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    items = table(spark, folder, "benchmark")
    return decontaminate.report(table(spark, folder, "documents"), items)


@query("op7_minhash_near_duplicates")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.groups(table(spark, folder, "documents"))


@query("op5_toxicity")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.report(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op3_personal_data")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    return pii.find(table(spark, folder, "documents"))


@query("op9_url_filters")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.judge(table(spark, folder, "pages"))


@query("op2_document_fingerprints")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    return paragraph_sketch.fingerprints(table(spark, folder, "documents"))


@query("op1_line_dedup")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.report(table(spark, folder, "documents"))


@query("op11_conversation_repair")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return turn_repair.report(table(spark, folder, "conversations"))


@query("op12_filter_audit")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    labels = table(spark, folder, "labels")
    return filter_audit.report(spark, f"{folder}/documents.parquet", labels)


STATEMENTS["op12_filter_audit"] = filter_audit.SQL


@query("op13_secret_scan")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.scan(table(spark, folder, "documents"))


QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL:
    STATEMENTS["pipeline"] = corpus_pipeline.ORACLE_SQL
