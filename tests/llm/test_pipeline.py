"""The pipeline's stages after each other, and the entry with and without this subpackage."""

from __future__ import annotations

import os
import subprocess
import sys

import cases
import corpus_pipeline
import public_tokenizers
import pytest

import __spark_entry__ as entry
from remanente.llm import bpe, decontaminate, minhash
from remanente.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


def test_every_operator_has_a_query():
    names = set(QUERIES)
    assert names <= set(entry.queries())
    for n in range(1, 11):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert "pipeline" in names


def test_entry_works_without_the_subpackage():
    code = (
        "import sys; sys.modules['remanente.llm'] = None; sys.modules['corpus_pipeline'] = None;"
        "import __spark_entry__ as e; q = e.queries();"
        "assert 'corte_minimo' in q and not any(n.startswith('op') for n in q);"
        "assert set(e.oracle_sql()) <= set(q)"
    )
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)


@needs_data
def test_stages_keep_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = docs
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, before, SF)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert after.columns == docs.columns and after.dtypes == docs.dtypes
        after = after.cache()
        kept, given = ({r.doc_id for r in df.select("doc_id").collect()} for df in (after, before))
        assert kept <= given
        if name == "minhash_near_dedup":
            groups = minhash.groups(before).collect()
            assert kept == {r.doc_id for r in groups if r.kept}
        elif name == "benchmark_decontamination":
            items = spark.read.parquet(f"{SF}/benchmark.parquet")
            judged = decontaminate.report(before, items).collect()
            assert kept == {r.doc_id for r in judged if not r.contaminated}
        elif name == "bpe_encode_decode":
            own = bpe.WordBpe(public_tokenizers.path("word_bpe_49k.json"))
            texts = {r.doc_id: r.text for r in before.collect()}
            assert kept == given
            assert all(r.n_tokens == len(own.encode(texts[r.doc_id] or "")) for r in after.collect())
        before = after
    assert before.count() > 100


@needs_data
def test_stages_take_empty_and_crowded_tables(spark):
    found = cases.rows(20)
    for docs in (
        cases.nothing(spark),
        cases.crowded(cases.documents(spark, found), "row", "label", "node", "severity", "kept"),
    ):
        given = docs
        for _, stage in corpus_pipeline.STAGES:
            given = stage(spark, given, SF)
        assert given.count() <= docs.count()
