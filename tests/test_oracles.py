"""Every query with SQL gives the same rows in Spark and DuckDB."""

from __future__ import annotations

import os

import oracle
import pytest

import __spark_entry__ as entry
from remanente.queries.registry import QUERIES, STATEMENTS

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
@pytest.mark.parametrize("name", sorted(STATEMENTS))
def test_same_rows_as_sql(spark, con, name):
    result = oracle.compare(entry.queries()[name](spark, SF), entry.oracle_sql()[name], con)
    assert oracle.matches(result), result
    assert result["rows"] > 0


def test_every_query_has_sql():
    assert set(QUERIES) == set(STATEMENTS)
    assert set(entry.oracle_sql()) <= set(entry.queries())
