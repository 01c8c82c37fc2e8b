"""Named queries with, where SQL can say it, an equivalent DuckDB statement."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from remanente.queries.compose import with_tables
from remanente.queries.inputs import Inputs
from remanente.queries.stages import ALL

Build = Callable[[Inputs], DataFrame]
QUERIES: dict[str, Build] = {}
STATEMENTS: dict[str, str] = {}

KEYS = ["recibo", "numero_documento_sap", "cdsubgarantia", "poliza_certificado"]


def query(name: str, sql: str | None = None) -> Callable[[Build], Build]:
    """Register the decorated function, which builds a DataFrame from the sample inputs."""

    def register(build: Build) -> Build:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = build
        if sql is not None:
            STATEMENTS[name] = with_tables(sql, ALL)
        return build

    return register


def bound(build: Build) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf: build(Inputs(spark, sf))


def exact(column: str | Column) -> Column:
    """Twelve decimals, on which rounding is half away from zero in every engine."""
    x = F.col(column) if isinstance(column, str) else column
    return x.cast("decimal(38,12)")


def r(column: str | Column, digits: int = 4) -> Column:
    """Rounded value, first to three more places: that drops what engines differ in.

    Of decimals, so that zero has no sign.
    """
    return F.round(F.round(exact(column), digits + 3), digits).cast("double")


def shown(df: DataFrame, plain: Sequence[str], rounded: Sequence[str] = (), digits: int = 4):
    """Columns as they are, and amounts rounded."""
    return df.select(*plain, *[r(c, digits).alias(c) for c in rounded])


def total(column: str | Column, scale: int = 4) -> Column:
    """Sum of the unrounded amounts in decimals; only the sum is rounded."""
    return F.round(F.round(F.sum(exact(column)), scale + 3), scale).cast("double")


def n() -> Column:
    return F.count(F.lit(1))
