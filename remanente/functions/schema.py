"""Column naming and schema alignment, all decided from plan metadata."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_REAL = (T.FloatType, T.DoubleType)


def _wider(first: T.DataType, other: T.DataType) -> T.DataType:
    """Whole and real numbers meet at double, whole numbers at the longer one, else first seen."""
    if first == other:
        return first
    if isinstance(first, T.NullType):
        return other
    if isinstance(first, _WHOLE + _REAL) and isinstance(other, _WHOLE + _REAL):
        if isinstance(first, _WHOLE) and isinstance(other, _WHOLE):
            return max(first, other, key=lambda t: _WHOLE.index(type(t)))
        return T.DoubleType()
    return first


def merged_fields(frames: Iterable[DataFrame]) -> dict[str, T.DataType]:
    """Union of the columns of ``frames`` in first-seen order with one type each."""
    fields: dict[str, T.DataType] = {}
    for frame in frames:
        for f in frame.schema.fields:
            fields[f.name] = _wider(fields[f.name], f.dataType) if f.name in fields else f.dataType
    return fields


def _conform(frame: DataFrame, fields: dict[str, T.DataType]) -> DataFrame:
    own = {f.name: f.dataType for f in frame.schema.fields}
    columns = [
        f"`{n}`" if own.get(n) == t
        else f"CAST({f'`{n}`' if n in own else 'NULL'} AS {t.simpleString()}) AS `{n}`"
        for n, t in fields.items()
    ]
    return frame.selectExpr(*columns)


def align_schemas(frames: Sequence[DataFrame]) -> list[DataFrame]:
    """Give every frame the same columns, order and types; missing columns become typed nulls."""
    fields = merged_fields(frames)
    return [_conform(f, fields) for f in frames]


def union_aligned(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name with missing columns as nulls and numeric types widened."""
    return reduce(DataFrame.union, align_schemas(frames))


def union_by_position(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by position with the widest numeric type of each column, named as in the first."""
    names = frames[0].columns
    renamed = [f.toDF(*names) for f in frames]
    return reduce(DataFrame.union, align_schemas(renamed))


def ensure_columns(df: DataFrame, fields: dict[str, str]) -> DataFrame:
    """Add the typed null columns of ``fields`` that ``df`` does not have yet."""
    missing = {n: F.expr(f"CAST(NULL AS {t})") for n, t in fields.items() if n not in df.columns}
    return df.withColumns(missing) if missing else df


def standard_name(name: str) -> str:
    """Lower-case ASCII name with runs of blanks and hyphens as one underscore."""
    plain = unicodedata.normalize("NFD", name).encode("ascii", "ignore").decode().lower()
    return re.sub(r"\W", "", re.sub(r"[ -]+", "_", plain))


def standardize_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[standard_name(c) for c in df.columns])


def with_cohort(df: DataFrame) -> DataFrame:
    """Cohort year: policy issue for direct contracts, reinsurance contract start otherwise."""
    issue, contract = "fecha_expedicion_poliza", "fe_ini_vig_contrato_reaseguro"
    has_issue, has_contract = issue in df.columns, contract in df.columns
    if not (has_issue or has_contract):
        raise ValueError(f"the cohort needs {issue} or {contract}")
    if has_issue and has_contract:
        year = F.when(F.col("tipo_contrato") == "directo", F.year(issue)).otherwise(F.year(contract))
    else:
        year = F.year(issue if has_issue else contract)
    return df.withColumn("cohorte", year)


def with_transition(df: DataFrame, transition_date) -> DataFrame:
    at_transition = F.col("fecha_valoracion") == F.lit(transition_date)
    return df.withColumn("transicion", F.when(at_transition, "1").otherwise("0"))


def with_result_tags(df: DataFrame, transition_date) -> DataFrame:
    """Cohort, release year (current or earlier) and transition tag of an accrual result."""
    same_year = F.year("fecha_constitucion") == F.year("fecha_valoracion")
    tagged = with_cohort(df).withColumn(
        "anio_liberacion", F.when(same_year, "anio_actual").otherwise("anio_anterior")
    )
    return with_transition(tagged, transition_date)
