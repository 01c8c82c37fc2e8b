"""A chain of monthly closes in which contract balances go from one close to the next.

The close of a month reads the published accrual output of the month before, so the chain is state that
lives in the published tables: it can stop after any month, and go on in another session. A month whose
predecessor is not published is refused, unless it is said to be the first.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from remanente.config import RunConfig
from remanente.plans.close import ACCRUAL, CLOSED_BEFORE, CloseResult, Tables, run_close
from remanente.sources.publication import published, read_published
from remanente.vocabulary import INSUMOS_LIMITE


def closed_before(spark: SparkSession, folder: str, cfg: RunConfig) -> DataFrame:
    """Contract rows of the accrual output published for the month before; a gap is refused."""
    if not published(spark, folder, cfg.cierre_anterior):
        raise ValueError(
            f"the close of {cfg.fecha_valoracion} needs that of {cfg.cierre_anterior}, which is not "
            f"published in {folder}"
        )
    accrued = read_published(spark, folder, ACCRUAL, cfg.cierre_anterior)
    return accrued.filter(F.col("tipo_insumo").isin(*INSUMOS_LIMITE))


def next_close(
    spark: SparkSession, t: Tables, cfg: RunConfig, folder: str, first: bool = False
) -> CloseResult:
    """The close of a month, with the balances of the month before; the first of a chain has none."""
    carried = {} if first else {CLOSED_BEFORE: closed_before(spark, folder, cfg)}
    return run_close(spark, {**t, **carried}, cfg, folder)


def run_chain(
    spark: SparkSession, t: Tables, cfg: RunConfig, days: Sequence[date], folder: str
) -> list[CloseResult]:
    """Closes at each of ``days``, from the first of a chain on."""
    return [
        next_close(spark, t, replace(cfg, fecha_valoracion=day), folder, first=k == 0)
        for k, day in enumerate(days)
    ]
