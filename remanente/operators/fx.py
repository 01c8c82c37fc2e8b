"""Exchange-rate fluctuation of foreign-currency reserves."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from remanente.config import RunConfig
from remanente.functions.dates import yyyymm
from remanente.operators.lookups import attach_fx_rates
from remanente.vocabulary import ESTANDARES_LOCALES


def is_local_standard() -> Column:
    return F.col("tipo_contabilidad").isin(*ESTANDARES_LOCALES)


def first_month() -> Column:
    """The row is recognised in the valuation month."""
    return yyyymm("fecha_constitucion") == yyyymm("fecha_valoracion")


def rate_change() -> Column:
    """Rate now minus the rate at recognition, or at the previous close after the first month."""

    def change(suffix: str) -> Column:
        before = F.when(first_month(), F.col("tasa_cambio_fecha_constitucion")).otherwise(
            F.col(f"tasa_cambio_fecha_valoracion_anterior_{suffix}")
        )
        return F.col(f"tasa_cambio_fecha_valoracion_{suffix}") - before

    return F.when(is_local_standard(), change("local")).otherwise(change("corporativo"))


def fx_fluctuation(accrued: DataFrame, rates: DataFrame, cfg: RunConfig) -> DataFrame:
    """Effect of the rate change on balance and release; 0 and rates of 1 in local currency.

    A row without currency is kept with no effect. As coded it is dropped, and the balance
    effect is 0 wherever no interest is credited.
    """
    foreign = F.col("moneda") != cfg.moneda_local
    rows = accrued.filter(F.col("moneda").isNotNull()) if cfg.as_coded else accrued
    rows = rows.drop("fluctuacion_constitucion", "fluctuacion_liberacion")
    interest = F.col("acreditacion_intereses")
    if not cfg.as_coded:
        interest = F.coalesce(interest, F.lit(0.0))
    zero = F.lit(0.0)
    rated = attach_fx_rates(rows, rates, cfg)
    rate_columns = [c for c in rated.columns if c.startswith("tasa_cambio_")]
    neutral = rated.withColumns(
        {c: F.when(foreign, F.col(c)).otherwise(1.0) for c in rate_columns}
    )
    balance_effect = (F.col("saldo") + interest) * F.col("_cambio_tasa")
    release_effect = -1 * F.col("valor_liberacion") * F.col("_cambio_tasa")
    return (
        neutral.withColumn("_cambio_tasa", rate_change())
        .withColumns(
            {
                "fluctuacion_constitucion": F.coalesce(F.when(foreign, balance_effect), zero),
                "fluctuacion_liberacion": F.coalesce(F.when(foreign, release_effect), zero),
            }
        )
        .drop("_cambio_tasa")
    )
