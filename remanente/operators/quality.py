"""Controls of the inputs of a close, each as a count of rows that break it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from remanente.operators.lookups import DISCOUNT_KEYS

RATE_KEYS = [
    "compania", "ramo_sura", "canal", "producto", "tipo_gasto", "tipo_contabilidad",
]
FOR_EVER = "9999-12-31"


def overlapping(df: DataFrame, keys: Sequence[str], start: str, end: str) -> DataFrame:
    """Rows that begin before all earlier windows of their key have ended; an open end never ends.

    Windows of a key are read by start, against the running maximum of the ends before, so each row is
    looked at once, however many windows overlap.
    """
    until = F.coalesce(F.col(end), F.lit(FOR_EVER).cast("date"))
    before = Window.partitionBy(*keys).orderBy(start, until)
    latest = F.max(until).over(before.rowsBetween(Window.unboundedPreceding, -1))
    return df.withColumn("_hasta", latest).filter(F.col(start) <= F.col("_hasta")).drop("_hasta")


def repeated(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("veces")).filter("veces > 1")


def without_kept_premium(discounts: DataFrame) -> DataFrame:
    """Discounts that leave nothing of the premium, by which the list premium is divided."""
    return discounts.filter(F.col("podto_comercial") + F.col("podto_tecnico") == 1)


def without_limit(tracking: DataFrame) -> DataFrame:
    """Contracts whose aggregate limit is zero, by which consumption is divided."""
    return tracking.filter(F.col("limite_agregado_valor_instalado") == 0)


def controls(t: Mapping[str, DataFrame]) -> DataFrame:
    """``control`` and ``cantidad`` of every control whose table is given."""
    found: dict[str, tuple[DataFrame, Column]] = {}
    rows = F.count(F.lit(1))
    if "gasto" in t:
        found["tarifas_solapadas"] = (
            overlapping(t["gasto"], RATE_KEYS, "fecha_inicio", "fecha_fin"), rows,
        )
    if "riesgo_credito" in t:
        found["riesgos_solapados"] = (
            overlapping(
                t["riesgo_credito"], ["nit_reasegurador"], "fecha_inicio_vigencia", "fecha_fin_vigencia"
            ),
            rows,
        )
    if "descuento" in t:
        again = repeated(t["descuento"], DISCOUNT_KEYS)
        found["descuentos_repetidos"] = (again, F.coalesce(F.sum("veces"), F.lit(0)))
        found["descuentos_sin_prima"] = (without_kept_premium(t["descuento"]), rows)
    if "seguimiento_rea" in t:
        found["contratos_sin_limite"] = (without_limit(t["seguimiento_rea"]), rows)
    counts = [
        df.agg(count.alias("cantidad")).select(F.lit(name).alias("control"), "cantidad")
        for name, (df, count) in found.items()
    ]
    return reduce(DataFrame.unionByName, counts)
