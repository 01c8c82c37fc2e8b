"""Price index and interest curve factors for financed reserves."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from remanente.functions.dates import month_end_after, yyyymm

CURVE = ["fecha_clave", "pais", "moneda"]
EXTRA_NODES = 2


def price_index(inflation: DataFrame) -> DataFrame:
    """Accumulated index: running product of ``1 + tasa`` in date order.

    The product runs inside each year; the years before it enter as one factor per year, so
    the only unpartitioned window sees one pre-aggregated row per year.
    """
    growth = inflation.select("fecha", "tasa", F.year("fecha").alias("_anio"))
    in_order = Window.orderBy("_anio").rowsBetween(Window.unboundedPreceding, -1)
    earlier = (
        growth.groupBy("_anio")
        .agg(F.product(1 + F.col("tasa")).alias("_factor"))
        .select("_anio", F.coalesce(F.product("_factor").over(in_order), F.lit(1.0)).alias("_antes"))
    )
    in_year = Window.partitionBy("_anio").orderBy("fecha").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    running = growth.withColumn("_en_anio", F.product(1 + F.col("tasa")).over(in_year))
    return running.join(earlier, "_anio").select(
        yyyymm("fecha").alias("mesid_ipc"),
        "tasa",
        (F.col("_antes") * F.col("_en_anio")).alias("indice_ipc"),
    )


def required_nodes(financing: DataFrame) -> DataFrame:
    """Longest financed term of each curve."""
    return (
        financing.filter(F.col("aplica_comp_financ") == 1)
        .groupBy("pais_curva", "moneda_curva")
        .agg(F.max("meses_max_vigencia").cast("long").alias("nodos_requeridos"))
    )


def needed_curve_nodes(curves: DataFrame, financing: DataFrame) -> DataFrame:
    """Curve nodes up to the longest financed term plus two, for curves in use."""
    needed = required_nodes(financing).withColumnsRenamed(
        {"pais_curva": "pais", "moneda_curva": "moneda"}
    )
    return curves.join(needed, ["pais", "moneda"], "inner").filter(
        F.col("mes") <= F.col("nodos_requeridos") + EXTRA_NODES
    )


def incomplete_curves(curves: DataFrame, financing: DataFrame) -> DataFrame:
    """Curves that end before the node their longest term needs."""
    return (
        needed_curve_nodes(curves, financing)
        .groupBy(*CURVE, "nodos_requeridos")
        .agg(F.max("mes").alias("max_nodo_encontrado"))
        .filter(F.col("max_nodo_encontrado") < F.col("nodos_requeridos") + EXTRA_NODES)
    )


def curve_factors(curves: DataFrame, financing: DataFrame, validate: bool = True) -> DataFrame:
    """Accumulation, forward and discount factor of each node, with month keys.

    With ``validate`` an incomplete curve fails the job, naming the curve. All windows share one
    partitioning, so the table is shuffled once.
    """
    nodes = needed_curve_nodes(curves, financing)
    whole = Window.partitionBy(*CURVE)
    ordered = whole.orderBy("mes")
    so_far = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    if validate:
        complete = F.col("_ultimo_nodo") >= F.col("nodos_requeridos") + EXTRA_NODES
        message = F.concat_ws(
            " ",
            F.lit("incomplete curve:"),
            *[F.col(c).cast("string") for c in (*CURVE, "nodos_requeridos", "_ultimo_nodo")],
        )
        nodes = (
            nodes.withColumn("_ultimo_nodo", F.max("mes").over(whole))
            .filter(F.when(complete, True).otherwise(F.raise_error(message).cast("boolean")))
            .drop("_ultimo_nodo")
        )
    rate = F.col("tasa_interes") / 100
    dated = nodes.withColumn("tasa_efectiva_anual", rate).withColumn(
        "fecha_curva", F.to_date(F.col("fecha_clave").cast("string"), "yyyyMMdd")
    )
    annual = 1 + F.col("tasa_efectiva_anual")
    grown = dated.withColumn("factor_acumulacion", F.pow(annual, F.col("mes") / 12))
    previous = F.lag("factor_acumulacion").over(ordered)
    forward = F.coalesce(
        F.col("factor_acumulacion") / previous - 1, F.pow(annual, F.lit(1 / 12)) - 1
    )
    valued = month_end_after("fecha_curva", F.col("mes").cast("int"))
    return (
        grown.withColumns(
            {"tasa_fwd_real": forward, "factor_desc_real": 1 / F.col("factor_acumulacion")}
        )
        .withColumns(
            {
                "sum_desc_real": F.sum("factor_desc_real").over(so_far),
                "fecha_valoracion": valued,
            }
        )
        .select(
            yyyymm("fecha_curva").alias("mesid_curva"),
            "fecha_curva",
            F.col("moneda").alias("moneda_curva"),
            F.col("pais").alias("pais_curva"),
            F.col("mes").alias("nodo"),
            yyyymm("fecha_valoracion").alias("mesid_valoracion"),
            "fecha_valoracion",
            "tasa_efectiva_anual",
            "tasa_fwd_real",
            "factor_acumulacion",
            "factor_desc_real",
            "sum_desc_real",
        )
    )
