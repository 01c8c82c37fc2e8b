"""Queries of sections 2.4 to 2.8 and 2.10: projections, aggregates, windows, sorts, unions, scalars."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from remanente.functions import dates, schema
from remanente.operators import accounting, accrual, curves, lookups, prep, quality, reconcile
from remanente.operators.wildcard import best_rule, wildcard_count
from remanente.plans.close import with_bt_counts
from remanente.queries import stages as s
from remanente.queries.inputs import CFG, TRANSITION, Inputs
from remanente.queries.lookup_queries import (
    ceded_accrued,
    ceded_impaired,
    premium_accrued,
    premium_valued,
)
from remanente.queries.prepare import direct_premium, params
from remanente.queries.registry import KEYS, n, query, r, shown, total
from remanente.sources.tables import replace_values

_K = ", ".join(KEYS)
_ROW = [*KEYS, "tipo_contabilidad"]

# --- 2.4 projections, filters, predicates ----------------------------------------------------------


@query(
    "fecha_nivel",
    f"SELECT {_K}, tipo_contabilidad, nivel_detalle, {s.level('fecha_inicio_vigencia')} AS inicio, "
    f"{s.level('fecha_fin_vigencia')} AS fin FROM todos_param",
)
def fecha_nivel(t: Inputs) -> DataFrame:
    unknown = F.when(F.col("amparo") == "O", "sin_parametro").otherwise(F.col("tipo_insumo"))
    ready = lookups.attach_accounting_params(
        t["recibos"].withColumn("tipo_insumo", unknown), params(t)
    )
    return ready.select(
        *_ROW,
        "nivel_detalle",
        dates.level_date("fecha_inicio_vigencia").alias("inicio"),
        dates.level_date("fecha_fin_vigencia").alias("fin"),
    )


@query("prep_cutoff_filter", f"SELECT {_K}, fecha_contabilizacion_recibo FROM recibos_fv")
def prep_cutoff_filter(t: Inputs) -> DataFrame:
    return prep.up_to_valuation(t["recibos"], prep.BOOKED, CFG).select(*KEYS, prep.BOOKED)


@query(
    "filter_isin",
    f"""
SELECT {_K}, ramo_sura, tipo_op FROM recibos
WHERE ramo_sura IN ('092', '095', '196') AND tipo_op NOT IN ('16', '26')""",
)
def filter_isin(t: Inputs) -> DataFrame:
    mathematical = F.col("ramo_sura").isin(*CFG.lineas_matematica)
    annulled = F.col("tipo_op").isin("16", "26")
    return t["recibos"].filter(mathematical & ~annulled).select(*KEYS, "ramo_sura", "tipo_op")


@query(
    "filter_all_horizontal",
    f"""
SELECT {_K} FROM recibos WHERE compania = '01' AND ramo_sura = '040' AND moneda = 'USD'""",
)
def filter_all_horizontal(t: Inputs) -> DataFrame:
    wanted = {"compania": "01", "ramo_sura": "040", "moneda": "USD", "campania": "*"}
    demanded = {c: v for c, v in wanted.items() if v != "*"}
    everything = reduce(Column.__and__, [F.col(c) == v for c, v in demanded.items()])
    return t["recibos"].filter(everything).select(*KEYS)


@query(
    "filter_valid_movement",
    f"SELECT {_K}, tipo_contabilidad, {s.r('valor_liberacion')} AS valor_md FROM dev_prima "
    "WHERE valor_liberacion IS NOT NULL AND valor_liberacion <> 0",
)
def filter_valid_movement(t: Inputs) -> DataFrame:
    amounts = premium_accrued(t).select(*_ROW, F.col("valor_liberacion").alias("valor_md"))
    return shown(accounting.valid_movements(amounts), _ROW, ["valor_md"])


@query(
    "filter_policy_scope",
    f"""
SELECT {_K}, poliza FROM (SELECT * REPLACE (CASE WHEN amparo = 'O' THEN NULL
    WHEN cdsubgarantia = '7' THEN '-1' WHEN cdsubgarantia = '6' THEN '' ELSE poliza END AS poliza)
  FROM recibos)
WHERE poliza NOT IN ('-1', '', '124324091') AND poliza IS NOT NULL""",
)
def filter_policy_scope(t: Inputs) -> DataFrame:
    policy = (
        F.when(F.col("amparo") == "O", F.lit(None))
        .when(F.col("cdsubgarantia") == "7", "-1")
        .when(F.col("cdsubgarantia") == "6", "")
        .otherwise(F.col("poliza"))
    )
    return reconcile.in_policy_scope(t["recibos"].withColumn("poliza", policy)).select(
        *KEYS, "poliza"
    )


@query(
    "project_rename_map",
    f"SELECT {_K}, amparo AS garantia, cdsubgarantia AS subgarantia, moneda AS moneda_documento "
    "FROM recibos",
)
def project_rename_map(t: Inputs) -> DataFrame:
    theirs = {ours: name for name, ours in reconcile.NOMBRES_DEL_MOTOR.items()}
    kept = t["recibos"].select(*KEYS, "amparo", F.col("cdsubgarantia").alias("_s"), "moneda")
    names = {"amparo": theirs["amparo"], "_s": theirs["cdsubgarantia"], "moneda": theirs["moneda"]}
    return kept.withColumnsRenamed(names)


@query(
    "project_exclude",
    "SELECT * EXCLUDE (tipo_insumo, tipo_negocio, valor_prima_emitida) FROM recibos",
)
def project_exclude(t: Inputs) -> DataFrame:
    return t["recibos"].drop("tipo_insumo", "tipo_negocio", "valor_prima_emitida", "no_existe")


@query(
    "cohorte",
    f"""
SELECT {_K}, tipo_contabilidad, tipo_contrato, {s._COHORT} AS cohorte FROM (
  SELECT *, CAST(NULL AS DATE) AS fe_ini_vig_contrato_reaseguro FROM prima_directo
  UNION ALL BY NAME SELECT * FROM prima_rea)""",
)
def cohorte(t: Inputs) -> DataFrame:
    ceded = prep.ceded_premium(t["cesion_rea"], params(t), t["excepciones_50_50"], CFG)
    both = schema.union_aligned([direct_premium(t), ceded])
    return schema.with_cohort(both).select(*_ROW, "tipo_contrato", "cohorte")


@query(
    "transicion",
    f"""
SELECT {_K}, fecha_valoracion, CASE WHEN fecha_valoracion = {s.TRANSICION} THEN '1' ELSE '0' END
  AS transicion FROM (SELECT *, last_day(fecha_contabilizacion_recibo) AS fecha_valoracion
  FROM recibos)""",
)
def transicion(t: Inputs) -> DataFrame:
    closes = t["recibos"].withColumn("fecha_valoracion", F.last_day(prep.BOOKED))
    return schema.with_transition(closes, TRANSITION).select(
        *KEYS, "fecha_valoracion", "transicion"
    )


@query(
    "etiquetar_resultado",
    f"SELECT {_K}, tipo_contabilidad, tipo_negocio, cohorte, anio_liberacion, transicion "
    "FROM dev_rea",
)
def etiquetar_resultado(t: Inputs) -> DataFrame:
    return ceded_accrued(t).select(
        *_ROW, "tipo_negocio", "cohorte", "anio_liberacion", "transicion"
    )


@query(
    "alinear_esquemas",
    """
SELECT tipo_insumo, recibo, poliza, moneda, contrato_reaseguro, CAST(filas AS DOUBLE) AS filas,
  valor FROM (
  SELECT tipo_insumo, recibo, poliza, moneda, CAST(1 AS DOUBLE) AS filas,
    valor_prima_emitida AS valor FROM recibos
  UNION ALL BY NAME
  SELECT tipo_insumo, recibo, moneda, contrato_reaseguro, CAST(0.5 AS DOUBLE) AS filas
  FROM costo_contrato_rea)""",
)
def alinear_esquemas(t: Inputs) -> DataFrame:
    first = t["recibos"].select(
        "tipo_insumo", "recibo", "poliza", "moneda", F.lit(1).alias("filas"),
        F.col("valor_prima_emitida").alias("valor"),
    )
    second = t["costo_contrato_rea"].select(
        "tipo_insumo", "recibo", "moneda", "contrato_reaseguro", F.lit(0.5).alias("filas")
    )
    return reduce(DataFrame.unionByName, schema.align_schemas([first, second]))


@query(
    "estandarizar_columnas",
    """
SELECT o_orderkey AS numero_de_poliza, o_totalprice AS valor_emision, o_orderstatus AS anio_
FROM orders""",
)
def estandarizar_columnas(t: Inputs) -> DataFrame:
    raw = t.spark.read.parquet(f"{t.sf}/orders.parquet").select(
        F.col("o_orderkey").alias("Número - de póliza"),
        F.col("o_totalprice").alias("Valor Emisión"),
        F.col("o_orderstatus").alias("ANIO-(*)"),
    )
    return schema.standardize_columns(raw)


@query(
    "output_projection",
    f"""
SELECT {_K}, moneda, componente, tipo_contabilidad, regla_devengo, tipo_contrato, cohorte,
  anio_liberacion, transicion, fecha_inicio_periodo, fecha_valoracion, fecha_constitucion,
  fecha_inicio_devengo, fecha_fin_devengo, {s.r('valor_base_devengo')} AS valor_base_devengo,
  CAST(NULL AS VARCHAR) AS pais_curva, dias_devengados, mes_constitucion,
  CAST(NULL AS DOUBLE) AS porc_consumo_limite, estado_devengo FROM dev_prima""",
)
def output_projection(t: Inputs) -> DataFrame:
    """The fixed result columns are there whichever rules the input used."""
    kept = [
        "componente", "tipo_contabilidad", "regla_devengo", "tipo_contrato", "cohorte",
        "anio_liberacion", "transicion", "fecha_inicio_periodo", "fecha_valoracion",
        "fecha_constitucion", "fecha_inicio_devengo", "fecha_fin_devengo",
    ]
    return premium_accrued(t).select(
        *KEYS, "moneda", *kept, r("valor_base_devengo").alias("valor_base_devengo"), "pais_curva",
        "dias_devengados", "mes_constitucion", "porc_consumo_limite", "estado_devengo",
    )


# --- 2.5 aggregations ---------------------------------------------------------------------------------

s.ALL["financ_datos"] = """
SELECT moneda AS moneda_curva, compania AS pais_curva, ramo_sura,
  CASE WHEN ramo_sura = '003' THEN 1 ELSE 0 END AS aplica_comp_financ,
  CAST(MAX((year(fecha_fin_vigencia_recibo) - year(fecha_inicio_vigencia_recibo)) * 12
    + month(fecha_fin_vigencia_recibo) - month(fecha_inicio_vigencia_recibo)) AS INT)
    AS meses_max_vigencia
FROM recibos GROUP BY 1, 2, 3, 4"""


def financing_from_receipts(t: Inputs) -> DataFrame:
    """Financing parameters with the longest term found among the receipts."""
    months = dates.months_apart("fecha_inicio_vigencia_recibo", "fecha_fin_vigencia_recibo")
    return (
        t["recibos"]
        .groupBy(F.col("moneda").alias("moneda_curva"), F.col("compania").alias("pais_curva"),
                 "ramo_sura")
        .agg(F.max(months).alias("meses_max_vigencia"))
        .withColumn("aplica_comp_financ", F.when(F.col("ramo_sura") == "003", 1).otherwise(0))
    )


@query(
    "curva_nodos_requeridos",
    """
SELECT pais_curva, moneda_curva, CAST(MAX(meses_max_vigencia) AS BIGINT) AS nodos_requeridos
FROM financ_datos WHERE aplica_comp_financ = 1 GROUP BY 1, 2""",
)
def curva_nodos_requeridos(t: Inputs) -> DataFrame:
    return curves.required_nodes(financing_from_receipts(t))


s.ALL["curvas_cortas"] = """
SELECT * FROM curvas WHERE mes <= 34 + (fecha_clave // 100) % 100"""


@query(
    "curva_validacion",
    """
SELECT c.fecha_clave, c.pais, c.moneda, n.nodos_requeridos, MAX(c.mes) AS max_nodo_encontrado
FROM curvas_cortas AS c JOIN nodos_requeridos AS n
  ON c.pais = n.pais_curva AND c.moneda = n.moneda_curva AND c.mes <= n.nodos_requeridos + 2
GROUP BY 1, 2, 3, 4 HAVING MAX(c.mes) < n.nodos_requeridos + 2""",
)
def curva_validacion(t: Inputs) -> DataFrame:
    """Curves cut to 34 nodes plus their calendar month; the early months fall short."""
    month = F.floor(F.col("fecha_clave") / 100) % 100
    short = t["curvas"].filter(F.col("mes") <= 34 + month)
    return curves.incomplete_curves(short, t["componente_financiacion"])


@query(
    "gastos_validacion",
    f"""
SELECT rows_in_partition, list_sort(list(DISTINCT tipo_gasto)) AS tipo_gasto_unicos FROM (
  SELECT tipo_gasto, COUNT(*) AS rows_in_partition FROM todos_gasto_cand
  GROUP BY {s._GKEYS}, tipo_gasto) GROUP BY 1 ORDER BY 1""",
)
def gastos_validacion(t: Inputs) -> DataFrame:
    return lookups.expense_match_sizes(t["recibos"], t["gasto"])


@query("onerosidad_acumulada", "SELECT compania, ramo_sura, poliza, onerosidad FROM onerosas")
def onerosidad_acumulada(t: Inputs) -> DataFrame:
    return accounting.onerous_policies(t["onerosidad"], CFG)


@query(
    "distinct_rows",
    f"""SELECT {s._SHARE.replace('porc_cesion', s.r('porc_cesion') + ' AS porc_cesion')}
FROM polizas_rea""",
)
def distinct_rows(t: Inputs) -> DataFrame:
    shares = t["cesion_rea"].select(*prep.CEDED_POLICY_FIELDS).distinct()
    return shown(shares, prep.CEDED_POLICY_FIELDS[:-1], ["porc_cesion"])


_RATE = ", ".join(quality.RATE_KEYS)
_DISCOUNT = ", ".join(lookups.DISCOUNT_KEYS)


@query(
    "conteo_registros",
    f"""
SELECT 'movimientos_antes' AS control, COUNT(*) AS cantidad FROM mov_prima
UNION ALL SELECT 'filas_contables', COUNT(*) FROM cont_prima
UNION ALL SELECT 'con_bt', COUNT(*) FROM cont_prima WHERE bt IS NOT NULL
UNION ALL SELECT 'tarifas_solapadas', COUNT(*) FROM (
  SELECT fecha_inicio, MAX(fecha_fin) OVER (PARTITION BY {_RATE} ORDER BY fecha_inicio, fecha_fin
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS hasta FROM gasto)
  WHERE fecha_inicio <= hasta
UNION ALL SELECT 'riesgos_solapados', COUNT(*) FROM riesgo_credito AS a
  WHERE EXISTS (SELECT 1 FROM riesgo_credito AS b WHERE a.nit_reasegurador = b.nit_reasegurador
    AND b.fecha_inicio_vigencia < a.fecha_inicio_vigencia
    AND COALESCE(b.fecha_fin_vigencia, DATE '9999-12-31') >= a.fecha_inicio_vigencia)
UNION ALL SELECT 'descuentos_repetidos', CAST(COALESCE(SUM(veces), 0) AS BIGINT) FROM (
  SELECT COUNT(*) AS veces FROM descuento GROUP BY {_DISCOUNT}) WHERE veces > 1
UNION ALL SELECT 'descuentos_sin_prima', COUNT(*) FROM descuento
  WHERE podto_comercial + podto_tecnico = 1
UNION ALL SELECT 'contratos_sin_limite', COUNT(*) FROM seguimiento_rea
  WHERE limite_agregado_valor_instalado = 0""",
)
def conteo_registros(t: Inputs) -> DataFrame:
    """Movements before and after the business-transaction join, counted in passing while they are
    worked out once, and the controls of the inputs."""
    before, after = Observation(), Observation()
    coded = accounting.attach_insurance_type(
        accounting.map_codes(accounting.to_movements(premium_valued(t)), t["nomenclatura"]),
        t["tipo_seguro"],
    ).observe(before, F.count(F.lit(1)).alias("movimientos_antes"))
    joined = accounting.attach_bt(coded, accounting.bt_in_scope(t["relacion_bt"]))
    with_bt_counts(joined, after).write.format("noop").mode("overwrite").save()
    seen = t.spark.createDataFrame(
        list({**before.get, **after.get}.items()), "control string, cantidad long"
    )
    given = t.only("gasto", "riesgo_credito", "descuento", "seguimiento_rea")
    return seen.unionByName(quality.controls(given))


# --- 2.6 windows ----------------------------------------------------------------------------------------


@query(
    "win_best_expense",
    f"SELECT {_K}, tipo_gasto, tipo_contabilidad, prioridad_match FROM gasto_rea_mejor",
)
def win_best_expense(t: Inputs) -> DataFrame:
    receipts = prep.up_to_valuation(t["cesion_rea"], prep.BOOKED, CFG)
    return lookups.attach_expenses(receipts, t["gasto"]).select(
        *KEYS, "tipo_gasto", "tipo_contabilidad", "prioridad_match"
    )


@query(
    "win_best_financing",
    f"""
SELECT {', '.join('b.' + k for k in KEYS)}, b.tipo_contabilidad,
  CAST(k.regla.n AS INT) AS nivel_comodin
FROM prima_directo AS b LEFT JOIN prima_financ_regla AS k
  ON {s.same_financing_keys("b", "k")}""",
)
def win_best_financing(t: Inputs) -> DataFrame:
    """Wildcards of the chosen financing rule: fewest first."""
    choice = F.struct(wildcard_count(lookups.FINANCING_WILD).alias("nivel"))
    ruled = best_rule(
        direct_premium(t), t["componente_financiacion"], ["tipo_contabilidad", "moneda"],
        lookups.FINANCING_WILD, choice, "_f",
    )
    return ruled.select(*_ROW, F.col("_f.nivel").alias("nivel_comodin"))


_CURVE = ["mesid_curva", "moneda_curva", "pais_curva", "nodo"]


def _factor_column(t: Inputs, name: str) -> DataFrame:
    return shown(
        curves.curve_factors(t["curvas"], t["componente_financiacion"]), _CURVE, [name], 9
    )


@query(
    "win_prev_factor",
    f"SELECT {', '.join(_CURVE)}, {s.r('tasa_fwd_real', 9)} AS tasa_fwd_real FROM factores",
)
def win_prev_factor(t: Inputs) -> DataFrame:
    return _factor_column(t, "tasa_fwd_real")


@query(
    "win_cum_sum",
    f"SELECT {', '.join(_CURVE)}, {s.r('sum_desc_real', 9)} AS sum_desc_real FROM factores",
)
def win_cum_sum(t: Inputs) -> DataFrame:
    return _factor_column(t, "sum_desc_real")


@query(
    "win_cum_prod",
    f"SELECT mesid_ipc, {s.r('indice_ipc', 9)} AS indice_ipc FROM indice_ipc",
)
def win_cum_prod(t: Inputs) -> DataFrame:
    return shown(curves.price_index(t["inflacion"]), ["mesid_ipc"], ["indice_ipc"], 9)


@query("win_group_min", f"SELECT {_K}, poliza, x_anulacion AS primera_anulacion FROM inversion_fv")
def win_group_min(t: Inputs) -> DataFrame:
    booked = prep.up_to_valuation(t["componente_inversion"], prep.BOOKED, CFG).withColumn(
        "fecha_constitucion", F.col(prep.BOOKED)
    )
    return prep.first_annulment(booked).select(
        *KEYS, "poliza", F.col("fecha_primera_anulacion").alias("primera_anulacion")
    )


@query(
    "win_row_index",
    """
SELECT tipo_contabilidad, ramo_sura, aplica_comp_financ, COUNT(*) AS filas FROM prima_financ_finparam
GROUP BY 1, 2, 3""",
)
def win_row_index(t: Inputs) -> DataFrame:
    """Every row keeps exactly one financing parameter without a row index."""
    out = lookups.attach_financing_params(direct_premium(t), t["componente_financiacion"])
    return out.groupBy("tipo_contabilidad", "ramo_sura", "aplica_comp_financ").agg(
        n().alias("filas")
    )


# --- 2.7 sorts, limits, top 1 ---------------------------------------------------------------------------


@query(
    "sort_series",
    f"SELECT fecha, {s.r('tasa')} AS tasa FROM inflacion ORDER BY fecha",
)
def sort_series(t: Inputs) -> DataFrame:
    return t["inflacion"].orderBy("fecha").select("fecha", r("tasa").alias("tasa"))


@query(
    "sort_output",
    f"""
SELECT rows_in_partition, COUNT(*) AS grupos FROM (
  SELECT COUNT(*) AS rows_in_partition FROM todos_gasto_cand GROUP BY {s._GKEYS}, tipo_gasto)
GROUP BY 1 ORDER BY 1""",
)
def sort_output(t: Inputs) -> DataFrame:
    sizes = lookups.expense_matches(t["recibos"], t["gasto"])
    return sizes.groupBy("rows_in_partition").agg(n().alias("grupos")).orderBy("rows_in_partition")


@query(
    "top1_by_group",
    """
SELECT tipo_gasto, tipo_contabilidad, prioridad_match, COUNT(*) AS filas,
  """ + s.total("porc_gasto") + """ AS porc_gasto FROM todos_gasto GROUP BY 1, 2, 3""",
)
def top1_by_group(t: Inputs) -> DataFrame:
    best = lookups.attach_expenses(t["recibos"], t["gasto"])
    return best.groupBy("tipo_gasto", "tipo_contabilidad", "prioridad_match").agg(
        n().alias("filas"), total("porc_gasto").alias("porc_gasto")
    )


_LIMIT_ORDER = (
    "recibo, numero_documento_sap, cdsubgarantia, poliza_certificado, tipo_contabilidad, "
    "fecha_fin_devengo, valor_base_devengo"
)


@query(
    "limit_rows",
    f"""
SELECT {_K}, tipo_contabilidad, estado_devengo, {s.r('saldo')} AS saldo FROM dev_prima
WHERE saldo <> 0 ORDER BY {_LIMIT_ORDER} LIMIT 1000""",
)
def limit_rows(t: Inputs) -> DataFrame:
    """First open balances in a fixed order, the sample kept of a long report."""
    opened = premium_accrued(t).filter(F.col("saldo") != 0)
    first = opened.orderBy(*_LIMIT_ORDER.split(", ")).limit(1000)
    return shown(first, [*_ROW, "estado_devengo"], ["saldo"])


# --- 2.8 set operations -----------------------------------------------------------------------------------


@query(
    "union_diagonal_relaxed",
    """
SELECT tipo_insumo, recibo, compania, mes_cotizacion, fecha_expedicion_poliza, valor FROM (
  SELECT tipo_insumo, recibo, compania, fecha_expedicion_poliza, valor_prima_emitida AS valor
  FROM recibos
  UNION ALL BY NAME
  SELECT tipo_insumo, recibo, compania, mes_cotizacion, CAST(x AS DOUBLE) AS valor
  FROM (SELECT *, 1 AS x FROM produccion_arl))""",
)
def union_diagonal_relaxed(t: Inputs) -> DataFrame:
    first = t["recibos"].select(
        "tipo_insumo", "recibo", "compania", "fecha_expedicion_poliza",
        F.col("valor_prima_emitida").alias("valor"),
    )
    second = t["produccion_arl"].select(
        "tipo_insumo", "recibo", "compania", "mes_cotizacion", F.lit(1).alias("valor")
    )
    return schema.union_aligned([first, second])


@query(
    "union_diagonal",
    f"""
SELECT tipo_insumo, ramo_sura, estado_devengo, COUNT(*) AS filas, {s.total('saldo')} AS saldo
FROM dev_mix WHERE regla_devengo IN ('diario', 'mensual_devengo_50_50') GROUP BY 1, 2, 3""",
)
def union_diagonal(t: Inputs) -> DataFrame:
    from remanente.queries.accrual_queries import mixed_inputs

    out = accrual.accrue(mixed_inputs(t), CFG).filter(
        F.col("regla_devengo").isin("diario", "mensual_devengo_50_50")
    )
    return out.groupBy("tipo_insumo", "ramo_sura", "estado_devengo").agg(
        n().alias("filas"), total("saldo").alias("saldo")
    )


@query(
    "union_vertical_relaxed",
    """
SELECT poliza, recibo, CAST(dias AS DOUBLE) AS dias FROM (
  SELECT poliza, recibo, 1 AS dias FROM cartera
  UNION ALL SELECT poliza, recibo, CAST(1.5 AS DOUBLE) FROM cuenta_corriente)""",
)
def union_vertical_relaxed(t: Inputs) -> DataFrame:
    first = t["cartera"].select("poliza", "recibo", F.lit(1).alias("dias"))
    second = t["cuenta_corriente"].select("poliza", "recibo", F.lit(1.5).alias("otros_dias"))
    return schema.union_by_position([first, second])


@query(
    "union_vstack",
    """
SELECT tipo_negocio, prob_incumplimiento_actual IS NULL AS sin_riesgo, COUNT(*) AS filas
FROM det_rea GROUP BY 1, 2""",
)
def union_vstack(t: Inputs) -> DataFrame:
    """Rows with and without credit risk come out of one pass."""
    return ceded_impaired(t).groupBy(
        "tipo_negocio", F.col("prob_incumplimiento_actual").isNull().alias("sin_riesgo")
    ).agg(n().alias("filas"))


@query(
    "componentes_no_devengables",
    f"""
SELECT tipo_insumo, tipo_contabilidad, tipo_movimiento, COUNT(*) AS filas,
  {s.total('valor_ml', 2)} AS valor_ml FROM mov_prima_cartera GROUP BY 1, 2, 3""",
)
def componentes_no_devengables(t: Inputs) -> DataFrame:
    movements = accounting.to_movements(premium_valued(t))
    balances = [prep.receivables(t[b], params(t), CFG) for b in ("cartera", "cuenta_corriente")]
    return (
        accounting.append_non_accruable(movements, balances)
        .groupBy("tipo_insumo", "tipo_contabilidad", "tipo_movimiento")
        .agg(n().alias("filas"), total("valor_ml", 2).alias("valor_ml"))
    )


# --- 2.10 scalars -----------------------------------------------------------------------------------------

_A, _B = "fecha_contabilizacion_recibo", "fecha_inicio_vigencia_recibo"


@query(
    "scalar_dates",
    f"""
SELECT {_K}, {s.ym(_A)} AS mes, {s.days(_B, _A)} + 1 AS dias, {s.days(_B, _A)} AS dias_sin_extremo,
  last_day(CAST({_A} + to_months(CAST(cdsubgarantia AS INT)) AS DATE)) AS cierre_siguiente,
  {_A} = last_day({_A}) AS es_cierre,
  CASE WHEN month({_A}) = 1 THEN CAST((year({_A}) - 1) * 100 + 12 AS INT)
    ELSE CAST(year({_A}) * 100 + month({_A}) - 1 AS INT) END AS mes_anterior,
  CAST(date_trunc('month', {_A}) AS DATE) AS inicio_mes, last_day({_A}) AS fin_mes,
  CAST({_A} - INTERVAL 1 MONTH AS DATE) AS un_mes_antes, CAST(year({_A}) AS INT) AS anio,
  CAST(month({_A}) AS INT) AS numero_mes, CAST(day({_A}) AS INT) AS dia,
  CAST(strptime(strftime({_A}, '%Y%m%d'), '%Y%m%d') AS DATE) AS desde_texto,
  CAST({_A} + INTERVAL 1 DAY AS DATE) AS dia_siguiente,
  CAST(last_day({_A}) + INTERVAL 1 MONTH AS DATE) AS cierre_mas_un_mes
FROM recibos""",
)
def scalar_dates(t: Inputs) -> DataFrame:
    a, b = F.col(_A), F.col(_B)
    return t["recibos"].select(
        *KEYS,
        dates.yyyymm(a).alias("mes"),
        dates.days_between(b, a).alias("dias"),
        dates.days_between(b, a, inclusive=False).alias("dias_sin_extremo"),
        dates.month_end_after(a, F.col("cdsubgarantia").cast("int")).alias("cierre_siguiente"),
        dates.is_month_end(a).alias("es_cierre"),
        dates.previous_month(dates.yyyymm(a)).alias("mes_anterior"),
        dates.month_start(a).alias("inicio_mes"),
        F.last_day(a).alias("fin_mes"),
        F.add_months(a, -1).alias("un_mes_antes"),
        F.year(a).alias("anio"),
        F.month(a).alias("numero_mes"),
        F.dayofmonth(a).alias("dia"),
        F.to_date(F.date_format(a, "yyyyMMdd"), "yyyyMMdd").alias("desde_texto"),
        F.date_add(a, 1).alias("dia_siguiente"),
        F.add_months(F.last_day(a), 1).alias("cierre_mas_un_mes"),
    )


@query(
    "scalar_math_null",
    f"""
SELECT {_K}, {s.r('pow(CAST(1.01 AS DOUBLE), CAST(cdsubgarantia AS DOUBLE) / 12)', 9)} AS potencia,
  {s.r('abs(valor_prima_emitida)')} AS absoluto,
  {s.r('valor_prima_emitida / NULLIF(CAST(cdsubgarantia AS INT) - 1, 0)')} AS cociente,
  abs(valor_prima_emitida) > 1e-6 AS sobre_tolerancia,
  GREATEST({_A}, {_B}) AS mayor, LEAST({_A}, CASE WHEN amparo = 'O' THEN {_B} END) AS menor,
  CASE WHEN tipo_op = '26' THEN 'anulada' WHEN tipo_op = '16' THEN 'cancelada'
    ELSE 'vigente' END AS caso,
  COALESCE(CASE WHEN amparo = 'O' THEN moneda END, 'sin moneda') AS con_valor,
  CASE WHEN amparo = 'O' THEN CAST(0 AS DOUBLE) ELSE {s.r('valor_prima_emitida')} END
    AS sin_nan, (amparo = 'O') AS es_nan
FROM recibos""",
)
def scalar_math_null(t: Inputs) -> DataFrame:
    amount, gate = F.col("valor_prima_emitida"), F.col("amparo") == "O"
    line = F.col("cdsubgarantia")
    nan = F.when(gate, F.lit(float("nan"))).otherwise(amount)
    return t["recibos"].select(
        *KEYS,
        r(F.pow(F.lit(1.01), line.cast("double") / 12), 9).alias("potencia"),
        r(F.abs(amount)).alias("absoluto"),
        r(F.try_divide(amount, line.cast("int") - 1)).alias("cociente"),
        (F.abs(amount) > 1e-6).alias("sobre_tolerancia"),
        F.greatest(_A, _B).alias("mayor"),
        F.least(F.col(_A), F.when(gate, F.col(_B))).alias("menor"),
        F.when(F.col("tipo_op") == "26", "anulada")
        .when(F.col("tipo_op") == "16", "cancelada")
        .otherwise("vigente")
        .alias("caso"),
        F.coalesce(F.when(gate, F.col("moneda")), F.lit("sin moneda")).alias("con_valor"),
        r(F.coalesce(F.nanvl(nan, F.lit(0.0)), F.lit(0.0))).alias("sin_nan"),
        F.isnan(nan).alias("es_nan"),
    )


@query(
    "scalar_strings_casts",
    f"""
SELECT {_K}, 'matematica_local_' || tipo_insumo AS unido, upper(canal) AS mayusculas,
  ends_with(producto, '1') AS termina, regexp_matches(canal, 'MOB|BUIL') AS contiene,
  CASE compania WHEN '01' THEN 'uno' ELSE compania END AS reemplazado,
  CAST(recibo AS BIGINT) AS entero, CAST(cdsubgarantia AS DOUBLE) AS real,
  CAST(CAST({_A} AS VARCHAR) AS DATE) AS fecha,
  CASE WHEN valor_prima_emitida > 0 THEN 1 ELSE 0 END AS marca
FROM recibos""",
)
def scalar_strings_casts(t: Inputs) -> DataFrame:
    return t["recibos"].select(
        *KEYS,
        F.concat(F.lit("matematica_local_"), "tipo_insumo").alias("unido"),
        F.upper("canal").alias("mayusculas"),
        F.col("producto").endswith("1").alias("termina"),
        F.col("canal").rlike("MOB|BUIL").alias("contiene"),
        replace_values("compania", {"01": "uno"}).alias("reemplazado"),
        F.col("recibo").cast("long").alias("entero"),
        F.col("cdsubgarantia").cast("double").alias("real"),
        F.col(_A).cast("string").cast("date").alias("fecha"),
        (F.col("valor_prima_emitida") > 0).cast("int").alias("marca"),
    )
