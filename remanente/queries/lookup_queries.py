"""Queries of section 2.3: joins and lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from remanente.operators import accounting, accrual, curves, fx, impairment, lookups, prep
from remanente.queries import stages as s
from remanente.queries.inputs import CFG, CFG_CODED, Inputs
from remanente.queries.prepare import (
    _FACTORS,
    _FIN,
    direct_premium,
    factors,
    params,
    with_financing,
)
from remanente.queries.registry import KEYS, n, query, shown, total
from remanente.vocabulary import ESTANDARES

_PARAM = ["tipo_contabilidad", "componente", "clasificacion_adicional", "tipo_contrato",
          "nivel_detalle", "signo_constitucion"]


s.ALL["todos"] = """
SELECT * REPLACE (CASE WHEN amparo = 'O' THEN 'sin_parametro' ELSE tipo_insumo END AS tipo_insumo)
FROM recibos"""
s.ALL["todos_param"] = s.with_params("todos")


@query("join_param_left", f"SELECT {', '.join([*KEYS, *_PARAM])} FROM todos_param")
def join_param_left(t: Inputs) -> DataFrame:
    """Receipts and balances of an input without parameters keep their row."""
    unknown = t["recibos"].withColumn(
        "tipo_insumo",
        F.when(F.col("amparo") == "O", "sin_parametro").otherwise(F.col("tipo_insumo")),
    )
    return lookups.attach_accounting_params(unknown, params(t)).select(*KEYS, *_PARAM)


s.ALL["gastos_param"] = s.with_params("gasto_directo_tipo", inner=True)


@query(
    "join_param_inner",
    f"SELECT {', '.join(KEYS)}, tipo_insumo, {', '.join(_PARAM)} FROM gastos_param",
)
def join_param_inner(t: Inputs) -> DataFrame:
    receipts = prep.up_to_valuation(t["recibos"], prep.BOOKED, CFG)
    named = lookups.attach_expenses(receipts, t["gasto"]).withColumn(
        "tipo_insumo", prep.expense_input_name(prep.GASTO_A_INSUMO_DIRECTO, CFG)
    )
    return lookups.attach_accounting_params(named, params(t)).select(
        *KEYS, "tipo_insumo", *_PARAM
    )


_DCTO = ["podto_comercial", "podto_tecnico"]
s.ALL["recibos_dcto"] = s.with_discount("recibos", "recibo")
s.ALL["cesion_dcto"] = s.with_discount("cesion_rea", "recibo_rea")
_DSQL = ", ".join(f"{s.r(c)} AS {c}" for c in _DCTO)


@query("join_descuento", f"SELECT {', '.join(KEYS)}, {_DSQL} FROM recibos_dcto")
def join_descuento(t: Inputs) -> DataFrame:
    return shown(lookups.attach_discounts(t["recibos"], t["descuento"]), KEYS, _DCTO)


@query("join_descuento_rea", f"SELECT {', '.join(KEYS)}, {_DSQL} FROM cesion_dcto")
def join_descuento_rea(t: Inputs) -> DataFrame:
    return shown(lookups.attach_discounts(t["cesion_rea"], t["descuento"], True), KEYS, _DCTO)


_GASTO = [*KEYS, "tipo_gasto", "tipo_contabilidad", "prioridad_match", "porc_gasto"]
s.ALL["todos_gasto_cand"] = s.candidates("recibos")
s.ALL["todos_gasto"] = s.best_expense("todos_gasto_cand", "valor_prima_emitida")


@query("join_gastos", f"SELECT {', '.join(_GASTO)} FROM todos_gasto")
def join_gastos(t: Inputs) -> DataFrame:
    return lookups.attach_expenses(t["recibos"], t["gasto"]).select(*_GASTO)


@query(
    "mark_excepciones",
    f"SELECT {', '.join(KEYS)}, tipo_contabilidad, ramo_sura, candidato_devengo_50_50 "
    "FROM dcto_directo_marca",
)
def mark_excepciones(t: Inputs) -> DataFrame:
    receipts = prep.up_to_valuation(t["recibos"], prep.BOOKED, CFG).withColumn(
        "tipo_insumo", F.lit("dcto_directo")
    )
    discounted = lookups.attach_discounts(receipts, t["descuento"])
    ready = lookups.attach_accounting_params(discounted, params(t))
    return lookups.mark_fifty_fifty(ready, t["excepciones_50_50"]).select(
        *KEYS, "tipo_contabilidad", "ramo_sura", "candidato_devengo_50_50"
    )


_RATES = [
    "tasa_cambio_fecha_valoracion_corporativo",
    "tasa_cambio_fecha_valoracion_local",
    "tasa_cambio_fecha_valoracion_anterior_corporativo",
    "tasa_cambio_fecha_valoracion_anterior_local",
    "tasa_cambio_fecha_constitucion",
]
s.ALL["prima_fechada"] = (
    f"SELECT *, {s.FV} AS fecha_valoracion, {s.ANT} AS fecha_valoracion_anterior "
    "FROM prima_directo"
)
s.ALL["prima_tasas"] = s.with_rates("prima_fechada")


@query(
    "join_tasas_cambio",
    f"SELECT {', '.join([*KEYS, 'tipo_contabilidad', 'moneda', 'fecha_constitucion', *_RATES])} "
    "FROM prima_tasas",
)
def join_tasas_cambio(t: Inputs) -> DataFrame:
    dated = accrual.with_period(direct_premium(t), CFG)
    return lookups.attach_fx_rates(dated, t["tasa_cambio"], CFG).select(
        *KEYS, "tipo_contabilidad", "moneda", "fecha_constitucion", *_RATES
    )


@query("join_param_financiacion", f"SELECT {', '.join(_FIN)} FROM prima_financ_finparam")
def join_param_financiacion(t: Inputs) -> DataFrame:
    return lookups.attach_financing_params(
        direct_premium(t), t["componente_financiacion"]
    ).select(*_FIN)


_LIR = ", ".join(f"{s.r(c, 7)} AS {c}" for c in _FACTORS)


@query(
    "join_factores_lir", f"SELECT {', '.join(KEYS)}, tipo_contabilidad, {_LIR} FROM prima_financ"
)
def join_factores_lir(t: Inputs) -> DataFrame:
    out = with_financing(t, direct_premium(t))
    return shown(out, [*KEYS, "tipo_contabilidad"], _FACTORS, 7)


# The legacy matching is meant for one loaded curve month: the one before the close.
_ONE_CURVE = 199804
s.ALL["una_curva"] = f"SELECT * FROM factores WHERE mesid_curva = {_ONE_CURVE}"
s.ALL["una_curva_mapa"] = s.STAGES["curva_mapa"].replace("FROM factores", "FROM una_curva")
s.ALL["prima_una_curva"] = s.STAGES["prima_financ"].replace(
    "JOIN curva_mapa AS", "JOIN una_curva_mapa AS"
)


@query(
    "join_factores_lir__codigo",
    f"SELECT {', '.join(KEYS)}, tipo_contabilidad, {_LIR} FROM prima_una_curva",
)
def join_factores_lir_as_coded(t: Inputs) -> DataFrame:
    one = factors(t).filter(F.col("mesid_curva") == _ONE_CURVE)
    out = prep.with_financing(
        direct_premium(t),
        t["componente_financiacion"],
        curves.price_index(t["inflacion"]),
        one,
        CFG_CODED,
    )
    return shown(out, [*KEYS, "tipo_contabilidad"], _FACTORS, 7)


_PD = ["prob_incumplimiento_actual", "prob_incumplimiento_anterior"]
s.ALL["rea_fechada"] = (
    f"SELECT *, {s.FV} AS fecha_valoracion, {s.ANT} AS fecha_valoracion_anterior FROM prima_rea"
)
s.impairment_stages("x_riesgo", "rea_fechada")
s.ALL["riesgo_pd"] = s.STAGES["x_riesgo_pd"]


@query(
    "join_riesgo_credito",
    f"SELECT {', '.join(KEYS)}, tipo_contabilidad, nit_reasegurador, "
    f"{', '.join(s.r(c, 9) + ' AS ' + c for c in _PD)} FROM riesgo_pd",
)
def join_riesgo_credito(t: Inputs) -> DataFrame:
    ready = prep.ceded_premium(t["cesion_rea"], params(t), t["excepciones_50_50"], CFG)
    out = impairment.attach_credit_risk(accrual.with_period(ready, CFG), t["riesgo_credito"], CFG)
    return shown(out, [*KEYS, "tipo_contabilidad", "nit_reasegurador"], _PD, 9)


@query(
    "join_curve_nodes",
    f"SELECT fecha_clave, pais, moneda, mes, nodos_requeridos, {s.r('tasa_interes')} "
    "AS tasa_interes FROM curvas_nodos",
)
def join_curve_nodes(t: Inputs) -> DataFrame:
    nodes = curves.needed_curve_nodes(t["curvas"], t["componente_financiacion"])
    return shown(nodes, ["fecha_clave", "pais", "moneda", "mes", "nodos_requeridos"],
                 ["tasa_interes"])


_POL = ["poliza", "compania", "ramo_sura", "recibo", "tipo_negocio", "contrato_reaseguro",
        "tipo_reasegurador", "fe_ini_vig_contrato_reaseguro"]


@query(
    "join_polizas_rea",
    f"SELECT {', '.join(_POL)}, {s.r('porc_cesion')} AS porc_cesion FROM recup_pp_base",
)
def join_polizas_rea(t: Inputs) -> DataFrame:
    onerosity = prep.up_to_valuation(t["onerosidad"], "fecha_operacion", CFG)
    return shown(prep.join_ceded_policies(onerosity, t["cesion_rea"]), _POL, ["porc_cesion"])


@query(
    "join_tipo_seguro",
    f"SELECT {', '.join('b.' + k for k in KEYS)}, b.ramo_sura, s.tipo_seguro_codigo "
    "FROM recibos AS b LEFT JOIN tipo_seguro AS s ON b.ramo_sura = s.ramo",
)
def join_tipo_seguro(t: Inputs) -> DataFrame:
    return accounting.attach_insurance_type(t["recibos"], t["tipo_seguro"]).select(
        *KEYS, "ramo_sura", "tipo_seguro_codigo"
    )


def premium_accrued(t: Inputs) -> DataFrame:
    return accrual.accrue(direct_premium(t), CFG)


def premium_valued(t: Inputs) -> DataFrame:
    return fx.fx_fluctuation(premium_accrued(t), t["tasa_cambio"], CFG)


def ceded_accrued(t: Inputs, cfg=CFG) -> DataFrame:
    ready = prep.ceded_premium(t["cesion_rea"], params(t), t["excepciones_50_50"], cfg)
    return accrual.accrue(ready, cfg)


def ceded_valued(t: Inputs, cfg=CFG) -> DataFrame:
    return fx.fx_fluctuation(ceded_accrued(t, cfg), t["tasa_cambio"], cfg)


def ceded_impaired(t: Inputs, cfg=CFG) -> DataFrame:
    return impairment.credit_impairment(ceded_valued(t, cfg), t["riesgo_credito"], cfg)


def ceded_movements(t: Inputs) -> DataFrame:
    return accounting.to_movements(ceded_impaired(t))


CODES = [f"{c}_codigo" for c in accounting.CAMPOS_HOMOLOGADOS]


@query(
    "homologar_campos",
    f"SELECT {', '.join(KEYS)}, tipo_movimiento, tipo_reserva, {', '.join(CODES)} "
    "FROM cont_rea_cod",
)
def homologar_campos(t: Inputs) -> DataFrame:
    return accounting.map_codes(ceded_movements(t), t["nomenclatura"]).select(
        *KEYS, "tipo_movimiento", "tipo_reserva", *CODES
    )


@query(
    "obtener_homologacion",
    """
SELECT b.compania, k.codigo AS compania_codigo, COUNT(*) AS recibos FROM recibos AS b
LEFT JOIN nomenclatura AS k ON k.campo = 'compania' AND b.compania = k.prototipo GROUP BY 1, 2""",
)
def obtener_homologacion(t: Inputs) -> DataFrame:
    codes = accounting.code_table(t["nomenclatura"], "compania", "compania")
    return t["recibos"].join(codes, "compania", "left").groupBy(
        "compania", "compania_codigo"
    ).agg(n().alias("recibos"))


@query(
    "cruzar_bt",
    f"SELECT {', '.join(KEYS)}, tipo_contabilidad, tipo_movimiento, tipo_seguro_codigo, "
    "naturaleza, bt, descripcion_bt FROM cont_rea",
)
def cruzar_bt(t: Inputs) -> DataFrame:
    coded = accounting.attach_insurance_type(
        accounting.map_codes(ceded_movements(t), t["nomenclatura"]), t["tipo_seguro"]
    )
    scope = accounting.bt_in_scope(t["relacion_bt"])
    return accounting.attach_bt(coded, scope).select(
        *KEYS, "tipo_contabilidad", "tipo_movimiento", "tipo_seguro_codigo", "naturaleza", "bt",
        "descripcion_bt",
    )


s.ALL["recibos_onerosos"] = s.with_onerous("recibos")


@query(
    "marca_onerosidad",
    f"SELECT {', '.join(KEYS)}, compania, ramo_sura, poliza, onerosidad FROM recibos_onerosos",
)
def marca_onerosidad(t: Inputs) -> DataFrame:
    return accounting.mark_onerous(t["recibos"], t["onerosidad"], CFG).select(
        *KEYS, "compania", "ramo_sura", "poliza", "onerosidad"
    )


@query(
    "join_cross",
    f"""
SELECT k.tipo_contabilidad, b.ramo_sura, b.moneda, COUNT(*) AS filas,
  {s.total("valor_prima_emitida")} AS prima
FROM recibos AS b CROSS JOIN
  (VALUES ('ifrs4_local'), ('ifrs17_local'), ('ifrs17_corporativo')) AS k(tipo_contabilidad)
GROUP BY 1, 2, 3""",
)
def join_cross(t: Inputs) -> DataFrame:
    """Every receipt under each of the three standards."""
    standards = F.array(*[F.lit(e) for e in ESTANDARES])
    spread = t["recibos"].withColumn("tipo_contabilidad", F.explode(standards))
    return spread.groupBy("tipo_contabilidad", "ramo_sura", "moneda").agg(
        n().alias("filas"), total("valor_prima_emitida").alias("prima")
    )
