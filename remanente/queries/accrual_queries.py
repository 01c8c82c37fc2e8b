"""Queries of section 2.9: accrual rules, exchange rates, impairment, curves, unpivot, the close."""

from __future__ import annotations

import re
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from remanente.functions.schema import ensure_columns, union_aligned
from remanente.operators import accounting, accrual, curves, fx, prep
from remanente.plans import chain, close
from remanente.queries import stages as s
from remanente.queries.inputs import CFG, CFG_CODED, FV, SQL, Inputs
from remanente.queries.lookup_queries import (
    ceded_impaired,
    premium_accrued,
    premium_valued,
)
from remanente.queries.prepare import contract_cost, direct_premium, factors, params, with_financing
from remanente.queries.registry import KEYS, n, query, r, shown, total
from remanente.session import shared_folder
from remanente.sources.publication import Staged, read_published
from remanente.sources.schemas import OPEN_TABLES, SCHEMAS
from remanente.sources.tables import read_catalogue

_ROW = [*KEYS, "tipo_contabilidad"]
_AMOUNTS = ["valor_constitucion", "valor_liberacion", "valor_liberacion_acum", "saldo"]
_SIGNED = [*_AMOUNTS, "saldo_anterior"]
_TAGS = ["cohorte", "anio_liberacion", "transicion"]


def _rows(source: str, plain: list[str], amounts: list[str], digits: int = 4, where="") -> str:
    rounded = ", ".join(f"{s.r(a, digits)} AS {a}" for a in amounts)
    return f"SELECT {', '.join(plain)}, {rounded} FROM {source} {where}"


def _groups(keys: list[str], amounts: dict[str, int]) -> str:
    sums = ", ".join(f"{s.total(a, d)} AS {a}" for a, d in amounts.items())
    return f"SELECT {', '.join(keys)}, COUNT(*) AS filas, {sums}"


def grouped(df: DataFrame, keys: list[str], amounts: dict[str, int]) -> DataFrame:
    return df.groupBy(*keys).agg(
        n().alias("filas"), *[total(a, d).alias(a) for a, d in amounts.items()]
    )


# --- the smallest full slice ---------------------------------------------------------------------

_SLICE = dict.fromkeys(["valor_constitucion", "valor_liberacion", "saldo"], 4)


@query(
    "corte_minimo",
    _groups(["ramo_sura", "tipo_contabilidad", "estado_devengo"], _SLICE)
    + " FROM dev_prima GROUP BY 1, 2, 3",
)
def corte_minimo(t: Inputs) -> DataFrame:
    return grouped(
        premium_accrued(t), ["ramo_sura", "tipo_contabilidad", "estado_devengo"], _SLICE
    )


# --- rules -------------------------------------------------------------------------------------------


def mixed_inputs(t: Inputs) -> DataFrame:
    """Inputs that take all five rules."""
    p, rules = params(t), t["excepciones_50_50"]
    financed, others = prep.split_financed_line(direct_premium(t), CFG)
    return union_aligned(
        [
            others,
            with_financing(t, financed),
            prep.investment_component(t["componente_inversion"], p, CFG),
            prep.onerous_contracts(t["onerosidad"], p, CFG),
            prep.ceded_premium(t["cesion_rea"], p, rules, CFG),
            contract_cost(t, False),
        ]
    )


_CLASS = """
SELECT tipo_insumo, tipo_contabilidad, ramo_sura, regla_devengo, ruta, COUNT(*) AS filas
FROM ({parts}) GROUP BY ALL"""
_ROUTES = {"dia": "DIA", "5050": "5050", "lim": "LIM", "inv": "INV", "fin": "FIN"}


def _class_sql(name: str, routes: list[str]) -> str:
    parts = " UNION ALL BY NAME ".join(
        f"SELECT *, '{_ROUTES[x]}' AS ruta FROM {name}_c_{x}" for x in routes
    )
    return _CLASS.format(parts=parts)


def _classified(prepared: DataFrame, cfg) -> DataFrame:
    ready = ensure_columns(prepared, accrual.OPTIONAL_INPUT)
    routed = accrual.route_rows(
        accrual.with_rule_and_routes(accrual.with_period(ready, cfg), cfg)
    )
    return routed.groupBy(
        "tipo_insumo", "tipo_contabilidad", "ramo_sura", "regla_devengo",
        F.col("_ruta").alias("ruta"),
    ).agg(n().alias("filas"))


@query("devengo_clasificar", _class_sql("dev_mix", list(_ROUTES)))
def devengo_clasificar(t: Inputs) -> DataFrame:
    return _classified(mixed_inputs(t), CFG)


@query("devengo_clasificar__codigo", _class_sql("dev_oner_coded", ["dia", "5050"]))
def devengo_clasificar_as_coded(t: Inputs) -> DataFrame:
    return _classified(prep.onerous_contracts(t["onerosidad"], params(t), CFG), CFG_CODED)


_DAILY = [*_ROW, "estado_devengo", "dias_constitucion", "dias_devengados", "dias_no_devengados",
          "dias_liberacion", "control_suma_dias"]
_DAILY_V = ["valor_devengo_diario", *_AMOUNTS]
for _name, _coded in (("todo_diario", False), ("todo_diario_coded", True)):
    s.ALL[_name] = s.daily_sql("prima_directo", _coded)


@query("devengo_diario", _rows("todo_diario", _DAILY, _DAILY_V))
def devengo_diario(t: Inputs) -> DataFrame:
    dated = accrual.with_period(direct_premium(t), CFG)
    return shown(accrual.daily_rule(dated, CFG), _DAILY, _DAILY_V)


@query("devengo_diario__codigo", _rows("todo_diario_coded", _DAILY, _DAILY_V))
def devengo_diario_as_coded(t: Inputs) -> DataFrame:
    dated = accrual.with_period(direct_premium(t), CFG_CODED)
    return shown(accrual.daily_rule(dated, CFG_CODED), _DAILY, _DAILY_V)


_HALVES = [*_ROW, "estado_devengo", "mes_constitucion", "mes_ini_liberacion", "mes_fin_liberacion"]
s.ALL["todo_5050"] = s.halves_sql("prima_directo")


@query("devengo_50_50", _rows("todo_5050", _HALVES, _AMOUNTS))
def devengo_50_50(t: Inputs) -> DataFrame:
    dated = accrual.with_period(direct_premium(t), CFG)
    return shown(accrual.halves_rule(dated), _HALVES, _AMOUNTS)


_LIMIT = ["recibo", "contrato_reaseguro", "tipo_contabilidad", "regla_devengo", "estado_devengo"]
_LIMIT_V = ["porc_consumo_limite", *_SIGNED]


def _limit(t: Inputs, cfg, rolled: bool) -> DataFrame:
    source = t["costo_contrato_roll" if rolled else "costo_contrato_rea"]
    ready = prep.contract_cost(
        source, t["seguimiento_rea"], params(t), t["excepciones_50_50"], cfg
    )
    return shown(accrual.accrue(ready, cfg), _LIMIT, _LIMIT_V)


@query("devengo_limite", _rows("dev_costo_roll", _LIMIT, _LIMIT_V))
def devengo_limite(t: Inputs) -> DataFrame:
    return _limit(t, CFG, True)


@query("devengo_limite__codigo", _rows("dev_costo_roll_coded", _LIMIT, _LIMIT_V))
def devengo_limite_as_coded(t: Inputs) -> DataFrame:
    return _limit(t, CFG_CODED, True)


@query("devengo_limite_inicial", _rows("dev_costo", _LIMIT, _LIMIT_V))
def devengo_limite_inicial(t: Inputs) -> DataFrame:
    return _limit(t, CFG, False)


@query("devengo_comp_inversion", _rows("dev_inv", [*_ROW, "regla_devengo", *_TAGS], _SIGNED))
def devengo_comp_inversion(t: Inputs) -> DataFrame:
    ready = prep.investment_component(t["componente_inversion"], params(t), CFG)
    return shown(accrual.accrue(ready, CFG), [*_ROW, "regla_devengo", *_TAGS], _SIGNED)


_FINANCED = [*_ROW, "estado_devengo", "pais_curva", "moneda_curva"]
_FINANCED_V = ["factor_ajuste_ipc", "factor_cap_real", "suma_factores_remanente",
               "suma_factores_total", "tasa_acreditacion", "valor_constitucion",
               "valor_liberacion", "acreditacion_intereses", "saldo", "saldo_anterior"]


@query(
    "devengo_financiacion",
    _rows("dev_financ", _FINANCED, _FINANCED_V, 5, "WHERE aplica_comp_financ = 1"),
)
def devengo_financiacion(t: Inputs) -> DataFrame:
    financed, _ = prep.split_financed_line(direct_premium(t), CFG)
    out = accrual.accrue(with_financing(t, financed), CFG)
    return shown(out.filter("aplica_comp_financ = 1"), _FINANCED, _FINANCED_V, 5)


_DEV = ["tipo_insumo", "tipo_contabilidad", "ramo_sura", "regla_devengo", "estado_devengo", *_TAGS]
_DEV_V = dict.fromkeys([*_SIGNED, "acreditacion_intereses"], 4)


@query("devengar", _groups(_DEV, _DEV_V) + " FROM dev_mix GROUP BY ALL")
def devengar(t: Inputs) -> DataFrame:
    return grouped(accrual.accrue(mixed_inputs(t), CFG), _DEV, _DEV_V)


@query("devengar__codigo", _rows("dev_prima_coded", [*_ROW, "regla_devengo", *_TAGS], _SIGNED))
def devengar_as_coded(t: Inputs) -> DataFrame:
    ready = prep.direct_premium(t["recibos"], params(t), t["excepciones_50_50"], CFG_CODED)
    return shown(accrual.accrue(ready, CFG_CODED), [*_ROW, "regla_devengo", *_TAGS], _SIGNED)


# --- exchange rates and impairment ------------------------------------------------------------------

_FX = [*_ROW, "moneda"]
_FX_V = ["fluctuacion_constitucion", "fluctuacion_liberacion"]


@query("fluctuacion", _rows("fx_prima", _FX, _FX_V, 4))
def fluctuacion(t: Inputs) -> DataFrame:
    return shown(premium_valued(t), _FX, _FX_V, 4)


@query("fluctuacion__codigo", _rows("fx_prima_coded", _FX, _FX_V, 4))
def fluctuacion_as_coded(t: Inputs) -> DataFrame:
    ready = prep.direct_premium(t["recibos"], params(t), t["excepciones_50_50"], CFG_CODED)
    accrued = accrual.accrue(ready, CFG_CODED)
    return shown(fx.fx_fluctuation(accrued, t["tasa_cambio"], CFG_CODED), _FX, _FX_V, 4)


_DET = [*_ROW, "nit_reasegurador"]
_PD = ["prob_incumplimiento_actual", "prob_incumplimiento_anterior", "cambio_prob_incumplimiento"]
_DET_V = ["constitucion_deterioro", "liberacion_deterioro"]


def _impairment_sql(source: str) -> str:
    risk = ", ".join(f"{s.r(c, 8)} AS {c}" for c in _PD)
    return _rows(source, [*_DET, risk], _DET_V)


def _impairment(df: DataFrame) -> DataFrame:
    return df.select(
        *_DET, *[r(c, 8).alias(c) for c in _PD], *[r(c).alias(c) for c in _DET_V]
    )


@query("deterioro", _impairment_sql("det_rea"))
def deterioro(t: Inputs) -> DataFrame:
    return _impairment(ceded_impaired(t))


@query("deterioro__codigo", _impairment_sql("det_rea_coded"))
def deterioro_as_coded(t: Inputs) -> DataFrame:
    return _impairment(ceded_impaired(t, CFG_CODED))


# --- curves -------------------------------------------------------------------------------------------


@query("curva_ipc", _rows("indice_ipc", ["mesid_ipc"], ["tasa", "indice_ipc"], 9))
def curva_ipc(t: Inputs) -> DataFrame:
    return shown(curves.price_index(t["inflacion"]), ["mesid_ipc"], ["tasa", "indice_ipc"], 9)


_NODE = ["mesid_curva", "fecha_curva", "moneda_curva", "pais_curva", "nodo", "mesid_valoracion",
         "fecha_valoracion"]
_NODE_V = ["tasa_efectiva_anual", "tasa_fwd_real", "factor_acumulacion", "factor_desc_real",
           "sum_desc_real"]


@query("curva_factores", _rows("factores", _NODE, _NODE_V, 9))
def curva_factores(t: Inputs) -> DataFrame:
    return shown(factors(t), _NODE, _NODE_V, 9)


# --- movements, accounting and the whole close ---------------------------------------------------------

_MOVE = [*_ROW, "tipo_movimiento", "anio_liberacion"]


@query(
    "pivotear",
    f"SELECT {', '.join(_MOVE)}, {s.r('valor_md')} AS valor_md, {s.r('valor_ml', 2)} AS valor_ml "
    "FROM mov_rea",
)
def pivotear(t: Inputs) -> DataFrame:
    out = accounting.to_movements(ceded_impaired(t))
    return out.select(*_MOVE, r("valor_md").alias("valor_md"), r("valor_ml", 2).alias("valor_ml"))


_ACC = ["tipo_insumo", "tipo_contabilidad", "ramo_sura", "moneda", "tipo_movimiento",
        "anio_liberacion", "naturaleza", "bt"]
_ACC_V = {"valor_md": 4, "valor_ml": 2}


@query("output_contable", _groups(_ACC, _ACC_V) + " FROM cont_salida GROUP BY ALL")
def output_contable(t: Inputs) -> DataFrame:
    balances = [prep.receivables(t[b], params(t), CFG) for b in ("cartera", "cuenta_corriente")]
    out = accounting.accounting_output(
        premium_valued(t),
        accounting.bt_in_scope(t["relacion_bt"]),
        t["tipo_seguro"],
        t["nomenclatura"],
        balances,
    )
    return grouped(out, _ACC, _ACC_V)


@query(
    "sink_outputs",
    f"""
SELECT 'devengo' AS tabla, fecha_valoracion, ramo_sura, regla_devengo AS clase, COUNT(*) AS filas,
  {s.total("saldo")} AS valor FROM dev_prima GROUP BY 2, 3, 4
UNION ALL
SELECT 'contable', fecha_valoracion, ramo_sura, tipo_movimiento, COUNT(*), {s.total("valor_md")}
FROM cont_prima GROUP BY 2, 3, 4""",
)
def sink_outputs(t: Inputs) -> DataFrame:
    """Both outputs published together and read back; a later run that was lost half-way is not seen."""
    folder = f"{shared_folder(t.spark)}/salidas-{uuid.uuid4().hex}"
    staged = Staged(t.spark, folder, FV)
    accrued = staged.write(close.ACCRUAL, premium_valued(t))
    output = accounting.accounting_output(
        accrued, accounting.bt_in_scope(t["relacion_bt"]), t["tipo_seguro"], t["nomenclatura"]
    )
    staged.write(close.ACCOUNTING, output)
    staged.publish()
    Staged(t.spark, folder, FV).write(close.ACCRUAL, accrued.filter("ramo_sura = '003'"))
    parts = []
    for name, kind, amount in (
        (close.ACCRUAL, "regla_devengo", "saldo"),
        (close.ACCOUNTING, "tipo_movimiento", "valor_md"),
    ):
        table = read_published(t.spark, folder, name, FV)
        grouped_ = table.groupBy("fecha_valoracion", "ramo_sura", F.col(kind).alias("clase"))
        parts.append(
            grouped_.agg(n().alias("filas"), total(amount).alias("valor")).withColumn("tabla", F.lit(name))
        )
    return parts[0].unionByName(parts[1])


# --- a date within the month -------------------------------------------------------------------------

MID_MONTH = date(1998, 5, 14)
_CFG_MID = replace(CFG, fecha_valoracion=MID_MONTH)


def _stages_at(root: str, suffix: str, day: date, given: dict[str, str]) -> None:
    """Copies a stage and all that it reads, valued at another day; ``given`` replaces some of them."""
    before = day.replace(day=1)
    values = {
        s.FV: f"DATE '{day}'",
        s.INI: f"DATE '{before}'",
        s.ANT: f"DATE '{before}' - 1",
        str(s.MES): f"{day:%Y%m}",
    }

    def copy(name: str) -> None:
        if f"{name}{suffix}" in s.ALL:
            return
        dates = "|".join(re.escape(x) for x in values)
        text = re.sub(dates, lambda m: values[m.group()], given.get(name, s.ALL[name]))
        sources = {x for x in re.findall(r"\b(?:FROM|JOIN)\s+(\w+)", text) if x in s.ALL and x not in SQL}
        for source in sources:
            text = re.sub(rf"\b(FROM|JOIN)(\s+){source}\b", rf"\1\2{source}{suffix}", text)
        s.ALL[f"{name}{suffix}"] = text
        for source in sources:
            copy(source)

    copy(root)


_stages_at("dev_mix", "_medio", MID_MONTH, {})


def inputs_at(t: Inputs, cfg) -> list[DataFrame]:
    """Inputs that take all five rules, at the valuation date of ``cfg``."""
    p, rules, finance = params(t), t["excepciones_50_50"], t["componente_financiacion"]
    financed, others = prep.split_financed_line(
        prep.direct_premium(t["recibos"], p, rules, cfg), cfg
    )
    index, curve = curves.price_index(t["inflacion"]), curves.curve_factors(t["curvas"], finance)
    return [
        others,
        prep.with_financing(financed, finance, index, curve, cfg),
        prep.investment_component(t["componente_inversion"], p, cfg),
        prep.onerous_contracts(t["onerosidad"], p, cfg),
        prep.ceded_premium(t["cesion_rea"], p, rules, cfg),
        prep.contract_cost(t["costo_contrato_rea"], t["seguimiento_rea"], p, rules, cfg),
    ]


@query("devengar__medio_mes", _groups(_DEV, _DEV_V) + " FROM dev_mix_medio GROUP BY ALL")
def devengar_mid_month(t: Inputs) -> DataFrame:
    """All five rules at a date that is no month end."""
    return grouped(accrual.accrue(union_aligned(inputs_at(t, _CFG_MID)), _CFG_MID), _DEV, _DEV_V)


# --- a chain of closes -----------------------------------------------------------------------------------

CHAIN = [date(1998, 3, 31), date(1998, 4, 30), FV]
_CHAIN = ["tipo_insumo", "contrato_reaseguro", "nit_reasegurador", "tipo_negocio",
          "tipo_contabilidad", "regla_devengo", "estado_devengo"]
_CHAIN_KEYS = ["tipo_insumo", "tipo_negocio", "compania", "ramo_sura", "contrato_reaseguro",
               "nit_reasegurador", "tipo_contabilidad"]


def _carrying(source: str, keys: list[str], closed: str | None) -> str:
    """Parameters attached, with the balance of the month before, which no row has in the first."""
    if closed is None:
        return f"SELECT *, CAST(NULL AS DOUBLE) AS saldo_anterior FROM ({s.with_params(source)})"
    same = " AND ".join(f"b.{k} IS NOT DISTINCT FROM c.{k}" for k in keys)
    return f"""
SELECT b.*, c.saldo * b.signo_constitucion AS saldo_anterior FROM ({s.with_params(source)}) AS b
LEFT JOIN (SELECT {', '.join(keys)}, SUM(saldo) AS saldo FROM {closed} GROUP BY ALL) AS c ON {same}"""


s.ALL["cadena_insumos"] = "SELECT * FROM costo_roll UNION ALL BY NAME SELECT * FROM recup_np_roll"
s.accrual_stages(
    "dev_cadena",
    "cadena_insumos",
    limited=True,
    reinsurance=True,
    carried="COALESCE(saldo_anterior, valor_base_devengo)",
)
s.ALL.update({k: v for k, v in s.STAGES.items() if k.startswith("dev_cadena")})
for _k, _day in enumerate(CHAIN):
    _closed = f"dev_cadena_m{_k - 1}" if _k else None
    _stages_at(
        "dev_cadena",
        f"_m{_k}",
        _day,
        {
            "costo_roll_fv": s.ALL["costo_fv"],
            "recup_np_roll_fv": s.ALL["recup_np_fv"],
            "costo_roll_param": _carrying("costo_roll_fv", [*_CHAIN_KEYS, "recibo"], _closed),
            "recup_np_roll_param": _carrying("recup_np_roll_fv", [*_CHAIN_KEYS, "poliza"], _closed),
        },
    )

CHAIN_INPUTS = [
    "param_contabilidad", "excepciones_50_50", "produccion_directo", "costo_contrato_rea",
    "seguimiento_rea", "recup_onerosidad", "tasa_cambio", "relacion_bt", "tipo_seguro", "nomenclatura",
]


@query(
    "costo_encadenado",
    " UNION ALL ".join(
        f"SELECT DATE '{day}' AS cierre, * FROM ("
        + _rows(f"dev_cadena_m{k}", _CHAIN, _SIGNED)
        + ")"
        for k, day in enumerate(CHAIN)
    ),
)
def costo_encadenado(t: Inputs) -> DataFrame:
    """Three published closes in a row, each taking contract balances from the one before."""
    folder = f"{shared_folder(t.spark)}/cadena-{uuid.uuid4().hex}"
    tables = t.only(*CHAIN_INPUTS)
    tables["produccion_directo"] = tables["produccion_directo"].filter(F.lit(False))
    chain.run_chain(t.spark, tables, CFG, CHAIN, folder)
    closes = [
        shown(
            read_published(t.spark, folder, close.ACCRUAL, day).withColumn("cierre", F.lit(day)),
            ["cierre", *_CHAIN], _SIGNED,
        )
        for day in CHAIN
    ]
    return closes[0].unionByName(closes[1]).unionByName(closes[2])


CLOSE_INPUTS = [
    "param_contabilidad", "excepciones_50_50", "produccion_directo", "componente_financiacion",
    "inflacion", "curvas", "descuento", "gasto", "componente_inversion", "onerosidad",
    "cesion_rea", "comision_rea", "costo_contrato_rea", "seguimiento_rea", "recup_onerosidad",
    "tasa_cambio", "riesgo_credito", "cartera", "cuenta_corriente", "relacion_bt", "tipo_seguro",
    "nomenclatura", "camara_soat", "costo_contrato_arl", "cartera_arl", "cuenta_corriente_arl",
]
#: Sample inputs under another name than the table of the close.
CLOSE_NAMES = {"produccion_arl": "arl_mensual"}
_CLOSE = [*_ACC, "onerosidad"]
_CLOSE_V = {"valor_md": 4, "valor_ml": 1}

# The close of all inputs, SOAT and workers' compensation included: the stages of the sample close with
# those inputs joined to theirs.
s.ALL["recibos_cierre"] = "SELECT * FROM recibos UNION ALL BY NAME SELECT * FROM arl_mensual"
s.prepared("prima_soat", "soat_fv", s.BOOKED, "valor_prima_emitida")
s.ALL["soat_fv"] = f"SELECT * FROM camara_soat WHERE {s.BOOKED} <= {s.FV}"
s.ALL.update({k: v for k, v in s.STAGES.items() if k.startswith("prima_soat")})
for _name in ("cartera", "cuenta_corriente"):
    s.ALL[f"{_name}_cierre"] = f"SELECT * FROM {_name} UNION ALL BY NAME SELECT * FROM {_name}_arl"
_stages_at(
    "cont_pcr_marca",
    "_cierre",
    FV,
    {
        "recibos_fv": f"SELECT * FROM recibos_cierre WHERE {s.BOOKED} <= {s.FV}",
        "pcr_insumos": s.ALL["pcr_insumos"] + " UNION ALL BY NAME SELECT * FROM prima_soat",
        "costo_fv": "SELECT * FROM (SELECT * FROM costo_contrato_rea UNION ALL BY NAME "
        f"SELECT * FROM costo_contrato_arl) WHERE {s.BOOKED} <= {s.FV}",
        "cartera_param": s.with_params("cartera_cierre"),
        "cuenta_corriente_param": s.with_params("cuenta_corriente_cierre"),
    },
)


def written_catalogue(t: Inputs, names: list[str], folder: str) -> None:
    """The sample inputs as tables of a catalogue, with the columns that their schemas declare."""

    def write(name: str) -> None:
        table = t[CLOSE_NAMES.get(name, name)]
        declared = T._parse_datatype_string(SCHEMAS[name]).names
        others = [c for c in table.columns if c not in declared] if name in OPEN_TABLES else []
        kept = [c for c in declared if c in table.columns]
        table.select(*kept, *others).write.parquet(f"{folder}/{name}")

    for name in names:  # built one after another, as they share parts
        t[CLOSE_NAMES.get(name, name)]
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(write, names))


def close_tables(t: Inputs, folder: str) -> dict[str, DataFrame]:
    """All inputs of a close, written to a catalogue and read from it."""
    names = [*CLOSE_INPUTS, *CLOSE_NAMES]
    written_catalogue(t, names, folder)
    return read_catalogue(t.spark, folder, names)


_WHOLE = _groups(_CLOSE, _CLOSE_V) + " FROM cont_pcr_marca_cierre GROUP BY ALL"


@query("pcr_batch", _WHOLE)
def pcr_batch(t: Inputs) -> DataFrame:
    """The movements of a close of all inputs, read from a catalogue."""
    tables = close_tables(t, f"{shared_folder(t.spark)}/insumos-{uuid.uuid4().hex}")
    out = close.accounting_close(close.accrual_output(tables, CFG), tables, CFG)
    return grouped(out, _CLOSE, _CLOSE_V)


@query("cierre_publicado", _WHOLE)
def cierre_publicado(t: Inputs) -> DataFrame:
    """The whole way of a close: both outputs written in full, published together and read back."""
    folder = f"{shared_folder(t.spark)}/cierre-{uuid.uuid4().hex}"
    close.run_close(t.spark, close_tables(t, f"{folder}/insumos"), CFG, folder)
    return grouped(read_published(t.spark, folder, close.ACCOUNTING, FV), _CLOSE, _CLOSE_V)
