"""Queries of section 2.1 and 2.2: sources, sinks and input preparation."""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from remanente.functions.schema import union_aligned
from remanente.operators import accounting, curves, lookups, prep
from remanente.queries import stages as s
from remanente.queries.inputs import CFG, Inputs
from remanente.queries.registry import KEYS, n, query, shown, total
from remanente.session import shared_folder
from remanente.sources import tables
from remanente.sources.schemas import SCHEMAS

_TERMS = ["fecha_constitucion", "fecha_inicio_vigencia", "fecha_inicio_devengo", "fecha_fin_devengo"]
_FIELDS = ["tipo_insumo", "tipo_contabilidad", "nivel_detalle", "signo_constitucion"]
_FLAG = "candidato_devengo_50_50"


def _select(source: str, columns: list[str], amounts: list[str], where: str = "") -> str:
    rounded = ", ".join(f"{s.r(a)} AS {a}" for a in amounts)
    return f"SELECT {', '.join(columns)}, {rounded} FROM {source} {where}"


def params(t: Inputs) -> DataFrame:
    return lookups.active_parameters(t["param_contabilidad"])


def direct_premium(t: Inputs) -> DataFrame:
    return prep.direct_premium(t["recibos"], params(t), t["excepciones_50_50"], CFG)


_STD = [*KEYS, *_FIELDS, _FLAG, *_TERMS]


@query("prep_prima_directo", _select("prima_directo", _STD, ["valor_base_devengo"]))
def prep_prima_directo(t: Inputs) -> DataFrame:
    return shown(direct_premium(t), _STD, ["valor_base_devengo"])


@query("prep_dcto_directo", _select("dcto_directo", _STD, ["valor_base_devengo"]))
def prep_dcto_directo(t: Inputs) -> DataFrame:
    out = prep.direct_discount(
        t["recibos"], params(t), t["excepciones_50_50"], t["descuento"], CFG
    )
    return shown(out, _STD, ["valor_base_devengo"])


@query("prep_gasto_directo", _select("gasto_directo", [*_STD, "tipo_gasto"], ["valor_base_devengo"]))
def prep_gasto_directo(t: Inputs) -> DataFrame:
    out = prep.direct_expense(t["recibos"], params(t), t["excepciones_50_50"], t["gasto"], CFG)
    return shown(out, [*_STD, "tipo_gasto"], ["valor_base_devengo"])


_REA = [*_STD, "tipo_negocio", "nit_reasegurador"]


@query("prep_prima_rea", _select("prima_rea", _REA, ["valor_base_devengo"]))
def prep_prima_rea(t: Inputs) -> DataFrame:
    out = prep.ceded_premium(t["cesion_rea"], params(t), t["excepciones_50_50"], CFG)
    return shown(out, _REA, ["valor_base_devengo"])


@query("prep_dcto_rea", _select("dcto_rea", _REA, ["valor_base_devengo"]))
def prep_dcto_rea(t: Inputs) -> DataFrame:
    out = prep.ceded_discount(
        t["cesion_rea"], params(t), t["excepciones_50_50"], t["descuento"], CFG
    )
    return shown(out, _REA, ["valor_base_devengo"])


@query("prep_gasto_rea", _select("gasto_rea", [*_REA, "tipo_gasto"], ["valor_base_devengo"]))
def prep_gasto_rea(t: Inputs) -> DataFrame:
    out = prep.ceded_expense(t["cesion_rea"], params(t), t["excepciones_50_50"], t["gasto"], CFG)
    return shown(out, [*_REA, "tipo_gasto"], ["valor_base_devengo"])


@query("prep_comi_rea", _select("comi_rea", _REA, ["valor_base_devengo"]))
def prep_comi_rea(t: Inputs) -> DataFrame:
    out = prep.ceded_commission(t["comision_rea"], params(t), t["excepciones_50_50"], CFG)
    return shown(out, _REA, ["valor_base_devengo"])


_ONER = ["recibo", "poliza", *_FIELDS, *_TERMS]


@query("prep_onerosidad", _select("oner", _ONER, ["valor_base_devengo"]))
def prep_onerosidad(t: Inputs) -> DataFrame:
    return shown(
        prep.onerous_contracts(t["onerosidad"], params(t), CFG), _ONER, ["valor_base_devengo"]
    )


_RECUP = [*_ONER, "contrato_reaseguro", "tipo_negocio", _FLAG]


@query("prep_recup_onerosidad_pp", _select("recup_pp", _RECUP, ["valor_base_devengo"]))
def prep_recup_onerosidad_pp(t: Inputs) -> DataFrame:
    out = prep.proportional_recovery(
        t["onerosidad"], t["cesion_rea"], params(t), t["excepciones_50_50"], CFG
    )
    return shown(out, _RECUP, ["valor_base_devengo"])


_TRACK = [
    "limite_agregado_valor_instalado",
    "valor_siniestros_incurridos_mes",
    "valor_salvamentos_mes",
    "limite_agregado_casos_instalado",
    "casos_incurridos_mes",
]


STAGES_SEG = s.with_tracking("costo_contrato_rea")
s.ALL["costo_seguimiento"] = STAGES_SEG


@query("join_costo_seguim", _select("costo_seguimiento", ["recibo", "contrato_reaseguro"], _TRACK))
def join_costo_seguim(t: Inputs) -> DataFrame:
    out = lookups.attach_contract_tracking(t["costo_contrato_rea"], t["seguimiento_rea"], CFG)
    return shown(out, ["recibo", "contrato_reaseguro"], _TRACK)


def contract_cost(t: Inputs, rolled: bool) -> DataFrame:
    source = t["costo_contrato_roll" if rolled else "costo_contrato_rea"]
    return prep.contract_cost(
        source, t["seguimiento_rea"], params(t), t["excepciones_50_50"], CFG
    )


_COST = ["recibo", "contrato_reaseguro", *_FIELDS, _FLAG, *_TERMS]
_COST_V = ["valor_base_devengo", "valor_siniestros_incurridos_mes"]


@query("prep_costo_con_inicial", _select("costo", _COST, _COST_V))
def prep_costo_con_inicial(t: Inputs) -> DataFrame:
    return shown(contract_cost(t, False), _COST, _COST_V)


@query("prep_costo_con_roll", _select("costo_roll", _COST, _COST_V))
def prep_costo_con_roll(t: Inputs) -> DataFrame:
    return shown(contract_cost(t, True), _COST, _COST_V)


_NP = ["poliza", "contrato_reaseguro", "tipo_negocio", *_FIELDS, _FLAG, *_TERMS]


def _np_recovery(t: Inputs, source: str) -> DataFrame:
    out = prep.nonproportional_recovery(
        t[source], t["seguimiento_rea"], params(t), t["excepciones_50_50"], CFG
    )
    return shown(out, _NP, _COST_V)


@query("prep_recup_onerosidad_np_inicial", _select("recup_np", _NP, _COST_V))
def prep_recup_onerosidad_np_inicial(t: Inputs) -> DataFrame:
    return _np_recovery(t, "recup_onerosidad")


@query("prep_recup_onerosidad_np_roll", _select("recup_np_roll", _NP, _COST_V))
def prep_recup_onerosidad_np_roll(t: Inputs) -> DataFrame:
    return _np_recovery(t, "recup_onerosidad_roll")


_INV = [*KEYS, "poliza", "tipo_contabilidad", "signo_constitucion", "fecha_constitucion",
        "fecha_inicio_devengo", "fecha_fin_devengo"]


@query("prep_componente_inversion", _select("inversion", _INV, ["valor_base_devengo"]))
def prep_componente_inversion(t: Inputs) -> DataFrame:
    out = prep.investment_component(t["componente_inversion"], params(t), CFG)
    return shown(out, _INV, ["valor_base_devengo"])


_BAL = ["recibo", "tipo_contabilidad", "fecha_corte", "fecha_valoracion", "fecha_inicio_periodo",
        "anio_liberacion", "regla_devengo", "cohorte", "transicion"]


@query("prep_cartera", _select("cartera_prep", _BAL, ["valor_md", "valor_ml"]))
def prep_cartera(t: Inputs) -> DataFrame:
    return shown(prep.receivables(t["cartera"], params(t), CFG), _BAL, ["valor_md", "valor_ml"])


_ARL = [*KEYS, "mes_cotizacion", "fecha_expedicion_poliza", "fecha_inicio_vigencia_recibo",
        "fecha_fin_vigencia_recibo", "fecha_inicio_vigencia_cobertura",
        "fecha_fin_vigencia_cobertura"]


@query(
    "prep_produccion_arl",
    f"""
SELECT {', '.join(KEYS)}, mes_cotizacion, x_ini AS fecha_expedicion_poliza,
  x_ini AS fecha_inicio_vigencia_recibo, last_day(mes_cotizacion) AS fecha_fin_vigencia_recibo,
  x_ini AS fecha_inicio_vigencia_cobertura,
  last_day(mes_cotizacion) AS fecha_fin_vigencia_cobertura
FROM (SELECT *, CAST(date_trunc('month', mes_cotizacion) AS DATE) AS x_ini FROM produccion_arl)""",
)
def prep_produccion_arl(t: Inputs) -> DataFrame:
    return prep.workers_comp_receipts(t["produccion_arl"]).select(*_ARL)


@query(
    "prep_cartera_arl",
    """
SELECT tipo_insumo, recibo, fecha_corte, fecha_expedicion_poliza, mes_cotizacion, valor_ml
FROM (SELECT *, CAST(NULL AS DATE) AS mes_cotizacion FROM cartera
  UNION ALL BY NAME
  SELECT * EXCLUDE (fecha_expedicion_poliza), fecha_corte AS mes_cotizacion,
    CAST(date_trunc('month', fecha_corte) AS DATE) AS fecha_expedicion_poliza
  FROM cuenta_corriente)""",
)
def prep_cartera_arl(t: Inputs) -> DataFrame:
    other = (
        t["cuenta_corriente"]
        .withColumn("mes_cotizacion", F.col("fecha_corte"))
        .drop("fecha_expedicion_poliza")
    )
    both = union_aligned([t["cartera"], prep.workers_comp_balances(other)])
    return both.select(
        "tipo_insumo", "recibo", "fecha_corte", "fecha_expedicion_poliza", "mes_cotizacion",
        "valor_ml",
    )


def factors(t: Inputs) -> DataFrame:
    return curves.curve_factors(t["curvas"], t["componente_financiacion"])


def with_financing(t: Inputs, prepared: DataFrame) -> DataFrame:
    return prep.with_financing(
        prepared, t["componente_financiacion"], curves.price_index(t["inflacion"]), factors(t), CFG
    )


_MONTHS = [
    "mes_inicio_vigencia", "mes_fin_vigencia", "mes_valoracion", "mes_valoracion_anterior",
    "dias_vig_ini", "dias_nodo_ini", "dias_vig_fin", "dias_nodo_fin",
]
_FACTORS = [
    "indice_ipc_ini", "tasa_ipc_ini", "indice_ipc_actual", "tasa_ipc_actual",
    "indice_ipc_anterior", "tasa_ipc_anterior", "fact_acum_val", "sum_desc_lir_val",
    "tasa_fwd_real_val", "fact_acum_ant", "sum_desc_lir_ant", "tasa_fwd_real_ant",
    "desc_lir_nodo_ini", "fact_acum_ini", "sum_desc_lir_nodo_fin", "desc_lir_nodo_fin",
]
_FIN = [*KEYS, "tipo_contabilidad", "aplica_comp_financ", "aplica_ipc_mensual", "pais_curva",
        "moneda_curva", "meses_max_vigencia"]


@query("anexar_financiacion", _select("prima_financ", [*_FIN, *_MONTHS], ["sum_desc_lir_val"]))
def anexar_financiacion(t: Inputs) -> DataFrame:
    return shown(with_financing(t, direct_premium(t)), [*_FIN, *_MONTHS], ["sum_desc_lir_val"])


@query(
    "prep_split_financed_line",
    f"""
SELECT ramo_sura, tipo_contabilidad, aplica_comp_financ, COUNT(*) AS filas,
  {s.total("valor_base_devengo")} AS base
FROM (SELECT * FROM prima_resto UNION ALL BY NAME SELECT * FROM prima_003_financ)
GROUP BY 1, 2, 3""",
)
def prep_split_financed_line(t: Inputs) -> DataFrame:
    financed, others = prep.split_financed_line(direct_premium(t), CFG)
    both = union_aligned([others, with_financing(t, financed)])
    return both.groupBy("ramo_sura", "tipo_contabilidad", "aplica_comp_financ").agg(
        n().alias("filas"), total("valor_base_devengo").alias("base")
    )


# --- sources and sinks ------------------------------------------------------------------------------

# This domain's column -> receipts-system column.
_RAW = {ours: raw for raw, ours in tables.RAW_RECEIPT_NAMES.items()}


def raw_receipts(t: Inputs) -> DataFrame:
    """Receipts as the operational system stores them."""
    df = t["recibos"].withColumns(
        {
            "sociedad": F.when(F.col("compania") == "01", "1000")
            .when(F.col("cdsubgarantia") == "7", "9000")
            .otherwise("2000"),
            "podescuento_tecnico": F.lit(0.01),
            "podescuento_comercial": F.when(F.col("tipo_op") == "23", 0.05).otherwise(0.0),
        }
    )
    names = {c: _RAW[c] for c in df.columns if c in _RAW}
    return df.drop("compania").withColumnsRenamed(names)


_COMPANY = (
    "CASE WHEN compania = '01' THEN '01' WHEN cdsubgarantia = '7' THEN '9000' ELSE '02' END"
)


@query(
    "src_parquet_scan",
    f"""
SELECT tipo_insumo, tipo_negocio, poliza, fecha_expedicion_poliza, recibo, amparo, cdsubgarantia,
  poliza_certificado, numero_documento_sap, ramo_sura, canal, producto, tipo_op, moneda,
  fecha_contabilizacion_recibo, fecha_inicio_vigencia_recibo, fecha_fin_vigencia_recibo,
  fecha_inicio_vigencia_cobertura, fecha_fin_vigencia_cobertura, valor_prima_emitida,
  {_COMPANY} AS compania FROM recibos""",
)
def src_parquet_scan(t: Inputs) -> DataFrame:
    return tables.receipts_from_raw(raw_receipts(t))


@query(
    "src_discount_scan",
    f"""
SELECT ramo_sura, poliza, recibo, amparo, cdsubgarantia, poliza_certificado,
  numero_documento_sap, canal, producto, tipo_op, CAST(0.01 AS DOUBLE) AS podto_tecnico,
  CASE WHEN tipo_op = '23' THEN CAST(0.05 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END
    AS podto_comercial,
  {_COMPANY} AS compania, CAST(NULL AS VARCHAR) AS recibo_rea,
  CAST(0 AS DOUBLE) AS podto_tecnico_rea, CAST(0 AS DOUBLE) AS podto_comercial_rea
FROM recibos""",
)
def src_discount_scan(t: Inputs) -> DataFrame:
    return tables.discounts_from_raw(raw_receipts(t))


# Whole days, days with a half, and receipts kept as numbers: three files that no one schema reads.
_ENGINE_FILES = {
    "entera": (
        "linea <= 2",
        ["poliza", "recibo", "CAST(linea AS INT) AS dias_devengados", "ramo_sura"],
    ),
    "media": (
        "linea IN (3, 4)",
        ["poliza", "recibo", "CAST(linea AS DOUBLE) + CAST(0.5 AS DOUBLE) AS dias_devengados",
         "ramo_sura", "CAST(proveedor AS INT) AS lote"],
    ),
    "numero": (
        "linea > 4",
        ["poliza", "CAST(recibo AS BIGINT) AS recibo", "CAST(linea AS BIGINT) AS dias_devengados",
         "ramo_sura", "CAST(proveedor AS BIGINT) AS lote", "'n' AS nota"],
    ),
}
_ENGINE_ROWS = """
SELECT 'P' || CAST(l_suppkey AS {text}) AS poliza, CAST(l_orderkey AS {text}) AS recibo,
  l_linenumber AS linea, l_suppkey AS proveedor,
  CASE l_linestatus WHEN 'O' THEN '040' ELSE '083' END AS ramo_sura FROM {source}"""
s.ALL["motor_filas"] = _ENGINE_ROWS.format(text="VARCHAR", source="lineitem")


@query(
    "src_parquet_glob",
    """
SELECT poliza, recibo, CAST(linea AS DOUBLE) + CASE WHEN linea IN (3, 4) THEN CAST(0.5 AS DOUBLE)
    ELSE CAST(0 AS DOUBLE) END AS dias_devengados, COUNT(*) AS filas,
  CAST(SUM(CASE WHEN linea > 2 THEN proveedor END) AS BIGINT) AS lotes,
  CAST(SUM(CASE WHEN linea > 4 THEN 1 ELSE 0 END) AS BIGINT) AS notas
FROM motor_filas
WHERE ramo_sura = '040' AND poliza IN (SELECT poliza FROM cartera)
  AND recibo IN (SELECT recibo FROM cartera)
GROUP BY 1, 2, 3""",
)
def src_parquet_glob(t: Inputs) -> DataFrame:
    """One line of the other engine's files, written in three schemas, for a batch of receipts."""
    folder = f"{shared_folder(t.spark)}/motor-{uuid.uuid4().hex}"
    lines = t.spark.sql(
        _ENGINE_ROWS.format(text="STRING", source="{lines}"),
        lines=t.spark.read.parquet(f"{t.sf}/lineitem.parquet"),
    )
    for name, (condition, columns) in _ENGINE_FILES.items():
        lines.filter(condition).selectExpr(*columns).write.parquet(f"{folder}/{name}")
    rows = tables.read_engine_output(t.spark, f"{folder}/*", t["cartera"], "040")
    return rows.groupBy("poliza", "recibo", "dias_devengados").agg(
        n().alias("filas"), F.sum("lote").alias("lotes"), F.count("nota").alias("notas")
    )


@query(
    "src_param_active",
    """
SELECT b.tipo_insumo, p.tipo_contabilidad, p.clasificacion_adicional, COUNT(*) AS recibos
FROM recibos AS b JOIN param_activo AS p ON b.tipo_insumo = p.tipo_insumo
  AND b.tipo_negocio = p.tipo_negocio GROUP BY 1, 2, 3""",
)
def src_param_active(t: Inputs) -> DataFrame:
    reached = t["recibos"].join(params(t), ["tipo_insumo", "tipo_negocio"])
    return reached.groupBy("tipo_insumo", "tipo_contabilidad", "clasificacion_adicional").agg(
        n().alias("recibos")
    )


@query(
    "src_bt_scope",
    """
SELECT g.tipo_insumo, k.codigo AS clasificacion_adicional, a.clase IS NOT NULL AS en_alcance,
  COUNT(*) AS filas
FROM gasto_directo AS g
LEFT JOIN nomenclatura AS k ON k.campo = 'clasificacion_adicional'
  AND g.clasificacion_adicional = k.prototipo
LEFT JOIN (SELECT DISTINCT clasificacion_adicional AS clase FROM bt_alcance) AS a
  ON k.codigo = a.clase GROUP BY 1, 2, 3""",
)
def src_bt_scope(t: Inputs) -> DataFrame:
    """Direct expense rows by class, and whether any business transaction in scope serves it."""
    expense = prep.direct_expense(t["recibos"], params(t), t["excepciones_50_50"], t["gasto"], CFG)
    codes = accounting.code_table(
        t["nomenclatura"], "clasificacion_adicional", "clasificacion_adicional"
    )
    classes = accounting.bt_in_scope(t["relacion_bt"]).select(
        F.col("clasificacion_adicional").alias("clase")
    ).distinct()
    coded = expense.join(codes, "clasificacion_adicional", "left").join(
        classes, F.col("clasificacion_adicional_codigo") == F.col("clase"), "left"
    )
    return coded.groupBy(
        "tipo_insumo",
        F.col("clasificacion_adicional_codigo").alias("clasificacion_adicional"),
        F.col("clase").isNotNull().alias("en_alcance"),
    ).agg(n().alias("filas"))


# Every declared table, and the sample that fills it.
_CATALOGUE = {name: {"produccion_directo": "recibos"}.get(name, name) for name in SCHEMAS}


#: Of tables whose sample lacks the first column that is not text, the one to break.
_BROKEN = {"gasto": "fecha_inicio", "produccion_arl": "fecha_contabilizacion_recibo"}


def _first_typed(name: str) -> str | None:
    """The first column of a table that is not text."""
    if name in _BROKEN:
        return _BROKEN[name]
    fields = (field.split() for field in SCHEMAS[name].split(","))  # no session is needed for this
    return next((column for column, kind in fields if kind != "string"), None)


def write_text(texts: DataFrame, path: str) -> None:
    """A table as text, compressed: all its columns repeat their codes."""
    texts.write.option("header", "true").option("compression", "gzip").csv(path)


@query(
    "src_parameters",
    " UNION ALL ".join(
        f"SELECT '{name}' AS tabla, COUNT(*) AS aceptadas, CAST({1 if column else 0} AS BIGINT) AS "
        f"rechazadas, {f"'{column}: no es'" if column else 'CAST(NULL AS VARCHAR)'} AS motivo "
        f"FROM {source}"
        for name, source in _CATALOGUE.items()
        for column in [_first_typed(name)]
    ),
)
def src_parameters(t: Inputs) -> DataFrame:
    """Every table of the catalogue, written as text with one row that does not fit, and read back:
    rows accepted, rows set aside and why."""
    folder = f"{shared_folder(t.spark)}/catalogo-{uuid.uuid4().hex}"
    tables_of = {name: t[source] for name, source in _CATALOGUE.items()}

    def write(name: str) -> None:
        declared = T._parse_datatype_string(SCHEMAS[name]).names
        kept = [c for c in declared if c in tables_of[name].columns]
        texts = tables_of[name].select(*[F.col(c).cast("string").alias(c) for c in kept])
        column = _first_typed(name)
        if column:
            wrong = {c: F.lit("no es" if c == column else None).cast("string").alias(c) for c in kept}
            texts = texts.unionByName(t.spark.range(1).select(*wrong.values()))
        write_text(texts, f"{folder}/{name}")

    with ThreadPoolExecutor(4) as pool:
        list(pool.map(write, tables_of))
    counts = []
    for name in _CATALOGUE:
        read = tables.read_quarantined(t.spark, name, f"{folder}/{name}", "csv")
        accepted = read.accepted.agg(n().alias("aceptadas"))
        rejected = read.rejected.agg(n().alias("rechazadas"), F.max(F.col("motivos")[0]).alias("motivo"))
        counts.append(
            accepted.select(F.lit(name).alias("tabla"), "aceptadas", F.lit(0).cast("long").alias("rechazadas"),
                            F.lit(None).cast("string").alias("motivo"))
            .unionByName(rejected.select(F.lit(name).alias("tabla"),
                                         F.lit(0).cast("long").alias("aceptadas"), "rechazadas", "motivo"))
        )
    whole = reduce(DataFrame.unionByName, counts)
    return whole.groupBy("tabla").agg(
        F.sum("aceptadas").alias("aceptadas"),
        F.sum("rechazadas").alias("rechazadas"),
        F.max("motivo").alias("motivo"),
    )


_SAMPLE = """
SELECT recibo AS nrecibo, numero_documento_sap AS documento, cdsubgarantia,
  poliza_certificado, fecha_contabilizacion_recibo AS fecont_pdcion,
  fecha_inicio_vigencia_cobertura AS feini_vigencia_cobertura,
  fecha_fin_vigencia_cobertura AS fefin_vigencia_cobertura,
  valor_prima_emitida AS ptcobro_cobertura FROM recibos"""
s.ALL["muestra"] = _SAMPLE
_DAYS = "date_diff('day', feini_vigencia_cobertura, fefin_vigencia_cobertura) + 1"
_WHERE = {
    "pdn_anticipada_no_mensual": f"""fecont_pdcion < feini_vigencia_cobertura AND {_DAYS} > 32
      AND ptcobro_cobertura <> 0 AND year(fecont_pdcion) <> 1900
      AND date_diff('day', fecont_pdcion, feini_vigencia_cobertura) + 1 > 30""",
    "pdn_anticipada_mensual": f"""year(fecont_pdcion) = year(feini_vigencia_cobertura)
      AND month(fecont_pdcion) < month(feini_vigencia_cobertura) AND {_DAYS} BETWEEN 15 AND 32
      AND ptcobro_cobertura <> 0""",
    "pdn_vencida_no_mensual": f"""fecont_pdcion > fefin_vigencia_cobertura AND {_DAYS} > 32
      AND ptcobro_cobertura <> 0""",
    "pdn_vencida_mensual": f"""year(fecont_pdcion) = year(fefin_vigencia_cobertura)
      AND month(fecont_pdcion) > month(fefin_vigencia_cobertura) AND {_DAYS} BETWEEN 15 AND 32
      AND ptcobro_cobertura <> 0""",
}
_ORDER = (
    "nrecibo, documento, cdsubgarantia, poliza_certificado, fecont_pdcion, "
    "feini_vigencia_cobertura, fefin_vigencia_cobertura, ptcobro_cobertura"
)


@query(
    "src_fixture_examples",
    "\nUNION ALL\n".join(
        f"SELECT * FROM (SELECT *, '{name}' AS patron FROM muestra WHERE {where} "
        f"ORDER BY {_ORDER} LIMIT 1)"
        for name, where in _WHERE.items()
    ),
)
def src_fixture_examples(t: Inputs) -> DataFrame:
    raw = t["recibos"].select(
        F.col("recibo").alias("nrecibo"),
        F.col("numero_documento_sap").alias("documento"),
        "cdsubgarantia",
        "poliza_certificado",
        F.col("fecha_contabilizacion_recibo").alias("fecont_pdcion"),
        F.col("fecha_inicio_vigencia_cobertura").alias("feini_vigencia_cobertura"),
        F.col("fecha_fin_vigencia_cobertura").alias("fefin_vigencia_cobertura"),
        F.col("valor_prima_emitida").alias("ptcobro_cobertura"),
    )
    found = [
        df.withColumn("patron", F.lit(name)) for name, df in tables.example_receipts(raw).items()
    ]
    return union_aligned(found)
