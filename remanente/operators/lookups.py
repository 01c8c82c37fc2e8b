"""Receipts with their parameters and rates.

Parameters, price indices and closing rates are looked up in dictionaries, whose size is checked.
The other tables are joined without broadcast hints: such a table is broadcast only when its measured
size is under ``spark.sql.autoBroadcastJoinThreshold`` (statically, or at run time through AQE), and
is shuffled with skew splitting above it.
"""

from __future__ import annotations

from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from remanente.config import RunConfig
from remanente.functions.dates import previous_month
from remanente.operators.dictionary import dictionary, key, look_up
from remanente.operators.tariffs import SCOPE, UNRANKED, best_rates, rates_in_force, scope_rank
from remanente.operators.wildcard import best_rule, wildcard_count
from remanente.vocabulary import WILDCARD

FLAG_5050 = "candidato_devengo_50_50"

ACCOUNTING_FIELDS = [
    "componente",
    "clasificacion_adicional",
    "tipo_contrato",
    "nivel_detalle",
    "signo_constitucion",
]

DISCOUNT_KEYS = [
    "compania",
    "ramo_sura",
    "poliza",
    "recibo",
    "poliza_certificado",
    "amparo",
    "tipo_op",
    "producto",
    "numero_documento_sap",
]

EXPENSE_RECEIPT_KEYS = [
    "numero_documento_sap",
    "tipo_op",
    "tipo_insumo",
    "poliza",
    "poliza_certificado",
    "recibo",
    "amparo",
    "cdsubgarantia",
]

FINANCING_WILD = ["tipo_insumo", "compania", "ramo_sura", "producto", "tipo_op"]


def active_parameters(params: DataFrame) -> DataFrame:
    return params.filter(F.col("estado_insumo") == 1)


def attach_accounting_params(
    base: DataFrame, params: DataFrame, by_row: bool = False
) -> DataFrame:
    """One row per accounting standard of the row's input and business kind.

    A base that already names its standard keeps only the combinations the table allows; others
    keep rows that the table does not know. ``by_row``: rows with a standard and rows without one
    stand in one base. The parameters of a kind are one entry of a dictionary, so that rows which all
    have the same kind meet no join on a constant.
    """
    keys = ["tipo_insumo", "tipo_negocio"]
    named = "tipo_contabilidad" in base.columns
    if named and not by_row:
        keys = [*keys, "tipo_contabilidad"]
    fields = [f for f in ("tipo_contabilidad", *ACCOUNTING_FIELDS) if f not in keys]
    kinds = params.groupBy(*keys).agg(F.collect_list(F.struct(*fields)).alias("_filas"))
    of_kind = key(*[F.col(k) for k in keys])
    table = dictionary(kinds, of_kind, F.col("_filas"), "the table of accounting parameters")
    found = look_up(base, table, {"_parametros": of_kind})
    rows = found.select(*base.columns, F.explode_outer("_parametros").alias("_parametro"))
    if not named:
        return rows.select(*base.columns, *[F.col(f"_parametro.{f}") for f in fields])
    if not by_row:
        known = rows.filter(F.col("_parametro").isNotNull())
        return known.select(*base.columns, *[F.col(f"_parametro.{f}") for f in fields])
    own, given = F.col("tipo_contabilidad"), F.col("_parametro.tipo_contabilidad")
    fitting = rows.filter(own.isNull() | (own == given))
    others = [c for c in base.columns if c != "tipo_contabilidad"]
    return fitting.select(
        *others,
        F.coalesce(own, given).alias("tipo_contabilidad"),
        *[F.col(f"_parametro.{f}") for f in fields if f != "tipo_contabilidad"],
    )


def attach_discounts(
    receipts: DataFrame, discounts: DataFrame, reinsurance: bool = False
) -> DataFrame:
    """Commercial and technical discount of the receipt, 0 where there is none."""
    receipt_key = "recibo_rea" if reinsurance else "recibo"
    source = {k: F.col(receipt_key if k == "recibo" else k) for k in DISCOUNT_KEYS}
    source["poliza"] = source["poliza"].cast("string")
    rates = ["podto_comercial", "podto_tecnico"]
    lookup = discounts.select(*[c.alias(k) for k, c in source.items()], *rates)
    joined = receipts.withColumn("poliza", F.col("poliza").cast("string")).join(
        lookup, DISCOUNT_KEYS, "left"
    )
    return joined.withColumns({r: F.coalesce(r, F.lit(0.0)) for r in rates})


def expense_candidates(receipts: DataFrame, expenses: DataFrame) -> DataFrame:
    """Every expense row in force at the policy issue date that fits the receipt."""
    limits = ["compania", "ramo_sura", "canal", "producto", "fecha_inicio", "fecha_fin"]
    table = expenses.select(
        *[F.col(c).alias(f"_g_{c}") for c in limits],
        "tipo_contabilidad",
        "tipo_gasto",
        "porc_gasto",
        scope_rank().alias("prioridad_match"),
    )
    fits = (
        (F.col("compania") == F.col("_g_compania"))
        & (F.col("ramo_sura") == F.col("_g_ramo_sura"))
        & ((F.col("canal") == F.col("_g_canal")) | (F.col("_g_canal") == WILDCARD))
        & ((F.col("producto") == F.col("_g_producto")) | (F.col("_g_producto") == WILDCARD))
        & F.col("fecha_expedicion_poliza").between(F.col("_g_fecha_inicio"), F.col("_g_fecha_fin"))
    )
    return receipts.join(table, fits, "inner")


def alone_and_shared(rows: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """The rows that are the only ones of their key, and the rows of keys that several have.

    Rows are dealt out once, by a hash of the key, before anything multiplies them; both parts read that
    exchange. A row whose hash comes once has a key of its own; chance puts a few others among the shared
    ones, where the keys themselves are compared. Null keys are equal.
    """
    counted = (
        rows.withColumn("_huella", F.xxhash64(*keys))
        .repartition("_huella")
        .withColumn("_veces", F.count(F.lit(1)).over(Window.partitionBy("_huella")))
    )
    # A digest of all columns in a comparison that no digest fails: both parts ask for the same columns of
    # the exchange, so that it is made once.
    whole, least = F.xxhash64(*[F.col(c) for c in rows.columns]), F.lit(-(1 << 63))
    alone = F.when(F.col("_veces") == 1, whole) >= least
    shared = F.when(F.col("_veces") > 1, whole) >= least
    return counted.filter(alone).drop("_veces"), counted.filter(shared).drop("_veces")


def attach_expenses(receipts: DataFrame, expenses: DataFrame) -> DataFrame:
    """Best expense row per receipt, expense type and standard; more specific rows win.

    Each receipt row brings its own best rates, one per type and standard. The rows of a receipt key that
    no other row has keep them all; they are multiplied after the only shuffle of receipts and are
    neither sorted nor dealt out again. Rows that share a receipt key compete: the ``row_number() == 1``
    filter is a group limit, so a key shared by many rows keeps one of them in memory at a time.
    """
    keys = [*EXPENSE_RECEIPT_KEYS, "tipo_gasto", "tipo_contabilidad"]
    own = [c for c in receipts.columns if c != "tipo_contabilidad"]
    ties = [
        c
        for c in (
            "fecha_expedicion_poliza",
            "canal",
            "producto",
            "fecha_contabilizacion_recibo",
            "valor_prima_emitida",
            "valor_prima_cedida",
        )
        if c in receipts.columns
    ]

    def rated(df: DataFrame) -> DataFrame:
        # The outer form: for the plain one the optimizer adds a filter on the size of the array, which it
        # moves below and so works the array out a second time.
        spread = (
            best_rates(df, expenses, "_g_tarifas")
            .select(*own, "_huella", F.explode_outer("_g_tarifas").alias("_g_tarifa"))
            .filter(F.col("_g_tarifa").isNotNull())
        )
        return spread.select(
            *own,
            "_huella",
            "_g_tarifa.tipo_contabilidad",
            "_g_tarifa.tipo_gasto",
            "_g_tarifa.porc_gasto",
            F.nullif(F.col("_g_tarifa.rango"), F.lit(UNRANKED)).alias("prioridad_match"),
            F.col("_g_tarifa.desde").alias("_g_desde"),
        )

    alone, shared = alone_and_shared(receipts.select(*own), EXPENSE_RECEIPT_KEYS)
    best_first = Window.partitionBy("_huella", *keys).orderBy(
        F.col("prioridad_match").asc_nulls_last(), "_g_desde", "porc_gasto", *ties
    )
    ranked = rated(shared).withColumn("_puesto", F.row_number().over(best_first))
    first = ranked.filter(F.col("_puesto") == 1).drop("_puesto")
    return rated(alone).unionByName(first).drop("_huella", "_g_desde")


def expense_match_sizes(receipts: DataFrame, expenses: DataFrame) -> DataFrame:
    """How many expense rows a receipt and expense type match, and the types with that many."""
    return (
        expense_matches(receipts, expenses)
        .groupBy("rows_in_partition")
        .agg(F.sort_array(F.collect_set("tipo_gasto")).alias("tipo_gasto_unicos"))
        .orderBy("rows_in_partition")
    )


def expense_matches(receipts: DataFrame, expenses: DataFrame) -> DataFrame:
    """Per receipt key and expense type that match any: ``rows_in_partition``, the expense rows in force.

    The rows are counted and not made: only receipts that share a key are added up by it.
    """
    scope = [*SCOPE, "fecha_expedicion_poliza"]
    needed = list(dict.fromkeys([*EXPENSE_RECEIPT_KEYS, *scope]))
    alone, shared = alone_and_shared(receipts.select(*needed), EXPENSE_RECEIPT_KEYS)
    group = [*EXPENSE_RECEIPT_KEYS, "tipo_gasto"]

    def counted(df: DataFrame) -> DataFrame:
        return (
            rates_in_force(df, expenses, "_g_cuantas")
            .select("_huella", *EXPENSE_RECEIPT_KEYS, F.explode_outer("_g_cuantas").alias("_g"))
            .filter(F.col("_g").isNotNull())
            .select("_huella", *EXPENSE_RECEIPT_KEYS, "_g.tipo_gasto", F.col("_g.filas").alias("rows_in_partition"))
        )

    together = (
        counted(shared)
        .groupBy("_huella", *group)
        .agg(F.sum("rows_in_partition").alias("rows_in_partition"))
    )
    return counted(alone).unionByName(together).drop("_huella")


def mark_fifty_fifty(base: DataFrame, exceptions: DataFrame) -> DataFrame:
    """Flag candidates for the half/half rule: 1, unless the last matching exception differs.

    ``exceptions`` holds text columns named like columns of ``base`` (``'*'`` = any), the flag,
    and ``orden``: of several matching rows the highest ``orden`` wins. A rule that asks for a
    column the base lacks is left out.
    """
    rule_cols = [c for c in exceptions.columns if c not in (FLAG_5050, "orden")]
    known = [c for c in rule_cols if c in base.columns]
    absent = [c for c in rule_cols if c not in base.columns]
    usable = exceptions
    if absent:
        usable = usable.filter(reduce(Column.__and__, [F.col(c) == WILDCARD for c in absent]))
    default = F.col(FLAG_5050) if FLAG_5050 in base.columns else F.lit(1)
    choice = F.struct("orden", F.col(FLAG_5050).alias("marca"))
    ruled = best_rule(base, usable, [], known, choice, "_excepcion", highest=True)
    flag = F.when(F.col("_excepcion").isNull(), default).otherwise(F.col("_excepcion.marca"))
    return ruled.withColumn(FLAG_5050, flag.cast("int")).drop("_excepcion")


def attach_fx_rates(base: DataFrame, rates: DataFrame, cfg: RunConfig) -> DataFrame:
    """Rates at the valuation date, the previous close, the day after each, and recognition.

    Local standards read the day after a close, the corporate standard the close itself. Those four
    dates are fixed in a run: their rates stand side by side in a dictionary by currency, so rows are
    not dealt out by currency, of which one is most common.
    """
    one = timedelta(days=1)
    closes = {
        "tasa_cambio_fecha_valoracion_corporativo": cfg.fecha_valoracion,
        "tasa_cambio_fecha_valoracion_local": cfg.fecha_valoracion + one,
        "tasa_cambio_fecha_valoracion_anterior_corporativo": cfg.cierre_anterior,
        "tasa_cambio_fecha_valoracion_anterior_local": cfg.cierre_anterior + one,
    }
    recognised = "tasa_cambio_fecha_constitucion"
    rate = F.col("tasa_cambio").cast("double")
    at_close = (
        rates.filter(F.col("fecha").isin(*closes.values()))
        .groupBy("moneda_origen")
        .agg(*[F.max(F.when(F.col("fecha") == d, rate)).alias(n) for n, d in closes.items()])
    )
    by_day = rates.select(
        F.col("fecha").alias("_fecha_tc"),
        F.col("moneda_origen").alias("_moneda_dia"),
        rate.alias(recognised),
    )
    same_day = (F.col("fecha_constitucion") == F.col("_fecha_tc")) & (
        F.col("moneda") == F.col("_moneda_dia")
    )
    table = dictionary(
        at_close, key(F.col("moneda_origen")), F.struct(*closes), "the rates of a close"
    )
    out = look_up(base, table, {"_cierre": key(F.col("moneda"))})
    out = out.withColumns({n: F.col(f"_cierre.{n}") for n in closes}).drop("_cierre")
    out = out.join(by_day, same_day, "left").drop("_moneda_dia", "_fecha_tc")
    return out.withColumns({n: F.coalesce(n, F.lit(1.0)) for n in [*closes, recognised]})


def attach_financing_params(base: DataFrame, params: DataFrame) -> DataFrame:
    """Financing parameters with the fewest wildcards; flags 0 where nothing matches."""
    values = [
        "aplica_comp_financ",
        "aplica_ipc_mensual",
        "pais_curva",
        "moneda_curva",
        "meses_max_vigencia",
    ]
    choice = F.struct(wildcard_count(FINANCING_WILD).alias("nivel_comodin"), *values)
    ruled = best_rule(
        base, params, ["tipo_contabilidad", "moneda"], FINANCING_WILD, choice, "_financ"
    )
    flags = values[:2]
    picked = {
        v: F.coalesce(f"_financ.{v}", F.lit(0)) if v in flags else F.col(f"_financ.{v}")
        for v in values
    }
    return ruled.withColumns(picked).drop("_financ")


def attach_locked_in_factors(
    base: DataFrame, ipc: DataFrame, factors: DataFrame, cfg: RunConfig
) -> DataFrame:
    """Price indices and locked-in interest factors of a row's curve.

    Indices come from one dictionary of months. The curve is the one of the month before the term
    starts. Valuation and previous month are fixed for a run, so the curve table is first reduced to
    one row per curve holding its first node and those two months; rows then need that join and one
    more for their final month.
    """
    indexed = F.col("aplica_ipc_mensual") == 1
    months = {
        "ini": "mes_inicio_vigencia",
        "actual": "mes_valoracion",
        "anterior": "mes_valoracion_anterior",
    }
    index = dictionary(
        ipc, key(F.col("mesid_ipc")), F.struct("indice_ipc", "tasa"), "the price index"
    )
    out = look_up(base, index, {f"_ipc_{s}": key(F.col(m)) for s, m in months.items()})
    values = {}
    for suffix in months:
        known = F.col(f"_ipc_{suffix}")
        values[f"indice_ipc_{suffix}"] = F.when(indexed, known["indice_ipc"]).otherwise(1.0)
        values[f"tasa_ipc_{suffix}"] = F.when(indexed, known["tasa"]).otherwise(0.0)
    out = out.withColumns(values).drop(*[f"_ipc_{s}" for s in months])

    curve = ["moneda_curva", "pais_curva", "mesid_curva"]
    keyed = out.withColumn("_mes_curva", previous_month("mes_inicio_vigencia"))
    start, final = F.col("nodo") == 1, F.col("mesid_valoracion")

    def at(condition: Column, value: str, name: str) -> Column:
        return F.max(F.when(condition, F.col(value))).alias(name)

    head = [
        at(start, "sum_desc_real", "desc_lir_nodo_ini"),
        at(start, "factor_acumulacion", "fact_acum_ini"),
    ]
    closes = {"val": cfg.mes_valoracion, "ant": cfg.mes_anterior}
    monthly = {
        "fact_acum": "factor_acumulacion",
        "sum_desc_lir": "sum_desc_real",
        "tasa_fwd_real": "tasa_fwd_real",
    }
    for suffix, month in closes.items():
        head += [at(final == month, v, f"{n}_{suffix}") for n, v in monthly.items()]

    def renamed(df: DataFrame) -> DataFrame:
        return df.withColumnsRenamed({c: f"_c_{c}" for c in curve})

    def of_curve() -> Column:
        return (
            (F.col("moneda_curva") == F.col("_c_moneda_curva"))
            & (F.col("pais_curva") == F.col("_c_pais_curva"))
            & (F.col("_mes_curva") == F.col("_c_mesid_curva"))
        )

    private = [f"_c_{c}" for c in curve]
    last = renamed(
        factors.select(
            *curve,
            final.alias("_c_mes_fin"),
            F.col("sum_desc_real").alias("sum_desc_lir_nodo_fin"),
            F.col("factor_desc_real").alias("desc_lir_nodo_fin"),
        )
    )
    per_curve = renamed(factors.groupBy(*curve).agg(*head))
    if cfg.as_coded:
        return _factors_as_coded(keyed, factors, per_curve, of_curve(), private, monthly)
    return (
        keyed.join(per_curve, of_curve(), "left")
        .drop(*private)
        .join(last, of_curve() & (F.col("mes_fin_vigencia") == F.col("_c_mes_fin")), "left")
        .drop(*private, "_c_mes_fin", "_mes_curva")
    )


def _factors_as_coded(
    keyed: DataFrame,
    factors: DataFrame,
    per_curve: DataFrame,
    of_curve: Column,
    private: list[str],
    monthly: dict[str, str],
) -> DataFrame:
    """Legacy matching: only the first node is tied to the row's own curve month.

    The other nodes match every loaded curve of the currency once the first node is found, so
    this form is meant for runs that load a single curve month.
    """
    first = per_curve.filter(F.col("fact_acum_ini").isNotNull()).select(
        *private, "desc_lir_nodo_ini", "fact_acum_ini"
    )
    out = (
        keyed.join(first, of_curve, "left")
        .withColumn("_hay_curva", F.col("_c_mesid_curva").isNotNull())
        .drop(*private)
    )
    lookups = {
        "mes_valoracion": {f"{n}_val": v for n, v in monthly.items()},
        "mes_valoracion_anterior": {f"{n}_ant": v for n, v in monthly.items()},
        "mes_fin_vigencia": {
            "sum_desc_lir_nodo_fin": "sum_desc_real",
            "desc_lir_nodo_fin": "factor_desc_real",
        },
    }
    for month, values in lookups.items():
        nodes = factors.select(
            F.col("moneda_curva").alias("_m"),
            F.col("pais_curva").alias("_p"),
            F.col("mesid_valoracion").alias("_v"),
            *[F.col(v).alias(n) for n, v in values.items()],
        )
        same = (
            F.col("_hay_curva")
            & (F.col("moneda_curva") == F.col("_m"))
            & (F.col("pais_curva") == F.col("_p"))
            & (F.col(month) == F.col("_v"))
        )
        out = out.join(nodes, same, "left").drop("_m", "_p", "_v")
    return out.drop("_hay_curva", "_mes_curva")


def attach_contract_tracking(costs: DataFrame, tracking: DataFrame, cfg: RunConfig) -> DataFrame:
    """Aggregate-limit tracking of the contract at the valuation date."""
    at_close = tracking.filter(F.col("fecha_cierre") == F.lit(cfg.fecha_valoracion)).select(
        "contrato_reaseguro",
        "limite_agregado_valor_instalado",
        "valor_siniestros_incurridos_mes",
        "valor_salvamentos_mes",
        "limite_agregado_casos_instalado",
        "casos_incurridos_mes",
    )
    return costs.join(at_close, "contrato_reaseguro", "left")
