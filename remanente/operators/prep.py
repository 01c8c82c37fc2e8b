"""Turn receipts and balances into rows ready to accrue.

Every function filters to the valuation date first, attaches the accounting parameters, and
ends in the same four columns: recognition date, accrual start, accrual end and base amount.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from remanente.config import RunConfig
from remanente.functions.dates import as_col, level_date, month_start, yyyymm
from remanente.functions.schema import with_cohort, with_transition
from remanente.operators.lookups import (
    FLAG_5050,
    attach_accounting_params,
    attach_contract_tracking,
    attach_discounts,
    attach_expenses,
    attach_financing_params,
    attach_locked_in_factors,
    mark_fifty_fifty,
)
from remanente.vocabulary import (
    GASTO_A_INSUMO_DIRECTO,
    GASTO_A_INSUMO_REA,
    OPERACIONES_ANULACION,
    PREFIJO_MATEMATICA,
)

BOOKED = "fecha_contabilizacion_recibo"


def up_to_valuation(df: DataFrame, event: str, cfg: RunConfig) -> DataFrame:
    return df.filter(F.col(event) <= F.lit(cfg.fecha_valoracion))


def with_accrual_terms(
    df: DataFrame, event: str, amount: Column | str, start: Column | None = None
) -> DataFrame:
    """Accrual dates from the row's detail level, recognised on ``event``."""
    term_start = level_date("fecha_inicio_vigencia") if start is None else start
    return df.withColumns(
        {
            "fecha_inicio_vigencia": term_start,
            "fecha_constitucion": F.col(event),
            "fecha_inicio_devengo": F.greatest(F.col(event), term_start),
            "fecha_fin_devengo": level_date("fecha_fin_vigencia"),
            "valor_base_devengo": as_col(amount),
        }
    )


def with_same_terms(df: DataFrame, start: str, end: str) -> DataFrame:
    """Receipt and coverage terms both run from ``start`` to ``end``."""
    terms = {}
    for level in ("recibo", "cobertura"):
        terms[f"fecha_inicio_vigencia_{level}"] = F.col(start)
        terms[f"fecha_fin_vigencia_{level}"] = F.col(end)
    return df.withColumns(terms)


def events(df: DataFrame, event: str, amount: Column | str, marked: bool = True) -> DataFrame:
    """Rows of an input on the way: when they are recognised, how much, and whether the half/half
    exceptions apply to them."""
    return df.withColumns(
        {"_evento": F.col(event), "_monto": as_col(amount), "_con_marca": F.lit(marked)}
    )


def ready_to_accrue(rows: DataFrame, params: DataFrame, exceptions: DataFrame) -> DataFrame:
    """Accounting parameters, exceptions and accrual terms of event rows, of one input or of many."""
    found = attach_accounting_params(rows, params, by_row=True)
    ruled = mark_fifty_fifty(found, exceptions)
    flag = F.when(F.col("_con_marca"), F.col(FLAG_5050)).alias(FLAG_5050)
    return with_accrual_terms(ruled.withColumn(FLAG_5050, flag), "_evento", "_monto").drop(
        "_evento", "_monto", "_con_marca"
    )


def premium_events(receipts: DataFrame, cfg: RunConfig) -> DataFrame:
    return events(up_to_valuation(receipts, BOOKED, cfg), BOOKED, "valor_prima_emitida")


def direct_premium(
    receipts: DataFrame, params: DataFrame, exceptions: DataFrame, cfg: RunConfig
) -> DataFrame:
    return ready_to_accrue(premium_events(receipts, cfg), params, exceptions)


def ceded_premium_events(cessions: DataFrame, cfg: RunConfig) -> DataFrame:
    return events(up_to_valuation(cessions, BOOKED, cfg), BOOKED, "valor_prima_cedida")


def ceded_premium(
    cessions: DataFrame, params: DataFrame, exceptions: DataFrame, cfg: RunConfig
) -> DataFrame:
    return ready_to_accrue(ceded_premium_events(cessions, cfg), params, exceptions)


def commission_events(commissions: DataFrame, cfg: RunConfig) -> DataFrame:
    return events(up_to_valuation(commissions, BOOKED, cfg), BOOKED, "valor_comision_rea")


def ceded_commission(
    commissions: DataFrame, params: DataFrame, exceptions: DataFrame, cfg: RunConfig
) -> DataFrame:
    return ready_to_accrue(commission_events(commissions, cfg), params, exceptions)


def _discount_events(receipts, discounts, cfg, kind, premium, reinsurance):
    relabelled = up_to_valuation(receipts, BOOKED, cfg).withColumn("tipo_insumo", F.lit(kind))
    ready = attach_discounts(relabelled, discounts, reinsurance)
    kept_share = 1 - (F.col("podto_comercial") + F.col("podto_tecnico"))
    list_premium = F.try_divide(F.col(premium), kept_share)
    return events(ready, BOOKED, list_premium * F.col("podto_comercial"))


def discount_events(receipts: DataFrame, discounts: DataFrame, cfg: RunConfig) -> DataFrame:
    """Commercial discount on the premium before any discount."""
    return _discount_events(receipts, discounts, cfg, "dcto_directo", "valor_prima_emitida", False)


def direct_discount(
    receipts: DataFrame,
    params: DataFrame,
    exceptions: DataFrame,
    discounts: DataFrame,
    cfg: RunConfig,
) -> DataFrame:
    return ready_to_accrue(discount_events(receipts, discounts, cfg), params, exceptions)


def ceded_discount_events(cessions: DataFrame, discounts: DataFrame, cfg: RunConfig) -> DataFrame:
    """Commercial discount on ceded premium, found through the reinsurance receipt."""
    return _discount_events(cessions, discounts, cfg, "dcto_rea_prop", "valor_prima_cedida", True)


def ceded_discount(
    cessions: DataFrame,
    params: DataFrame,
    exceptions: DataFrame,
    discounts: DataFrame,
    cfg: RunConfig,
) -> DataFrame:
    return ready_to_accrue(ceded_discount_events(cessions, discounts, cfg), params, exceptions)


def expense_input_name(mapping: dict[str, str], cfg: RunConfig) -> Column:
    """Input name of an expense type; unmapped types keep theirs, mathematical lines a prefix."""
    pairs = [F.lit(text) for pair in mapping.items() for text in pair]
    named = F.coalesce(F.create_map(*pairs)[F.col("tipo_gasto")], F.col("tipo_gasto"))
    mathematical = F.col("ramo_sura").isin(*cfg.lineas_matematica)
    return F.when(mathematical, F.concat(F.lit(PREFIJO_MATEMATICA), named)).otherwise(named)


def _expense_events(receipts, expenses, cfg, mapping, premium) -> DataFrame:
    """Expenses name their standard; one that names none fits no parameters and goes."""
    priced = attach_expenses(up_to_valuation(receipts, BOOKED, cfg), expenses)
    named = priced.filter(F.col("tipo_contabilidad").isNotNull()).withColumn(
        "tipo_insumo", expense_input_name(mapping, cfg)
    )
    return events(named, BOOKED, F.col(premium) * F.col("porc_gasto"))


def expense_events(receipts: DataFrame, expenses: DataFrame, cfg: RunConfig) -> DataFrame:
    return _expense_events(receipts, expenses, cfg, GASTO_A_INSUMO_DIRECTO, "valor_prima_emitida")


def direct_expense(
    receipts: DataFrame,
    params: DataFrame,
    exceptions: DataFrame,
    expenses: DataFrame,
    cfg: RunConfig,
) -> DataFrame:
    return ready_to_accrue(expense_events(receipts, expenses, cfg), params, exceptions)


def ceded_expense_events(cessions: DataFrame, expenses: DataFrame, cfg: RunConfig) -> DataFrame:
    """Only the expense types a cession takes part in; the expense table is cut before the join."""
    shared = expenses.filter(F.col("tipo_gasto").isin(*GASTO_A_INSUMO_REA))
    return _expense_events(cessions, shared, cfg, GASTO_A_INSUMO_REA, "valor_prima_cedida")


def ceded_expense(
    cessions: DataFrame,
    params: DataFrame,
    exceptions: DataFrame,
    expenses: DataFrame,
    cfg: RunConfig,
) -> DataFrame:
    return ready_to_accrue(ceded_expense_events(cessions, expenses, cfg), params, exceptions)


def onerous_events(onerosity: DataFrame, cfg: RunConfig) -> DataFrame:
    """Onerous contracts, to which no half/half exception applies."""
    termed = with_same_terms(
        up_to_valuation(onerosity, "fecha_operacion", cfg),
        "fecha_operacion",
        "fecha_fin_vigencia_poliza",
    )
    return events(termed, "fecha_operacion", "valor_onerosidad", marked=False)


def onerous_contracts(onerosity: DataFrame, params: DataFrame, cfg: RunConfig) -> DataFrame:
    found = attach_accounting_params(onerous_events(onerosity, cfg), params)
    return with_accrual_terms(found, "_evento", "_monto").drop("_evento", "_monto", "_con_marca")


CEDED_POLICY_FIELDS = [
    "tipo_negocio",
    "contrato_reaseguro",
    "nit_reasegurador",
    "tipo_reasegurador",
    "porc_participacion_reasegurador",
    "fe_ini_vig_contrato_reaseguro",
    "fe_fin_vig_contrato_reaseguro",
    "poliza",
    "compania",
    "ramo_sura",
    "porc_cesion",
]


def join_ceded_policies(onerosity: DataFrame, cessions: DataFrame) -> DataFrame:
    """Onerous policies with every distinct reinsurance share they are ceded under."""
    shares = cessions.select(*CEDED_POLICY_FIELDS).distinct()
    return onerosity.drop("tipo_negocio").join(shares, ["poliza", "compania", "ramo_sura"], "inner")


def recovery_events(onerosity: DataFrame, cessions: DataFrame, cfg: RunConfig) -> DataFrame:
    """Onerosity recovered under every share a policy is ceded under."""
    relabelled = up_to_valuation(onerosity, "fecha_operacion", cfg).withColumn(
        "tipo_insumo", F.lit("recup_onerosidad_pp")
    )
    termed = with_same_terms(
        join_ceded_policies(relabelled, cessions), "fecha_operacion", "fecha_fin_vigencia_poliza"
    )
    share = (
        F.col("valor_onerosidad")
        * F.col("porc_cesion")
        * F.col("porc_participacion_reasegurador")
    )
    return events(termed, "fecha_operacion", share)


def proportional_recovery(
    onerosity: DataFrame,
    cessions: DataFrame,
    params: DataFrame,
    exceptions: DataFrame,
    cfg: RunConfig,
) -> DataFrame:
    return ready_to_accrue(recovery_events(onerosity, cessions, cfg), params, exceptions)


def _contract_base(
    df: DataFrame, rolled: bool | None, first_amount: Column, cfg: RunConfig
) -> tuple[Column, Column]:
    """Base amount and term start: what is left, spread anew, when the row carries a balance.

    Without a choice by ``rolled`` each row decides by its own balance. As coded, a column of that
    name decides for all rows.
    """
    first_start = level_date("fecha_inicio_vigencia")
    if rolled is None and cfg.as_coded:
        rolled = "saldo_anterior" in df.columns
    if rolled is None and "saldo_anterior" in df.columns:
        carried = F.col("saldo_anterior").isNotNull()
        return (
            F.when(carried, F.col("saldo_anterior")).otherwise(first_amount),
            F.when(carried, F.lit(cfg.inicio_periodo)).otherwise(first_start),
        )
    if rolled:
        return F.col("saldo_anterior"), F.lit(cfg.inicio_periodo)
    return first_amount, first_start


#: What tells one contract row of an accounting standard from another, as far as a table has it.
CARRIED_KEYS = [
    "tipo_insumo",
    "tipo_negocio",
    "compania",
    "ramo_sura",
    "contrato_reaseguro",
    "nit_reasegurador",
    "poliza",
    "recibo",
    "tipo_contabilidad",
]


def with_carried_balance(ready: DataFrame, closed: DataFrame) -> DataFrame:
    """``saldo_anterior`` of each contract row from the accrual output of the close before.

    The balance is that of the same row under the same standard, without the sign that the accrual
    gave it; rows that the close before does not hold carry none.
    """
    keys = [k for k in CARRIED_KEYS if k in ready.columns]
    balances = closed.groupBy(*[F.col(k).alias(f"_s_{k}") for k in keys]).agg(
        F.sum("saldo").alias("_saldo")
    )
    same = [F.col(k).eqNullSafe(F.col(f"_s_{k}")) for k in keys]
    joined = ready.drop("saldo_anterior").join(balances, same, "left")
    carried = F.col("_saldo") * F.col("signo_constitucion")
    return joined.withColumn("saldo_anterior", carried).drop("_saldo", *[f"_s_{k}" for k in keys])


def contract_cost(
    costs: DataFrame,
    tracking: DataFrame,
    params: DataFrame,
    exceptions: DataFrame,
    cfg: RunConfig,
    rolled: bool | None = None,
    closed: DataFrame | None = None,
) -> DataFrame:
    """Non-proportional contract cost, first booked or rolled from the month before.

    Balances come with the costs, or from ``closed``, the accrual output of the close before.
    """
    first = F.col("valor_costo_contrato") + F.col("valor_reinstalamento")
    ready = attach_contract_tracking(
        mark_fifty_fifty(
            attach_accounting_params(up_to_valuation(costs, BOOKED, cfg), params), exceptions
        ),
        tracking,
        cfg,
    )
    if closed is not None:
        ready = with_carried_balance(ready, closed)
    amount, start = _contract_base(ready, rolled, first, cfg)
    termed = with_accrual_terms(ready, BOOKED, amount, start)
    return termed.withColumn(
        "fecha_inicio_devengo", F.greatest("fecha_inicio_devengo", "fe_reinstalamento")
    )


def nonproportional_recovery(
    recoveries: DataFrame,
    tracking: DataFrame,
    params: DataFrame,
    exceptions: DataFrame,
    cfg: RunConfig,
    rolled: bool | None = None,
    closed: DataFrame | None = None,
) -> DataFrame:
    """Onerosity recovered under non-proportional contracts, over the contract's own term."""
    event = "fecha_calculo_recuperacion"
    first = F.col("valor_recuperacion") * F.col("porc_participacion_reasegurador")
    termed = with_same_terms(
        up_to_valuation(recoveries, event, cfg),
        "fe_ini_vig_contrato_reaseguro",
        "fe_fin_vig_contrato_reaseguro",
    )
    ready = attach_contract_tracking(
        mark_fifty_fifty(attach_accounting_params(termed, params), exceptions), tracking, cfg
    )
    if closed is not None:
        ready = with_carried_balance(ready, closed)
    amount, start = _contract_base(ready, rolled, first, cfg)
    return with_accrual_terms(ready, event, amount, start)


def first_annulment(df: DataFrame) -> DataFrame:
    """Earliest annulment booking of each policy, joined back to its receipts.

    An aggregate and a join rather than a window: the minimum is combined before the shuffle,
    and a policy with very many receipts is split by the skew join.
    """
    policy = ["compania", "ramo_sura", "poliza"]
    earliest = (
        df.filter(F.col("tipo_op").isin(*OPERACIONES_ANULACION))
        .groupBy(*policy)
        .agg(F.min("fecha_constitucion").alias("fecha_primera_anulacion"))
    )
    return df.join(earliest, policy, "left")


def investment_component(receipts: DataFrame, params: DataFrame, cfg: RunConfig) -> DataFrame:
    """Investment component, released when the policy ends or is cancelled."""
    booked = up_to_valuation(receipts, BOOKED, cfg).withColumn("fecha_constitucion", F.col(BOOKED))
    ready = attach_accounting_params(first_annulment(booked), params)
    policy_end = F.col("fecha_fin_vigencia_poliza")
    early_end = F.least("fecha_primera_anulacion", policy_end)
    release = F.when(
        F.col("fecha_cancelacion_poliza").isNull(), F.greatest(policy_end, "fecha_constitucion")
    ).otherwise(F.greatest(early_end, "fecha_cancelacion_poliza", "fecha_constitucion"))
    return ready.withColumns(
        {
            "fecha_inicio_devengo": F.greatest("fecha_constitucion", "fecha_inicio_vigencia_poliza"),
            "fecha_fin_devengo": release,
            "valor_base_devengo": F.col("valor_prima_emitida"),
        }
    ).drop("fecha_primera_anulacion")


def receivables(balances: DataFrame, params: DataFrame, cfg: RunConfig) -> DataFrame:
    """Balances of the valuation month, which go to accounting without accruing."""
    in_month = balances.filter(
        F.col("fecha_corte").between(F.lit(cfg.inicio_periodo), F.lit(cfg.fecha_valoracion))
    )
    ready = attach_accounting_params(in_month, params).withColumns(
        {
            "fecha_valoracion": F.lit(cfg.fecha_valoracion),
            "fecha_inicio_periodo": F.lit(cfg.inicio_periodo),
            "valor_md": F.col("valor_ml"),
            "anio_liberacion": F.lit("no_aplica"),
            "regla_devengo": F.lit("no_aplica"),
        }
    )
    return with_transition(with_cohort(ready), cfg.fecha_transicion)


def workers_comp_receipts(receipts: DataFrame) -> DataFrame:
    """Workers' compensation receipts cover their contribution month."""
    first, last = month_start("mes_cotizacion"), F.last_day("mes_cotizacion")
    return receipts.withColumns(
        {
            "fecha_inicio_vigencia_recibo": first,
            "fecha_fin_vigencia_recibo": last,
            "fecha_inicio_vigencia_cobertura": first,
            "fecha_fin_vigencia_cobertura": last,
            "fecha_expedicion_poliza": first,
        }
    )


def workers_comp_balances(balances: DataFrame) -> DataFrame:
    return balances.withColumn("fecha_expedicion_poliza", month_start("mes_cotizacion"))


def with_financing(
    prepared: DataFrame,
    financing: DataFrame,
    ipc: DataFrame,
    factors: DataFrame,
    cfg: RunConfig,
) -> DataFrame:
    """Financing parameters, node days and curve factors, filled only where financing applies."""
    start, end = F.col("fecha_inicio_vigencia"), F.col("fecha_fin_devengo")
    start_days, end_days = F.dayofmonth(F.last_day(start)), F.dayofmonth(F.last_day(end))
    derived = {
        "mes_inicio_vigencia": yyyymm(start),
        "mes_fin_vigencia": yyyymm(end),
        "mes_valoracion": F.lit(cfg.mes_valoracion),
        "mes_valoracion_anterior": F.lit(cfg.mes_anterior),
        "dias_vig_ini": start_days - F.dayofmonth(start) + 1,
        "dias_nodo_ini": start_days,
        "dias_vig_fin": F.dayofmonth(end),
        "dias_nodo_fin": end_days,
    }
    applies = F.col("aplica_comp_financ") == 1
    marked = attach_financing_params(prepared, financing).withColumns(
        {name: F.when(applies, value) for name, value in derived.items()}
    )
    return attach_locked_in_factors(marked, ipc, factors, cfg)


def split_financed_line(prepared: DataFrame, cfg: RunConfig) -> tuple[DataFrame, DataFrame]:
    """Rows of the financed line of business, and the rest."""
    financed = F.col("ramo_sura") == cfg.linea_financiada
    return prepared.filter(financed), prepared.filter(~financed)
