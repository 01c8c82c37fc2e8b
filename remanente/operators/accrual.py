"""Accrual of prepared rows under the five release rules.

All rules run in one pass over the input. Each row gets the route(s) it takes, and every
result column is one CASE over the route, so the plan has no split, no union and no shuffle.
Amounts are unsigned until ``accrue`` applies the sign of the reserve.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from remanente.config import RunConfig
from remanente.functions.dates import as_col, days_between, is_month_end, months_apart, yyyymm
from remanente.functions.schema import ensure_columns, with_result_tags
from remanente.vocabulary import INSUMO_INVERSION, INSUMOS_LIMITE

FINANCED, INVESTMENT, LIMIT, HALVES, DAILY = "FIN", "INV", "LIM", "5050", "DIA"
SHORT_TERM_DAYS = 32

# Columns an input may lack; they are read as nulls then.
OPTIONAL_INPUT = {
    "aplica_comp_financ": "int",
    "candidato_devengo_50_50": "int",
    "fecha_inicio_vigencia": "date",
    "saldo_anterior": "double",
    "limite_agregado_valor_instalado": "double",
    "valor_siniestros_incurridos_mes": "double",
    "valor_salvamentos_mes": "double",
}
FINANCING_INPUT = {
    "mes_inicio_vigencia": "int",
    "mes_fin_vigencia": "int",
    "mes_valoracion": "int",
    "mes_valoracion_anterior": "int",
    "dias_vig_ini": "int",
    "dias_nodo_ini": "int",
    "dias_vig_fin": "int",
    "dias_nodo_fin": "int",
    "indice_ipc_ini": "double",
    "tasa_ipc_ini": "double",
    "indice_ipc_actual": "double",
    "tasa_ipc_actual": "double",
    "indice_ipc_anterior": "double",
    "fact_acum_val": "double",
    "sum_desc_lir_val": "double",
    "tasa_fwd_real_val": "double",
    "fact_acum_ant": "double",
    "sum_desc_lir_ant": "double",
    "tasa_fwd_real_ant": "double",
    "desc_lir_nodo_ini": "double",
    "fact_acum_ini": "double",
    "sum_desc_lir_nodo_fin": "double",
    "desc_lir_nodo_fin": "double",
    "pais_curva": "string",
    "moneda_curva": "string",
}

# Result columns in output order.
OUTPUT_COLUMNS = [
    "componente",
    "tipo_contabilidad",
    "regla_devengo",
    "tipo_contrato",
    "cohorte",
    "anio_liberacion",
    "transicion",
    "fecha_inicio_periodo",
    "fecha_valoracion",
    "fecha_constitucion",
    "fecha_inicio_devengo",
    "fecha_fin_devengo",
    "valor_base_devengo",
    "pais_curva",
    "moneda_curva",
    "factor_ajuste_ipc",
    "factor_cap_real",
    "suma_factores_remanente",
    "suma_factores_total",
    "saldo_anterior",
    "tasa_acreditacion",
    "acreditacion_intereses",
    "dias_devengados",
    "dias_no_devengados",
    "control_suma_dias",
    "dias_constitucion",
    "dias_liberacion",
    "valor_devengo_diario",
    "mes_constitucion",
    "mes_ini_liberacion",
    "mes_fin_liberacion",
    "porc_consumo_limite",
    "estado_devengo",
    "valor_constitucion",
    "valor_liberacion",
    "valor_liberacion_acum",
    "saldo",
]

DAILY_TRACE = [
    "dias_devengados",
    "dias_no_devengados",
    "control_suma_dias",
    "dias_constitucion",
    "dias_liberacion",
    "valor_devengo_diario",
]
FINANCING_TRACE = dict.fromkeys(
    [
        "factor_ajuste_ipc",
        "factor_cap_real",
        "suma_factores_remanente",
        "suma_factores_total",
        "tasa_acreditacion",
        "peso_nodo_ini",
        "peso_nodo_fin",
        "peso_nodo_actual",
        "peso_nodo_anterior",
        "ajuste_base_ini",
        "factor_cap_real_ant",
        "sum_desc_valoracion",
        "sum_desc_anterior",
        "suma_factores_remanente_ant",
        "factor_ajuste_ipc_ant",
    ],
    "double",
)
# Result columns of financed rows that every result carries.
FINANCING_COLUMNS = {
    "pais_curva": "string",
    "moneda_curva": "string",
    "factor_ajuste_ipc": "double",
    "factor_cap_real": "double",
    "suma_factores_remanente": "double",
    "suma_factores_total": "double",
    "tasa_acreditacion": "double",
}
FINANCING_RESULT = {
    "estado_devengo": "string",
    "valor_constitucion": "double",
    "valor_liberacion": "double",
    "valor_liberacion_acum": "double",
    "saldo": "double",
    "acreditacion_intereses": "double",
}

C = F.col
_VALUED, _START, _END = "fecha_valoracion", "fecha_inicio_devengo", "fecha_fin_devengo"
_BOOKED, _TERM_START, _PERIOD = "fecha_constitucion", "fecha_inicio_vigencia", "fecha_inicio_periodo"
_BASE = "valor_base_devengo"


def with_period(df: DataFrame, cfg: RunConfig) -> DataFrame:
    """Valuation date, first day of its month and the previous close, as literals."""
    return df.withColumns(
        {
            _VALUED: F.lit(cfg.fecha_valoracion),
            _PERIOD: F.lit(cfg.inicio_periodo),
            "fecha_valoracion_anterior": F.lit(cfg.cierre_anterior),
        }
    )


# --- classification ---------------------------------------------------------------------


def with_rule_and_routes(df: DataFrame, cfg: RunConfig) -> DataFrame:
    """Rule label and the route, or both routes, of each row.

    A financed row that is also an investment or limit row takes both routes. As coded, a short
    row whose half/half flag is null takes none.
    """
    short = days_between(_END, _TERM_START) <= SHORT_TERM_DAYS
    flag = C("candidato_devengo_50_50")
    candidate = short & ((flag if cfg.as_coded else F.coalesce(flag, F.lit(0))) == 1)
    spans_two = months_apart(_TERM_START, _END) == 1
    halves = candidate & spans_two
    financed = F.coalesce("aplica_comp_financ", F.lit(0)) == 1
    investment = C("tipo_insumo") == INSUMO_INVERSION
    limited = C("tipo_insumo").isin(*INSUMOS_LIMITE)

    label = (
        F.when(investment, "componente_inversion")
        .when(halves, "mensual_devengo_50_50")
        .when(candidate & ~spans_two, "mensual_devengo_diario")
        .when(financed, "componente_financiacion")
        .otherwise("diario")
    )
    special = F.when(investment, INVESTMENT).when(limited, LIMIT)
    general = F.when(halves, HALVES)
    general = general.when(~halves, DAILY) if cfg.as_coded else general.otherwise(DAILY)
    own = F.when(investment | limited, special).otherwise(general)
    both = financed & (investment | limited)
    return df.withColumns(
        {
            "regla_devengo": label,
            "_ruta": F.when(financed, FINANCED).otherwise(own),
            "_segunda_ruta": F.when(both, own),
        }
    )


def route_rows(df: DataFrame, financed: bool = True) -> DataFrame:
    """One row per route; rows without a route are dropped.

    Only financed rows can have a second route, so inputs without financing are not exploded.
    """
    if financed:
        routes = F.expr(
            "CASE WHEN _segunda_ruta IS NULL THEN array(_ruta) ELSE array(_ruta, _segunda_ruta) END"
        )
        df = df.withColumn("_rutas", routes).withColumn("_ruta", F.explode("_rutas")).drop("_rutas")
    return df.filter(C("_ruta").isNotNull()).drop("_segunda_ruta")


# --- daily rule --------------------------------------------------------------------------


def accrual_state() -> Column:
    """Where the row stands in its accrual at the valuation date."""
    return (
        F.when(C(_BOOKED) > C(_END), "entra_devengado")
        .when(C(_VALUED) < C(_START), "no_iniciado")
        .when((C(_START) <= C(_VALUED)) & (C(_VALUED) < C(_END)), "en_curso")
        .otherwise("finalizado")
    )


def daily_rule(df: DataFrame, cfg: RunConfig, into: str = "") -> DataFrame:
    """Straight line over the days of the term. Needs ``with_period``.

    Result columns are prefixed with ``into``.
    """
    state = accrual_state()
    term, per_day = C(f"{into}dias_constitucion"), C(f"{into}valor_devengo_diario")
    done, left = C(f"{into}dias_devengados"), C(f"{into}dias_no_devengados")
    last_day = F.least(_END, _VALUED)
    dated = df.withColumns(
        {
            f"{into}estado_devengo": state,
            f"{into}dias_constitucion": days_between(_END, _TERM_START),
        }
    )
    state = C(f"{into}estado_devengo")
    days_left = F.greatest(days_between(_END, _VALUED, False), F.lit(0))
    counted = dated.withColumns(
        {
            f"{into}dias_devengados": F.when(state == "no_iniciado", 0)
            .when(state == "finalizado", term)
            .otherwise(days_between(last_day, _TERM_START)),
            f"{into}dias_no_devengados": F.when(state == "no_iniciado", term)
            .when(state == "en_curso", days_left)
            .otherwise(0),
            f"{into}valor_devengo_diario": F.try_divide(C(_BASE), term),
        }
    )
    booked_now = C(_BOOKED).between(C(_PERIOD), C(_VALUED))
    recognised = counted.withColumns(
        {
            f"{into}control_suma_dias": done + left == term,
            f"{into}saldo": per_day * left,
            f"{into}valor_constitucion": F.when(booked_now, term * per_day).otherwise(0.0),
        }
    )
    if cfg.as_coded:
        release_start = F.when(C(_BOOKED) > C(_PERIOD), C(_TERM_START)).otherwise(C(_PERIOD))
    else:
        release_start = F.when(C(_BOOKED) >= C(_PERIOD), C(_TERM_START)).otherwise(
            F.greatest(_PERIOD, _TERM_START)
        )
    all_at_once = (state == "entra_devengado") & (C(f"{into}valor_constitucion") != 0)
    released = recognised.withColumn(
        f"{into}dias_liberacion",
        F.when(all_at_once, term)
        .when(state == "no_iniciado", 0)
        .when(C(_PERIOD) <= C(_END), days_between(last_day, release_start))
        .otherwise(0),
    )
    return released.withColumns(
        {
            f"{into}valor_liberacion": C(f"{into}dias_liberacion") * per_day,
            f"{into}valor_liberacion_acum": done * per_day,
        }
    )


# --- half/half rule ----------------------------------------------------------------------


def halves_amounts() -> dict[str, Column]:
    """Half in the month the term starts, half in the month it ends."""
    base, nothing = C(_BASE), F.lit(0.0)
    half = base * 0.5
    valued, first, last = yyyymm(_VALUED), yyyymm(_START), yyyymm(_END)
    one_month = first == last
    enters, over = C(_BOOKED) > C(_END), C(_VALUED) >= C(_END)
    booked_now = yyyymm(_BOOKED) == valued
    first_half_due = (valued == first) & ~one_month & is_month_end(_VALUED)
    accumulated = (
        F.when(over | enters, base)
        .when((valued == last) & one_month, nothing)
        .when((valued == last) | first_half_due, half)
        .otherwise(nothing)
    )
    return {
        "valor_constitucion": F.when(booked_now, base).otherwise(nothing),
        "valor_liberacion": F.when(enters, F.when(booked_now, base).otherwise(nothing))
        .when((valued == first) & one_month & over, base)
        .when(first_half_due, half)
        .when((valued == last) & over, half)
        .otherwise(nothing),
        "valor_liberacion_acum": accumulated,
        "saldo": F.when(C(_VALUED) < C(_START), base)
        .when(~over, base - accumulated)
        .otherwise(nothing),
        "mes_constitucion": yyyymm(_BOOKED),
        "mes_ini_liberacion": first,
        "mes_fin_liberacion": last,
    }


def halves_rule(df: DataFrame) -> DataFrame:
    return df.withColumns({"estado_devengo": accrual_state(), **halves_amounts()})


# --- investment component -----------------------------------------------------------------


def investment_amounts() -> dict[str, Column]:
    """Kept whole until the release date, then released at once."""
    base, nothing = C(_BASE), F.lit(0.0)
    over = C(_VALUED) >= C(_END)
    released = F.when(over, base).otherwise(nothing)
    booked = (yyyymm(_VALUED) == yyyymm(_BOOKED)) & (C(_VALUED) >= C(_BOOKED))
    ends_now = over & (yyyymm(_VALUED) == yyyymm(_END))
    return {
        "valor_constitucion": F.when(booked, base).otherwise(nothing),
        "valor_liberacion": F.when(ends_now, base).otherwise(nothing),
        "valor_liberacion_acum": released,
        "saldo": base - released,
        "mes_constitucion": yyyymm(_BOOKED),
    }


def investment_rule(df: DataFrame) -> DataFrame:
    return df.withColumns(investment_amounts())


# --- aggregate-limit rule ------------------------------------------------------------------


def carried_balance(input_columns: list[str], cfg: RunConfig) -> Column:
    """Balance brought into the month: the row's own, or its base when it has none.

    As coded, a null balance stays null as soon as the input has the column at all.
    """
    if "saldo_anterior" not in input_columns:
        return C(_BASE)
    if cfg.as_coded:
        return C("saldo_anterior")
    return F.coalesce("saldo_anterior", _BASE)


def limit_rule(
    daily: DataFrame, carried: Column | str, daily_prefix: str = "", into: str = ""
) -> DataFrame:
    """Larger of daily release and limit consumption; the last month releases what is left.

    ``daily`` holds the result of ``daily_rule`` under ``daily_prefix``.
    """
    carried = as_col(carried)
    by_day = C(f"{daily_prefix}valor_liberacion")
    used = F.try_divide(
        C("valor_siniestros_incurridos_mes") + C("valor_salvamentos_mes"),
        C("limite_agregado_valor_instalado"),
    )
    measured = daily.withColumn("porc_consumo_limite", used).withColumn(
        "valor_liberacion_limite", C(_BASE) * C("porc_consumo_limite")
    )
    by_limit, rule = C("valor_liberacion_limite"), C(f"{into}regla_devengo")
    chosen = measured.withColumn(
        f"{into}regla_devengo",
        F.when(yyyymm(_VALUED) == yyyymm(_END), "saldo_restante")
        .when(by_limit > by_day, "consumo_limite")
        .otherwise("diario"),
    ).withColumn(
        f"{into}valor_liberacion",
        F.when(rule == "saldo_restante", carried)
        .when(rule == "consumo_limite", by_limit)
        .otherwise(by_day),
    )
    released = C(f"{into}valor_liberacion")
    return chosen.withColumns(
        {
            f"{into}valor_liberacion_acum": (C(_BASE) - carried) + released,
            f"{into}saldo": carried - released,
        }
    )


# --- financed reserve ----------------------------------------------------------------------


def financing_rule(df: DataFrame, into: str = "") -> DataFrame:
    """Reserve of long terms at the locked-in rate, with interest and price index.

    The first and last node of the curve count only for the days in force. Amounts are absolute;
    state, movements and balances are prefixed with ``into``.
    """
    now, prev = C("mes_valoracion"), C("mes_valoracion_anterior")
    first, last = C("mes_inicio_vigencia"), C("mes_fin_vigencia")
    w_first, w_last = C("peso_nodo_ini"), C("peso_nodo_fin")
    running = (C(_START) <= C(_VALUED)) & (now <= last)
    zero = F.lit(0.0)

    def weight(month: Column) -> Column:
        return F.when(month == first, w_first).when(month == last, w_last).otherwise(1.0)

    def capitalised(month: Column, factor: str, forward: str) -> Column:
        """Accumulation factor; in the final month its node is cut to the days in force."""
        whole = C(factor) * C("ajuste_base_ini")
        tail = F.pow(1 + C(forward), w_last - 1)
        return F.when(month == last, whole * tail).otherwise(whole)

    weighted = df.withColumns(
        {
            f"{into}estado_devengo": F.when(C(_VALUED) < C(_START), "no_iniciado")
            .when(running, "en_curso")
            .otherwise("finalizado"),
            "peso_nodo_ini": C("dias_vig_ini") / C("dias_nodo_ini"),
            "peso_nodo_fin": C("dias_vig_fin") / C("dias_nodo_fin"),
        }
    )
    first_cut = C("desc_lir_nodo_ini") * (1 - w_first)
    last_cut = C("desc_lir_nodo_fin") * (1 - w_last)
    framed = weighted.withColumns(
        {
            "peso_nodo_actual": weight(now),
            "peso_nodo_anterior": weight(prev),
            "suma_factores_total": C("sum_desc_lir_nodo_fin") - first_cut - last_cut,
            "ajuste_base_ini": F.pow("fact_acum_ini", w_first - 1),
        }
    )
    total = C("suma_factores_total")
    price_start = F.pow(1 + C("tasa_ipc_ini"), w_first)
    nominal = (1 + C("tasa_fwd_real_val")) * (1 + C("tasa_ipc_actual"))
    factored = framed.withColumns(
        {
            "factor_cap_real": capitalised(now, "fact_acum_val", "tasa_fwd_real_val"),
            "factor_cap_real_ant": capitalised(prev, "fact_acum_ant", "tasa_fwd_real_ant"),
            "sum_desc_valoracion": F.when(now >= last, total).otherwise(
                C("sum_desc_lir_val") - first_cut
            ),
            "sum_desc_anterior": F.when(prev >= last, total)
            .when(prev < first, zero)
            .otherwise(C("sum_desc_lir_ant") - first_cut),
            "factor_ajuste_ipc": (C("indice_ipc_actual") / C("indice_ipc_ini")) * price_start,
            "factor_ajuste_ipc_ant": (C("indice_ipc_anterior") / C("indice_ipc_ini"))
            * price_start,
            "tasa_acreditacion": F.pow(nominal, C("peso_nodo_actual")) - 1,
        }
    )
    left = factored.withColumns(
        {
            "suma_factores_remanente_ant": total - C("sum_desc_anterior"),
            "suma_factores_remanente": total - C("sum_desc_valoracion"),
        }
    )

    def reserve(index: str, cap: str, remaining: str) -> Column:
        projected = C(_BASE) * C(index) * C(cap) * C(remaining)
        return F.when(running, F.abs(F.try_divide(projected, total))).otherwise(zero)

    before, after = C(f"{into}saldo_anterior"), C(f"{into}saldo")
    interest, booked = C(f"{into}acreditacion_intereses"), C(f"{into}valor_constitucion")
    balanced = left.withColumns(
        {
            f"{into}saldo_anterior": reserve(
                "factor_ajuste_ipc_ant", "factor_cap_real_ant", "suma_factores_remanente_ant"
            ),
            f"{into}saldo": reserve(
                "factor_ajuste_ipc", "factor_cap_real", "suma_factores_remanente"
            ),
            f"{into}valor_constitucion": F.when(now == first, F.abs(_BASE)).otherwise(zero),
        }
    )
    credited = balanced.withColumn(
        f"{into}acreditacion_intereses",
        F.when(running, F.abs(before * C("tasa_acreditacion"))).otherwise(zero),
    )
    released = F.abs(before + interest - after + booked)
    return credited.withColumns(
        {
            f"{into}valor_liberacion": F.when(running, released).otherwise(zero),
            f"{into}valor_liberacion_acum": F.lit(None).cast("double"),
        }
    )


# --- everything together -------------------------------------------------------------------


def apply_signs(df: DataFrame) -> DataFrame:
    """Sign of the reserve on every movement; a negative amount is a liability."""
    same = ["valor_constitucion", "saldo", "acreditacion_intereses"]
    opposite = ["valor_liberacion", "valor_liberacion_acum"]
    return df.withColumns(
        {
            **{c: F.expr(f"{c} * signo_constitucion") for c in same},
            **{c: F.expr(f"{c} * -1 * signo_constitucion") for c in opposite},
        }
    )


def with_previous_balance(df: DataFrame) -> DataFrame:
    """Balance before the month's movements, whatever the rule."""
    movements = ["saldo", "valor_constitucion", "valor_liberacion", "acreditacion_intereses"]
    known = [f"coalesce(nanvl({c}, 0D), 0D)" for c in movements]
    return df.withColumn("saldo_anterior", F.expr(" - ".join(known)))


def by_route(choices: dict[str, str]) -> Column:
    """Column of the row's route; null for routes without one."""
    cases = " ".join(f"WHEN '{route}' THEN {name}" for route, name in choices.items())
    return F.expr(f"CASE _ruta {cases} END")


def accrue(prepared: DataFrame, cfg: RunConfig) -> DataFrame:
    """Constitution, release and balance of every prepared row at the valuation date.

    The result always carries the same columns, whichever rules the input uses.
    """
    financed = "aplica_comp_financ" in prepared.columns
    carried = carried_balance(prepared.columns, cfg)
    optional = {**OPTIONAL_INPUT, **(FINANCING_INPUT if financed else {})}
    ready = ensure_columns(prepared, optional)
    routed = route_rows(with_rule_and_routes(with_period(ready, cfg), cfg), financed)
    ruled = limit_rule(daily_rule(routed, cfg, "_d_"), carried, "_d_", "_l_")
    if financed:
        ruled = financing_rule(ruled, "_f_")
    else:
        absent = {f"_f_{c}": t for c, t in FINANCING_RESULT.items()}
        ruled = ensure_columns(ruled, absent)

    ruled = ruled.withColumns(
        {
            **{f"_h_{c}": v for c, v in halves_amounts().items()},
            **{f"_i_{c}": v for c, v in investment_amounts().items()},
        }
    )
    prefixes = {DAILY: "_d_", HALVES: "_h_", LIMIT: "_l_", INVESTMENT: "_i_", FINANCED: "_f_"}

    def amount(c: str, routes: dict[str, str]) -> Column:
        return by_route({route: f"{prefix}{c}" for route, prefix in routes.items()})

    by_day = {DAILY: "_d_", LIMIT: "_d_"}
    picked = ruled.withColumns(
        {
            "valor_constitucion": amount("valor_constitucion", {**prefixes, LIMIT: "_d_"}),
            "valor_liberacion": amount("valor_liberacion", prefixes),
            "valor_liberacion_acum": amount("valor_liberacion_acum", prefixes),
            "saldo": amount("saldo", prefixes),
            "estado_devengo": amount(
                "estado_devengo", {**by_day, HALVES: "_d_", FINANCED: "_f_"}
            ),
            **{c: amount(c, by_day) for c in DAILY_TRACE},
            "regla_devengo": F.expr(
                f"CASE _ruta WHEN '{LIMIT}' THEN _l_regla_devengo ELSE regla_devengo END"
            ),
            "acreditacion_intereses": amount("acreditacion_intereses", {FINANCED: "_f_"}),
            "porc_consumo_limite": by_route({LIMIT: "porc_consumo_limite"}),
            "valor_liberacion_limite": by_route({LIMIT: "valor_liberacion_limite"}),
            "mes_constitucion": amount("mes_constitucion", {HALVES: "_h_", INVESTMENT: "_i_"}),
            "mes_ini_liberacion": amount("mes_ini_liberacion", {HALVES: "_h_"}),
            "mes_fin_liberacion": amount("mes_fin_liberacion", {HALVES: "_h_"}),
            **({c: by_route({FINANCED: c}) for c in FINANCING_TRACE} if financed else {}),
        }
    )
    private = [c for c in picked.columns if c.startswith(("_d_", "_h_", "_l_", "_i_", "_f_"))]
    signed = apply_signs(picked.drop(*private, "_ruta"))
    tagged = with_result_tags(with_previous_balance(signed), cfg.fecha_transicion)
    whole = ensure_columns(tagged, FINANCING_COLUMNS)
    own = [c for c in whole.columns if c not in OUTPUT_COLUMNS]
    return whole.select(*own, *OUTPUT_COLUMNS)
