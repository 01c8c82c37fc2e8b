"""Hand-computed accruals: base 1200, liability sign, direct premium in local currency."""

from __future__ import annotations

from datetime import date

import pytest
from samples import day, exceptions, params, receipts

from remanente import RunConfig
from remanente.config import AS_CODED, DOCUMENTED
from remanente.operators import accrual, prep

D = 1200 / 365
HALF, SHORT, DAILY = "mensual_devengo_50_50", "mensual_devengo_diario", "diario"

# close | booked | start | end | state | accrued, open days | constitution, release, accumulated,
# balance | rule
CASES = [
    # issued before the term
    ("2024-11-30", "2024-11-15", "2025-01-01", "2025-12-31", "no_iniciado", 0, 365, -1200, 0, 0, -1200, DAILY),
    ("2024-12-31", "2024-11-15", "2025-01-01", "2025-12-31", "no_iniciado", 0, 365, 0, 0, 0, -1200, DAILY),
    ("2025-06-30", "2024-11-15", "2025-01-01", "2025-12-31", "en_curso", 181, 184, 0, 30 * D, 181 * D, -184 * D, DAILY),
    ("2026-01-31", "2024-11-15", "2025-01-01", "2025-12-31", "finalizado", 365, 0, 0, 0, 1200, 0, DAILY),
    ("2024-10-31", "2024-10-04", "2025-01-10", "2025-02-10", "no_iniciado", None, None, -1200, 0, 0, -1200, HALF),
    ("2024-11-30", "2024-10-04", "2025-01-15", "2025-02-15", "no_iniciado", None, None, 0, 0, 0, -1200, HALF),
    ("2025-01-31", "2024-10-04", "2025-01-15", "2025-02-15", "en_curso", None, None, 0, 600, 600, -600, HALF),
    ("2025-02-28", "2024-10-04", "2025-01-15", "2025-02-15", "finalizado", None, None, 0, 600, 1200, 0, HALF),
    ("2025-03-31", "2024-10-04", "2025-01-15", "2025-02-15", "finalizado", None, None, 0, 0, 1200, 0, HALF),
    # issued within the term
    ("2025-05-31", "2025-05-10", "2025-01-01", "2025-12-31", "en_curso", 151, 214, -1200, 151 * D, 151 * D, -214 * D, DAILY),
    ("2025-06-30", "2025-05-10", "2025-01-01", "2025-12-31", "en_curso", 181, 184, 0, 30 * D, 181 * D, -184 * D, DAILY),
    ("2025-12-15", "2025-05-10", "2025-01-01", "2025-12-31", "en_curso", 349, 16, 0, 15 * D, 349 * D, -16 * D, DAILY),
    ("2025-12-31", "2025-05-10", "2025-01-01", "2025-12-31", "finalizado", 365, 0, 0, 31 * D, 1200, 0, DAILY),
    ("2026-12-15", "2025-05-10", "2025-01-01", "2025-12-31", "finalizado", 365, 0, 0, 0, 1200, 0, DAILY),
    ("2024-10-31", "2024-10-04", "2024-10-08", "2024-11-08", "en_curso", None, None, -1200, 600, 600, -600, HALF),
    ("2024-11-30", "2024-11-04", "2024-10-10", "2024-11-10", "finalizado", None, None, -1200, 1200, 1200, 0, HALF),
    # issued after the term
    ("2026-01-31", "2026-01-31", "2025-01-01", "2025-12-31", "entra_devengado", 365, 0, -1200, 1200, 1200, 0, DAILY),
    ("2026-02-28", "2026-01-31", "2025-01-01", "2025-12-31", "entra_devengado", 365, 0, 0, 0, 1200, 0, DAILY),
    ("2025-01-31", "2025-01-09", "2025-01-16", "2025-01-22", "finalizado", 7, 0, -1200, 1200, 1200, 0, SHORT),
    ("2025-01-31", "2025-01-21", "2025-01-11", "2025-02-05", "en_curso", None, None, -1200, 600, 600, -600, HALF),
    ("2025-03-31", "2025-03-22", "2025-01-31", "2025-03-01", "entra_devengado", 30, 0, -1200, 1200, 1200, 0, SHORT),
    ("2025-04-30", "2025-03-22", "2025-01-31", "2025-03-01", "entra_devengado", 30, 0, 0, 0, 1200, 0, SHORT),
    ("2025-01-31", "2025-01-14", "2024-09-02", "2024-09-06", "entra_devengado", 5, 0, -1200, 1200, 1200, 0, SHORT),
    ("2025-02-28", "2025-01-14", "2024-09-02", "2024-09-06", "entra_devengado", 5, 0, 0, 0, 1200, 0, SHORT),
]


def _accrued(spark, close, rows, mode, rules=None):
    cfg = RunConfig(day(close), modo=mode)
    ready = prep.direct_premium(
        receipts(spark, rows), params(spark), rules or exceptions(spark), cfg
    )
    return accrual.accrue(ready, cfg)


@pytest.mark.parametrize("mode", [DOCUMENTED, AS_CODED])
def test_hand_computed_accruals(spark, mode):
    closes = sorted({c[0] for c in CASES})
    for close in closes:
        rows = [
            (i, c[1], c[2], c[3], c[2], c[3], "COP") for i, c in enumerate(CASES) if c[0] == close
        ]
        out = {
            r["id"]: r
            for r in _accrued(spark, close, rows, mode)
            .filter("tipo_contabilidad = 'ifrs4_local'")
            .collect()
        }
        for i, case in enumerate(CASES):
            if case[0] != close:
                continue
            got = out[i]
            _, _, _, _, state, done, left, booked, released, total, balance, rule = case
            assert (got["estado_devengo"], got["regla_devengo"]) == (state, rule), case
            assert (got["dias_devengados"], got["dias_no_devengados"]) == (done, left), case
            assert [
                got["valor_constitucion"],
                got["valor_liberacion"],
                got["valor_liberacion_acum"],
                got["saldo"],
            ] == pytest.approx([booked, released, total, balance]), case
            assert got["control_suma_dias"] in (True, None)


def test_not_yet_booked_gives_no_rows(spark):
    for close in ("2024-12-31", "2025-03-31"):
        rows = [(0, "2025-05-31", "2025-01-01", "2025-12-31", "2025-01-01", "2025-12-31", "COP")]
        assert _accrued(spark, close, rows, DOCUMENTED).count() == 0


def test_flag_off_uses_daily_rule(spark):
    rules = spark.createDataFrame(
        [(1, "*", 0)], "orden int, tipo_contabilidad string, candidato_devengo_50_50 int"
    )
    rows = [(0, "2025-01-09", "2025-01-16", "2025-01-22", "2025-01-16", "2025-01-22", "COP")]
    got = _accrued(spark, "2025-01-31", rows, DOCUMENTED, rules).first()
    assert got["regla_devengo"] == "diario"
    assert got["valor_liberacion"] == pytest.approx(1200)


INVESTMENT = [
    # policy, close, cancelled, policy end, booked, operation, base, constitution, release,
    # accumulated, balance, release date
    ("a", "2026-01-31", None, "2026-10-01", "2025-11-05", "23", 8649, 0, 0, 0, -8649, "2026-10-01"),
    ("a", "2026-01-31", None, "2026-10-01", "2026-01-05", "23", 8649, -8649, 0, 0, -8649, "2026-10-01"),
    ("b", "2025-12-31", "2025-11-15", "2026-05-15", "2025-11-06", "23", 12109, 0, 0, 0, -12109, "2026-05-15"),
    ("b", "2025-12-31", "2025-11-15", "2026-05-15", "2025-12-24", "23", 12109, -12109, 0, 0, -12109, "2026-05-15"),
    ("c", "2024-07-31", "2024-07-16", "2025-06-11", "2024-06-11", "23", 17298, 0, 17298, 17298, 0, "2024-07-17"),
    ("c", "2024-07-31", "2024-07-16", "2025-06-11", "2024-07-06", "23", 17298, -17298, 17298, 17298, 0, "2024-07-17"),
    ("c", "2024-07-31", "2024-07-16", "2025-06-11", "2024-07-17", "26", -14508, 14508, -14508, -14508, 0, "2024-07-17"),
]


def test_investment_component(spark):
    kind = "componente_inversion_directo"
    for policy in "abc":
        cases = [c for c in INVESTMENT if c[0] == policy]
        rows = [
            (i, kind, "directo", policy, "02", "081", c[5], "COP", day(c[2]), date(2024, 1, 1),
             day(c[4]), date(2024, 1, 1), day(c[3]), float(c[6]))
            for i, c in enumerate(cases)
        ]
        df = spark.createDataFrame(
            rows,
            "id int, tipo_insumo string, tipo_negocio string, poliza string, compania string, "
            "ramo_sura string, tipo_op string, moneda string, fecha_cancelacion_poliza date, "
            "fecha_expedicion_poliza date, fecha_contabilizacion_recibo date, "
            "fecha_inicio_vigencia_poliza date, fecha_fin_vigencia_poliza date, "
            "valor_prima_emitida double",
        )
        cfg = RunConfig(day(cases[0][1]))
        out = accrual.accrue(prep.investment_component(df, params(spark, kind), cfg), cfg)
        for got in out.collect():
            want = cases[got["id"]]
            assert [
                got["valor_constitucion"],
                got["valor_liberacion"],
                got["valor_liberacion_acum"],
                got["saldo"],
            ] == pytest.approx(list(want[7:11])), want
            assert got["fecha_fin_devengo"] == day(want[11])
            assert got["regla_devengo"] == "componente_inversion"


def test_releases_add_up_to_the_base_and_balances_roll(spark):
    """Closing every month of a term releases exactly the base, whatever the booking pattern."""
    rows = [
        (0, "2025-01-01", "2025-01-10", "2025-04-20", "2025-01-10", "2025-04-20", "COP"),
        (1, "2024-12-05", "2025-01-10", "2025-04-20", "2025-01-10", "2025-04-20", "COP"),
        (2, "2025-02-01", "2025-01-10", "2025-04-20", "2025-01-10", "2025-04-20", "COP"),
        (3, "2025-03-17", "2025-01-10", "2025-04-20", "2025-01-10", "2025-04-20", "COP"),
        (4, "2025-06-02", "2025-01-10", "2025-04-20", "2025-01-10", "2025-04-20", "COP"),
        (5, "2025-01-03", "2025-01-20", "2025-02-15", "2025-01-20", "2025-02-15", "COP"),
    ]
    closes = ["2024-12-31", "2025-01-31", "2025-02-28", "2025-03-31", "2025-04-30", "2025-05-31",
              "2025-06-30"]
    released, balance = {}, {}
    for close in closes:
        for r in _accrued(spark, close, rows, DOCUMENTED).collect():
            key = (r["id"], r["tipo_contabilidad"])
            released[key] = released.get(key, 0) + r["valor_liberacion"]
            assert r["saldo_anterior"] == pytest.approx(balance.get(key, 0), abs=1e-9), (key, close)
            balance[key] = r["saldo"]
    assert all(v == pytest.approx(1200) for v in released.values())
    assert all(v == pytest.approx(0, abs=1e-9) for v in balance.values())


def test_financed_rows_may_take_two_routes(spark):
    cfg = RunConfig(date(2025, 1, 31))
    rows = [("componente_inversion_directo", 1), ("costo_contrato_rea_noprop", 1), ("x", 1), ("x", 0)]
    df = spark.createDataFrame(
        [(t, f, date(2025, 1, 1), date(2025, 1, 1), date(2025, 1, 1), date(2025, 12, 31), 10.0, 1,
          date(2025, 1, 1), "directo") for t, f in rows],
        "tipo_insumo string, aplica_comp_financ int, fecha_constitucion date, "
        "fecha_inicio_vigencia date, fecha_inicio_devengo date, fecha_fin_devengo date, "
        "valor_base_devengo double, signo_constitucion int, fecha_expedicion_poliza date, "
        "tipo_contrato string",
    ).selectExpr("*", "'ifrs17_local' AS tipo_contabilidad", "'prima' AS componente")
    out = accrual.accrue(df, cfg)
    assert out.count() == 6


def test_null_flag_rows_are_kept_unless_as_coded(spark):
    df = spark.createDataFrame(
        [("onerosidad", None, date(2025, 1, 20), date(2025, 2, 5)),
         ("onerosidad", None, date(2025, 1, 2), date(2025, 1, 20))],
        "tipo_insumo string, candidato_devengo_50_50 int, s date, e date",
    ).selectExpr(
        "tipo_insumo", "candidato_devengo_50_50", "s AS fecha_constitucion",
        "s AS fecha_inicio_vigencia", "s AS fecha_inicio_devengo", "e AS fecha_fin_devengo",
        "100D AS valor_base_devengo", "-1 AS signo_constitucion", "s AS fecha_expedicion_poliza",
        "'directo' AS tipo_contrato", "'prima' AS componente", "'ifrs4_local' AS tipo_contabilidad",
    )
    close = date(2025, 1, 31)
    kept = accrual.accrue(df, RunConfig(close))
    assert [r["regla_devengo"] for r in kept.collect()] == ["diario", "diario"]
    assert accrual.accrue(df, RunConfig(close, modo=AS_CODED)).count() == 1


def test_empty_input_keeps_the_columns(spark):
    rows = [(0, "2025-05-31", "2025-01-01", "2025-12-31", "2025-01-01", "2025-12-31", "COP")]
    out = _accrued(spark, "2024-12-31", rows, DOCUMENTED)
    assert out.columns[-len(accrual.OUTPUT_COLUMNS):] == accrual.OUTPUT_COLUMNS
