"""Lookups, exchange rates, accounting and reconciliation on small hand-made tables."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F
from samples import exceptions, params, receipts

from remanente import RunConfig
from remanente.functions import schema
from remanente.operators import accounting, accrual, curves, fx, lookups, prep, reconcile
from remanente.operators.wildcard import best_rule


def test_one_receipt_key_repeated_many_times_keeps_one_row(spark):
    rows = spark.range(20000).selectExpr(
        "'produccion_directo' tipo_insumo", "'1' poliza", "date'2023-01-30' fecha_expedicion_poliza",
        "'1' recibo", "'D' amparo", "'1' poliza_certificado", "'01' compania", "'040' ramo_sura",
        "'s' canal", "concat('p', id % 7) producto", "'e' tipo_op", "'B' cdsubgarantia",
        "'7' numero_documento_sap", "double(id) valor_prima_emitida",
    )
    table = spark.createDataFrame(
        [("01", "040", "*", "*", "x", 0.1, "ifrs4_local", date(2023, 1, 1), date(2023, 12, 31)),
         ("01", "040", "s", "p3", "x", 0.2, "ifrs4_local", date(2023, 1, 1), date(2023, 12, 31))],
        "compania string, ramo_sura string, canal string, producto string, tipo_gasto string, "
        "porc_gasto double, tipo_contabilidad string, fecha_inicio date, fecha_fin date",
    )
    out = lookups.attach_expenses(rows, table)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert [(r["porc_gasto"], r["valor_prima_emitida"]) for r in out.collect()] == [(0.2, 3.0)]


def test_last_matching_exception_wins_and_absent_columns_are_ignored(spark):
    base = spark.createDataFrame(
        [("a", "040"), ("a", "083"), ("b", "040"), (None, "040")], "tipo_contabilidad string, ramo string"
    )
    rules = spark.createDataFrame(
        [(1, "a", "*", "*", 0), (2, "*", "040", "*", 1), (3, "b", "040", "*", 0), (4, "*", "*", "x", 0)],
        "orden int, tipo_contabilidad string, ramo string, otra string, candidato_devengo_50_50 int",
    )
    out = {tuple(r)[:2]: r["candidato_devengo_50_50"] for r in lookups.mark_fifty_fifty(base, rules).collect()}
    assert out == {("a", "040"): 1, ("a", "083"): 0, ("b", "040"): 0, (None, "040"): 1}


def test_rule_that_matches_everything_and_no_rules_at_all(spark):
    base = spark.createDataFrame([("a",), (None,)], "k string")
    rules = spark.createDataFrame([("*", 5)], "k string, v int")
    out = best_rule(base, rules, [], ["k"], F.struct("v"), "best")
    assert [r["best"]["v"] for r in out.collect()] == [5, 5]
    none = best_rule(base, rules.filter("v > 9"), [], ["k"], F.struct("v"), "best")
    assert [r["best"] for r in none.collect()] == [None, None]


def test_fewest_wildcards_win_and_every_row_stays_once(spark):
    base = spark.createDataFrame(
        [("s", "COP", "i", "01", "003", "p", "23"), ("s", "COP", "i", "01", "003", "q", "23"),
         ("s", "EUR", "i", "01", "003", "p", "23")],
        "tipo_contabilidad string, moneda string, tipo_insumo string, compania string, "
        "ramo_sura string, producto string, tipo_op string",
    )
    table = spark.createDataFrame(
        [("s", "COP", "*", "*", "003", "*", "*", 1, 0, "CO", "COP", 12),
         ("s", "COP", "*", "*", "003", "q", "*", 1, 1, "CO", "COP", 24),
         ("s", "COP", "*", "*", "*", "*", "*", 0, 0, None, None, None)],
        "tipo_contabilidad string, moneda string, tipo_insumo string, compania string, "
        "ramo_sura string, producto string, tipo_op string, aplica_comp_financ int, "
        "aplica_ipc_mensual int, pais_curva string, moneda_curva string, meses_max_vigencia int",
    )
    out = {
        (r["moneda"], r["producto"]): (r["aplica_comp_financ"], r["meses_max_vigencia"])
        for r in lookups.attach_financing_params(base, table).collect()
    }
    assert out == {("COP", "p"): (1, 12), ("COP", "q"): (1, 24), ("EUR", "p"): (0, None)}


RATES = [
    ("2024-12-31", 3900.0), ("2025-01-01", 3900.0), ("2025-01-15", 4050.0),
    ("2025-01-31", 4100.0), ("2025-02-01", 4100.0), ("2025-02-28", 4200.0), ("2025-03-01", 4200.0),
]


def _usd(spark, close):
    cfg = RunConfig(close)
    rows = [(0, "2025-01-15", "2025-01-01", "2025-12-31", "2025-01-01", "2025-12-31", "USD")]
    ready = prep.direct_premium(receipts(spark, rows), params(spark), exceptions(spark), cfg)
    rates = spark.createDataFrame(
        [(date.fromisoformat(d), "USD", "COP", r) for d, r in RATES],
        "fecha date, moneda_origen string, moneda_destino string, tasa_cambio double",
    )
    return fx.fx_fluctuation(accrual.accrue(ready, cfg), rates, cfg)


@pytest.mark.parametrize("close, change", [(date(2025, 1, 31), 50), (date(2025, 2, 28), 100)])
def test_fluctuation_is_balance_and_release_times_the_rate_change(spark, close, change):
    for r in _usd(spark, close).collect():
        assert r["fluctuacion_constitucion"] == pytest.approx(r["saldo"] * change)
        assert r["fluctuacion_liberacion"] == pytest.approx(-r["valor_liberacion"] * change)


def test_movements_in_local_currency_add_up_to_the_balance(spark):
    moves = accounting.to_movements(_usd(spark, date(2025, 1, 31)))
    sums = moves.groupBy("tipo_contabilidad").agg(
        F.sum(F.when(F.col("tipo_movimiento") != "saldo", F.col("valor_ml"))).alias("ml"),
        F.sum(F.when(F.col("tipo_movimiento") == "saldo", F.col("valor_md"))).alias("md"),
    )
    for r in sums.collect():
        assert r["ml"] == pytest.approx(r["md"] * 4100)


def test_onerous_mark_follows_the_sum_up_to_each_close(spark):
    policies = [("01", "040", p) for p in ("up", "down", "later", "other")]
    output = spark.createDataFrame(policies, "compania string, ramo_sura string, poliza string")
    june, july, august = date(2023, 6, 30), date(2023, 7, 15), date(2023, 8, 31)
    premiums = spark.createDataFrame(
        [("01", "040", p, d, v) for p, d, v in (
            ("up", june, -40.0), ("up", july, 55.5), ("down", june, 10.0), ("down", july, -10.0),
            ("later", august, 7.25), ("other", june, -1.0))],
        "compania string, ramo_sura string, poliza string, fecha_calculo_onerosidad date, "
        "valor_prima_emitida double",
    )

    def marked(close):
        out = accounting.mark_onerous(output, premiums, RunConfig(close)).collect()
        return {r["poliza"] for r in out if r["onerosidad"] == "OO"}

    assert [marked(d) for d in (june, date(2023, 7, 31), august)] == [{"down"}, {"up"}, {"up", "later"}]


def test_null_safe_join_matches_null_keys_and_keeps_both_sides(spark):
    left = spark.createDataFrame([("a", None, 1.0), ("b", "x", 2.0)], "k string, k2 string, v double")
    right = spark.createDataFrame([("a", None, 1.5), ("c", "y", 3.0)], "llave string, k2 string, v double")
    full = reconcile.null_safe_join(
        left, right, ["k", "k2", "v"], ["llave", "k2", "v"], ["v"], {"llave": "k"}, "_r"
    )
    got = {(r["k"], r["k2"]): (r["v"], r["v_r"]) for r in full.collect()}
    assert got == {("a", None): (1.0, 1.5), ("b", "x"): (2.0, 0.0), ("c", "y"): (0.0, 3.0)}


def test_duplicated_rows_are_counted_once_each(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "x")], "a int, b string")
    assert reconcile.count_duplicated(df).first()["duplicados"] == 2
    assert reconcile.count_duplicated(df.limit(0)).first()["duplicados"] == 0


def _curve(spark, nodes):
    table = spark.createDataFrame(
        [(20241130, "CO", "COP", m, 0.0) for m in range(1, nodes + 1)],
        "fecha_clave int, pais string, moneda string, mes int, tasa_interes double",
    )
    financing = spark.createDataFrame(
        [(1, "CO", "COP", 12)],
        "aplica_comp_financ int, pais_curva string, moneda_curva string, meses_max_vigencia int",
    )
    return table, financing


def test_incomplete_curve_fails_with_its_name(spark):
    table, financing = _curve(spark, 10)
    with pytest.raises(Exception, match="incomplete curve: 20241130 CO COP"):
        curves.curve_factors(table, financing).collect()
    assert curves.incomplete_curves(table, financing).count() == 1


def test_financing_without_interest_is_straight_line_by_months(spark):
    """No interest, no index, whole months: the balance is the share of months left."""
    table, financing = _curve(spark, 14)
    cfg = RunConfig(date(2025, 3, 31))
    rules = financing.selectExpr(
        "'s' tipo_contabilidad", "'COP' moneda", "'*' tipo_insumo", "'*' compania", "'*' ramo_sura",
        "'*' producto", "'*' tipo_op", "aplica_comp_financ", "0 aplica_ipc_mensual", "pais_curva",
        "moneda_curva", "meses_max_vigencia",
    )
    ready = spark.createDataFrame(
        [("s", "COP", "x", "01", "003", "p", "23", date(2024, 12, 1), date(2024, 12, 1),
          date(2024, 12, 1), date(2025, 11, 30), 1200.0, -1, "directo", date(2024, 12, 1), "prima")],
        "tipo_contabilidad string, moneda string, tipo_insumo string, compania string, "
        "ramo_sura string, producto string, tipo_op string, fecha_constitucion date, "
        "fecha_inicio_vigencia date, fecha_inicio_devengo date, fecha_fin_devengo date, "
        "valor_base_devengo double, signo_constitucion int, tipo_contrato string, "
        "fecha_expedicion_poliza date, componente string",
    )
    ipc = curves.price_index(
        spark.createDataFrame([(date(2024, 12, 1), 0.01)], "fecha date, tasa double")
    )
    factors = curves.curve_factors(table, financing)
    got = accrual.accrue(prep.with_financing(ready, rules, ipc, factors, cfg), cfg).first()
    assert got["saldo"] == pytest.approx(-1200 * 8 / 12)
    assert got["valor_liberacion"] == pytest.approx(100)
    assert got["acreditacion_intereses"] == pytest.approx(0)
    assert got["saldo_anterior"] == pytest.approx(-1200 * 9 / 12)


def test_alignment_widens_numbers_and_adds_typed_nulls(spark):
    a = spark.createDataFrame([(1, "x")], "n int, t string")
    b = spark.createDataFrame([(2.5, date(2025, 1, 1))], "n double, d date")
    out = schema.union_aligned([a, b])
    assert dict(out.dtypes) == {"n": "double", "t": "string", "d": "date"}
    assert sorted(r["n"] for r in out.collect()) == [1.0, 2.5]
    with pytest.raises(ValueError):
        schema.with_cohort(a)


def test_standard_names():
    assert schema.standard_name("Número - de póliza (*)") == "numero_de_poliza_"
