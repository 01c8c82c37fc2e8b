"""Files in and out, and a whole close written to tables."""

from __future__ import annotations

import os
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from remanente.config import RunConfig
from remanente.operators import accounting, lookups, prep, reconcile
from remanente.plans import close
from remanente.queries.accrual_queries import CLOSE_INPUTS
from remanente.queries.inputs import CFG, Inputs
from remanente.queries.prepare import raw_receipts
from remanente.queries.registry import total
from remanente.session import shared_folder
from remanente.sources import tables
from remanente.sources.publication import Staged, read_published
from remanente.sources.schemas import SCHEMAS

SF = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


@needs_data
def test_raw_receipts_are_read_by_line_with_the_filter_pushed_down(spark, tmp_path):
    raw_receipts(Inputs(spark, SF)).write.parquet(str(tmp_path / "raw"))
    read = tables.read_raw_receipts(spark, str(tmp_path / "raw"), "084")
    out = tables.receipts_from_raw(read)
    assert {r[0] for r in out.select("ramo_sura").distinct().collect()} == {"084"}
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(cdramo_contable,084)" in plan


def test_engine_files_are_cut_to_the_batch(spark, tmp_path):
    for part, rows in (("a", [("p1", "r1", 1)]), ("b", [("p1", "r9", 2), ("p2", "r1", 3)])):
        spark.createDataFrame(
            [(*r, "084") for r in rows], "poliza string, recibo string, dias_devengados int, ramo_sura string"
        ).write.parquet(str(tmp_path / f"084_{part}_202501.parquet"))
    batch = spark.createDataFrame([("p1", "r1"), ("p3", "r1")], "poliza string, recibo string")
    out = tables.read_engine_output(spark, str(tmp_path / "084_*202501.parquet"), batch, "084")
    assert [tuple(r) for r in out.select("poliza", "recibo", "dias_devengados").collect()] == [
        ("p1", "r1", 1.0)
    ]


def test_csv_catalogue_keeps_leading_zeros_and_reads_nan_as_null(spark, tmp_path):
    (tmp_path / "tipo_seguro").mkdir()
    (tmp_path / "tipo_seguro" / "t.csv").write_text("ramo,tipo_seguro_codigo\n003,01\n")
    (tmp_path / "inflacion").mkdir()
    (tmp_path / "inflacion" / "t.csv").write_text("fecha,tasa\n2025-01-01,NaN\n")
    read = tables.read_catalogue(spark, str(tmp_path), ["tipo_seguro", "inflacion"], "csv")
    assert tuple(read["tipo_seguro"].first()) == ("003", "01")
    assert tuple(read["inflacion"].first()) == (date(2025, 1, 1), None)


@needs_data
def test_whole_close_is_written_and_keeps_its_identities(spark):
    t = Inputs(spark, SF).only(*CLOSE_INPUTS)
    done = close.run_close(spark, t, CFG, f"{shared_folder(spark)}/cierre")
    accrued = spark.read.parquet(done.accrual_path)
    assert done.counts["filas_devengo"] == accrued.count()
    assert done.counts["dias_sin_cuadrar"] == done.counts["sin_moneda"] == 0
    assert accrued.filter("control_suma_dias = false").count() == 0
    off = accrued.filter(
        "abs(saldo - (coalesce(saldo_anterior, 0) + coalesce(valor_constitucion, 0) "
        "+ coalesce(valor_liberacion, 0) + coalesce(acreditacion_intereses, 0))) > 1e-6"
    )
    assert off.count() == 0
    booked = spark.read.parquet(done.accounting_path)
    assert done.counts["filas_contables"] == booked.count() > done.counts["con_bt"] > 0
    assert booked.filter("onerosidad IS NULL").count() == 0
    kinds = {r[0] for r in booked.select("tipo_movimiento").distinct().collect()}
    assert set(accounting.MOVIMIENTOS) - kinds <= {"acreditacion_intereses"}


def test_policies_may_be_numbers_or_texts(spark, tmp_path):
    for kind, values in (("long", [12]), ("string", ["012"]), ("double", [12.0])):
        folder = tmp_path / kind
        spark.createDataFrame([(v,) for v in values], f"poliza {kind}").write.parquet(
            str(folder / "produccion_directo")
        )
        read = tables.read_catalogue(spark, str(folder), ["produccion_directo"])
        policy = read["produccion_directo"].first()["poliza"]
        assert policy == ("012" if kind == "string" else "12")


def test_rule_tables_keep_any_column_and_others_refuse_them(spark, tmp_path):
    rule = "1 AS orden, '*' AS tipo_insumo, '*' AS tipo_contabilidad, '*' AS ramo_sura, "
    rule += "'verano' AS campania, 0 AS candidato_devengo_50_50"
    spark.sql(f"SELECT {rule}").write.parquet(str(tmp_path / "excepciones_50_50"))
    spark.sql("SELECT DATE'2025-01-01' AS fecha, 0.1D AS tasa, 1 AS otra").write.parquet(
        str(tmp_path / "inflacion")
    )
    rules = tables.read_catalogue(spark, str(tmp_path), ["excepciones_50_50"])["excepciones_50_50"]
    base = spark.sql("SELECT 'a' AS tipo_insumo, 'b' AS tipo_contabilidad, '040' AS ramo_sura")
    assert lookups.mark_fifty_fifty(base, rules).first()["candidato_devengo_50_50"] == 1
    in_summer = base.selectExpr("*", "'verano' AS campania")
    assert lookups.mark_fifty_fifty(in_summer, rules).first()["candidato_devengo_50_50"] == 0
    with pytest.raises(ValueError, match="otra"):
        tables.read_catalogue(spark, str(tmp_path), ["inflacion"])


def test_workers_compensation_tables_have_schemas():
    assert {"costo_contrato_arl", "cuenta_corriente_arl"} <= set(SCHEMAS)


@pytest.mark.parametrize("mode", ["documentado", "codigo"])
def test_contract_base_by_row(spark, mode):
    cfg = RunConfig(date(2025, 2, 28), modo=mode)
    df = spark.createDataFrame(
        [(100.0, 5.0, None), (100.0, 5.0, 70.0)],
        "valor_costo_contrato double, valor_reinstalamento double, saldo_anterior double",
    ).selectExpr(
        "*",
        "'recibo' AS nivel_detalle",
        "DATE'2025-01-10' AS fecha_inicio_vigencia_recibo",
        "DATE'2025-01-15' AS fecha_inicio_vigencia_cobertura",
    )
    first = F.col("valor_costo_contrato") + F.col("valor_reinstalamento")
    amount, start = prep._contract_base(df, None, first, cfg)
    rows = df.select(amount.alias("base"), start.alias("inicio")).collect()
    carried = (70.0, date(2025, 2, 1))
    fresh = (105.0, date(2025, 1, 10)) if mode == "documentado" else (None, date(2025, 2, 1))
    assert {tuple(r) for r in rows} == {carried, fresh}


def test_a_close_without_rows_replaces_its_day_and_keeps_its_columns(spark, tmp_path):
    folder, day, old = str(tmp_path / "salida"), date(2025, 2, 28), date(2025, 1, 31)

    def publish(when, rows):
        staged = Staged(spark, folder, when)
        staged.write("a", rows)
        staged.publish()

    publish(old, spark.sql("SELECT 1 AS a"))
    now = spark.sql("SELECT 1 AS a, 2 AS b")
    publish(day, now)
    read = read_published(spark, folder, "a", day)
    assert set(read.columns) == {"fecha_valoracion", "a", "b"} and read.first()["b"] == 2
    publish(day, now.limit(0))
    assert read_published(spark, folder, "a", day).count() == 0
    assert read_published(spark, folder, "a", old).count() == 1


def test_reconciliation_keys_of_different_types(spark):
    left = spark.sql("SELECT 1 AS k, '7' AS p, DATE'2025-01-01' AS d, 5.0D AS v")
    for row in (
        "1L AS k, 7 AS p, DATE'2025-01-01' AS d, 5.0D AS v",
        "'1' AS k, 7L AS p, '2025-01-01' AS d, 5.0D AS v",
        "1S AS k, '7' AS p, TIMESTAMP'2025-01-01 00:00:00' AS d, 5.0D AS v",
        "1.0D AS k, '7' AS p, DATE'2025-01-01' AS d, 5.0D AS v",
    ):
        columns = ["k", "p", "d", "v"]
        both = reconcile.null_safe_join(
            left, spark.sql(f"SELECT {row}"), columns, columns, ["v"], {}
        )
        assert [(r["v"], r["v_right"]) for r in both.collect()] == [(5.0, 5.0)]
    with pytest.raises(TypeError, match="key k"):
        wrong = spark.sql("SELECT true AS k, '7' AS p, DATE'2025-01-01' AS d, 5.0D AS v")
        reconcile.null_safe_join(left, wrong, columns, columns, ["v"], {})


def test_sums_are_the_plain_decimal_sums(spark):
    rows = spark.range(1_000_000).select(((F.col("id") * 7919 % 100_003) / 1e5).alias("x"))
    plain = sum(Decimal(i * 7919 % 100_003) for i in range(1_000_000)) / 100_000
    got = rows.agg(*[total("x", d).alias(f"s{d}") for d in (1, 4)]).first()
    assert abs(Decimal(got["s4"]) - plain) < Decimal("0.0001")
    assert abs(Decimal(got["s1"]) - plain) <= Decimal("0.051")
