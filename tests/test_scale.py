"""What reaches a shuffle, and rows of shared keys against a look at every row."""

from __future__ import annotations

import random
import re
from datetime import date, timedelta

from pyspark.sql import functions as F

from remanente.operators import lookups, reconcile
from remanente.queries import prepare
from remanente.sources import tables

DAY = date(2024, 1, 1)
RATE = (
    "compania string, ramo_sura string, canal string, producto string, tipo_gasto string, porc_gasto double, "
    "tipo_contabilidad string, fecha_inicio date, fecha_fin date"
)
RECEIPT = (
    "numero_documento_sap string, tipo_op string, tipo_insumo string, poliza string, "
    "poliza_certificado string, recibo string, amparo string, cdsubgarantia string, compania string, "
    "ramo_sura string, canal string, producto string, fecha_expedicion_poliza date, valor_prima_emitida double"
)


def _rates(spark, draw):
    rows = []
    for _ in range(60):
        start = draw.choice([None, *range(0, 100)])
        rows.append(
            (draw.choice(["01", None]), "040", draw.choice(["a", "b", "*"]), draw.choice(["p", "q", "*"]),
             draw.choice(["x", "y", None]), draw.randint(1, 9) / 10, draw.choice(["s", "t"]),
             None if start is None else DAY + timedelta(start),
             None if start is None else DAY + timedelta(start + draw.randint(-3, 40)))
        )
    return spark.createDataFrame(rows, RATE)


def _receipts(spark, draw):
    """Half of the receipts share their key with others; some keys are null."""
    rows = [
        (draw.choice(["7", None]), "e", "i", "1", "1", f"r{k}" if k < 60 else draw.choice(["s", "t", None]),
         "A", "1", "01", "040", draw.choice(["a", "c", None]), draw.choice(["p", "r", None]),
         draw.choice([None, *[DAY + timedelta(d) for d in range(-2, 120, 7)]]), float(k))
        for k in range(120)
    ]
    return spark.createDataFrame(rows, RECEIPT)


def _dealt_out(df):
    """How often the receipts are dealt out by their key, and whether rows are multiplied before."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].splitlines()
    dealt = [k for k, line in enumerate(plan) if "- Exchange" in line and "REPARTITION_BY_COL" in line]
    below = [
        line for k in dealt for line in plan[k + 1 :]
        if line.find("- ") > plan[k].find("- Exchange") and "Generate explode" in line
    ]
    return len(dealt), len(below)


def test_receipts_are_dealt_out_once_and_before_they_are_multiplied(spark):
    draw = random.Random(5)
    assert _dealt_out(lookups.attach_expenses(_receipts(spark, draw), _rates(spark, draw))) == (1, 0)


def test_best_expense_of_shared_and_null_keys_is_that_of_all_candidates(spark):
    draw = random.Random(6)
    receipts, rates = _receipts(spark, draw), _rates(spark, draw)
    keys = [*lookups.EXPENSE_RECEIPT_KEYS, "tipo_gasto", "tipo_contabilidad"]
    want: dict = {}
    candidates = lookups.expense_candidates(receipts, rates.withColumn("_inicio", F.col("fecha_inicio")))
    starts = {}
    for r in rates.collect():
        starts.setdefault((r.canal, r.producto, r.tipo_gasto, r.tipo_contabilidad, r.porc_gasto), []).append(r)
    for r in candidates.collect():
        begun = max(
            (x.fecha_inicio for k, xs in starts.items() for x in xs
             if k[2:] == (r.tipo_gasto, r.tipo_contabilidad, r.porc_gasto)
             and x.canal in ("*", r.canal) and x.producto in ("*", r.producto)
             and x.fecha_inicio and x.fecha_inicio <= r.fecha_expedicion_poliza <= x.fecha_fin
             and ({(True, True): 3, (False, True): 2, (False, False): 1}.get(
                 (x.canal == "*", x.producto == "*")) == r.prioridad_match)),
        )
        rank = (r.prioridad_match or 9, -begun.toordinal(), r.porc_gasto)
        own = tuple(r[k] for k in keys)
        want[own] = min(want.get(own, rank), rank)
    got = {
        tuple(r[k] for k in keys): (r.prioridad_match or 9, r.porc_gasto)
        for r in lookups.attach_expenses(receipts, rates).collect()
    }
    assert got == {k: (v[0], v[2]) for k, v in want.items()}


def test_matching_rates_are_counted_without_making_them(spark):
    draw = random.Random(7)
    receipts, rates = _receipts(spark, draw), _rates(spark, draw)
    group = [*lookups.EXPENSE_RECEIPT_KEYS, "tipo_gasto"]
    want = lookups.expense_candidates(receipts, rates).groupBy(*group).count()
    found = lookups.expense_matches(receipts, rates)
    assert sorted(map(str, found.select(*group, "rows_in_partition").collect())) == sorted(
        str(r) for r in want.withColumnRenamed("count", "rows_in_partition").collect()
    )
    assert _dealt_out(found)[0] == 1


KEYED = "a string, b string, c double, d date, e int, v double"


def _sides(spark, draw):
    def row():
        return (
            draw.choice(["", "x", "1:x", None]), draw.choice(["", "x", "-", None]),
            draw.choice([0.0, -0.0, float("nan"), None]), draw.choice([DAY, None]),
            draw.choice([1, 11, None]), draw.choice([1.0, 2.0]),
        )

    return [spark.createDataFrame([row() for _ in range(150)], KEYED) for _ in range(2)]


def test_sides_meet_by_what_each_key_holds(spark):
    ours, theirs = _sides(spark, random.Random(9))
    columns = ["a", "b", "c", "d", "e", "v"]
    for how in ("left", "full"):
        got = reconcile.null_safe_join(ours, theirs, columns, columns, ["v"], {}, "_r", how)
        plain = ours.alias("o").join(
            theirs.alias("t"),
            [F.col(f"o.{c}").eqNullSafe(F.col(f"t.{c}")) for c in columns[:-1]],
            how,
        )
        keys = [F.coalesce(f"o.{c}", f"t.{c}").alias(c) for c in columns[:-1]]
        want = plain.select(*keys, F.col("o.v").alias("v"), F.col("t.v").alias("v_r")).fillna(0)
        assert sorted(map(str, got.select(want.columns).collect())) == sorted(map(str, want.collect()))


def test_only_what_is_asked_for_is_shuffled_to_compare(spark):
    ours, theirs = _sides(spark, random.Random(10))
    columns = ["a", "b", "c", "d", "e", "v"]
    joined = reconcile.null_safe_join(ours, theirs, columns, columns, ["v"], {}, "_r", "left")
    plan = joined.select("v", "v_r")._jdf.queryExecution().optimizedPlan().toString()
    shuffled = [line.split("xxhash64")[0] for line in plan.splitlines() if "xxhash64" in line]
    assert len(shuffled) == 2
    assert {name for line in shuffled for name in re.findall(r"(\w+)#", line)} <= {"v", "v_r"}


def test_repeated_rows_are_told_from_rows_with_the_same_letters(spark):
    ours, _ = _sides(spark, random.Random(11))
    plain = ours.groupBy(*ours.columns).count().filter("count > 1").agg(F.sum("count")).first()[0]
    counted = reconcile.count_duplicated(ours)
    assert counted.first()["duplicados"] == plain
    assert "Join" not in counted._jdf.queryExecution().optimizedPlan().toString()


def test_a_table_written_as_text_is_small_and_read_back_whole(spark, tmp_path):
    known = spark.range(20000).select(
        F.lit("040").alias("ramo"), F.concat(F.lit("tipo "), F.col("id") % 3).alias("tipo_seguro_codigo")
    )
    prepare.write_text(known, str(tmp_path / "t"))
    assert sum(f.stat().st_size for f in (tmp_path / "t").glob("part-*")) < 20000
    read = tables.read_quarantined(spark, "tipo_seguro", str(tmp_path / "t"), "csv")
    assert read.accepted.count() == 20000 and read.rejected.count() == 0
