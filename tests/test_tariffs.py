"""Rate intervals, dictionaries and wildcard rules against plain Python."""

from __future__ import annotations

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from remanente.operators import accounting, dictionary, lookups, quality
from remanente.operators.wildcard import best_rule

DAY = date(2024, 1, 1)
RATE = (
    "compania string, ramo_sura string, canal string, producto string, tipo_gasto string, "
    "porc_gasto double, tipo_contabilidad string, fecha_inicio date, fecha_fin date"
)
RECEIPT = (
    "numero_documento_sap string, tipo_op string, tipo_insumo string, poliza string, "
    "poliza_certificado string, recibo string, amparo string, cdsubgarantia string, compania string, "
    "ramo_sura string, canal string, producto string, fecha_expedicion_poliza date"
)


def drawn_rates(draw: random.Random) -> list[tuple]:
    out = []
    for _ in range(120):
        start = DAY + timedelta(draw.randrange(60))
        end = start + timedelta(draw.choice([-1, 0, 1, 7, 30, 400]))
        out.append(
            ("01", draw.choice(["040", "083"]), draw.choice("ab*"), draw.choice("pq*"),
             draw.choice(["x", "y"]), draw.randrange(1, 9) / 8, draw.choice(["s", "t"]), start, end)
        )
    return [*out, ("01", "040", "*", "*", "x", 0.5, "s", None, DAY)]


def best(rates: list[tuple], receipt: dict) -> dict:
    """(type, standard) -> (rank or None, rate), by looking at every rate."""
    found: dict = {}
    for company, line, channel, product, kind, rate, standard, start, end in rates:
        day = receipt["dia"]
        fits = (
            (company, line) == ("01", receipt["ramo"])
            and channel in ("*", receipt["canal"])
            and product in ("*", receipt["producto"])
            and None not in (start, day)
            and start <= day <= end
        )
        if fits:
            rank = {(True, True): 3, (True, False): 9, (False, True): 2, (False, False): 1}[
                channel == "*", product == "*"
            ]
            own = (rank, -(start - DAY).days, rate)
            found[kind, standard] = min(found.get((kind, standard), own), own)
    return {k: (None if v[0] == 9 else v[0], v[2]) for k, v in found.items()}


def test_best_rates_equal_a_look_at_every_rate(spark):
    draw = random.Random(8)
    rates = drawn_rates(draw)
    receipts = [
        {"ramo": draw.choice(["040", "083", "092"]), "canal": draw.choice(["a", "b", "c", None]),
         "producto": draw.choice(["p", "q", "r", None]),
         "dia": draw.choice([None, *[DAY + timedelta(k) for k in range(-2, 110)]])}
        for _ in range(200)
    ]
    rows = [
        (str(k), "e", "i", "1", "1", str(k), "A", "1", "01", r["ramo"], r["canal"], r["producto"], r["dia"])
        for k, r in enumerate(receipts)
    ]
    out = lookups.attach_expenses(
        spark.createDataFrame(rows, RECEIPT), spark.createDataFrame(rates, RATE)
    ).collect()
    got: dict = {}
    for r in out:
        own = got.setdefault(int(r.recibo), {})
        assert (r.tipo_gasto, r.tipo_contabilidad) not in own
        own[r.tipo_gasto, r.tipo_contabilidad] = (r.prioridad_match, r.porc_gasto)
    for k, receipt in enumerate(receipts):
        assert got.get(k, {}) == best(rates, receipt), receipt


def test_no_rates_and_no_receipts(spark):
    none = spark.createDataFrame([], RATE)
    one = spark.createDataFrame([(*"123456789", "040", "a", "p", DAY)], RECEIPT)
    assert lookups.attach_expenses(one, none).collect() == []
    assert lookups.attach_expenses(one.limit(0), none).collect() == []


def test_dictionary_finds_each_key_once(spark):
    rows = spark.range(5000).select(F.col("id").cast("string").alias("a"), (F.col("id") * 2).alias("v"))
    table = dictionary.dictionary(rows, dictionary.key(F.col("a")), F.col("v"), "it")
    asked = spark.createDataFrame([("7",), ("4999",), ("5000",), (None,)], "a string")
    out = dictionary.look_up(asked, table, {"found": dictionary.key(F.col("a"))})
    assert [r.found for r in out.collect()] == [14, 9998, None, None]


def test_dictionary_that_is_too_large_is_refused(spark, monkeypatch):
    monkeypatch.setattr(dictionary, "MOST_ENTRIES", 3)
    rows = spark.range(4).select(F.col("id").cast("string").alias("a"))
    table = dictionary.dictionary(rows, F.col("a"), F.col("a"), "the table")
    with pytest.raises(Exception, match="the table has more than 3"):
        dictionary.look_up(rows, table, {"found": F.col("a")}).collect()


def test_rules_equal_a_look_at_every_rule(spark):
    draw = random.Random(3)
    columns = ["e", "a", "b", "c"]
    rules = [
        (draw.choice("xy"), *[draw.choice("12*") for _ in range(3)], k) for k in range(25)
    ]
    base = [tuple(draw.choice([*"xyz", None]) if i == 0 else draw.choice([*"123", None]) for i in range(4))
            for _ in range(80)]
    table = spark.createDataFrame(rules, "e string, a string, b string, c string, n int")
    df = spark.createDataFrame(base, "e string, a string, b string, c string")
    out = best_rule(df, table, ["e"], ["a", "b", "c"], F.struct("n"), "r", highest=True)
    assert "Join" not in out._jdf.queryExecution().optimizedPlan().toString()
    for row in out.collect():
        fits = [
            r[4] for r in rules
            if r[0] == row.e and all(r[i] in ("*", row[columns[i]]) for i in (1, 2, 3))
        ]
        assert (row.r.n if row.r else None) == max(fits, default=None), row


def test_a_value_with_two_codes_is_refused(spark):
    codes = spark.createDataFrame(
        [("compania", "01", "C01"), ("compania", "01", "C02")], "campo string, prototipo string, codigo string"
    )
    with pytest.raises(Exception, match="two codes for compania 01"):
        spark.range(1).select(accounting.code_dictionary(codes)).collect()


def test_overlapping_windows(spark):
    rows = [("a", 1, 5), ("a", 2, 3), ("a", 5, 6), ("a", 7, None), ("a", 9, 9), ("b", 1, 2), ("b", 3, 4)]
    df = spark.createDataFrame(
        [(k, DAY + timedelta(s), DAY + timedelta(e) if e else None) for k, s, e in rows],
        "k string, s date, e date",
    )
    out = quality.overlapping(df, ["k"], "s", "e").collect()
    assert sorted((r.k, (r.s - DAY).days) for r in out) == [("a", 2), ("a", 5), ("a", 9)]
