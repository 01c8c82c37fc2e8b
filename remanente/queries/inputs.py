"""Domain inputs derived from the given tables, in Spark and as DuckDB common table expressions.

Receipts are line items with their order, customer and part; every other growing input is a
projection or an aggregate of the same tables.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from remanente.config import AS_CODED, RunConfig
from remanente.queries.literals import LITERALS

FV = date(1998, 5, 31)
TRANSITION = date(1997, 12, 31)
CFG = RunConfig(FV, TRANSITION)
CFG_CODED = RunConfig(FV, TRANSITION, modo=AS_CODED)

RECEIPT = [
    "tipo_insumo",
    "tipo_negocio",
    "compania",
    "ramo_sura",
    "canal",
    "producto",
    "tipo_op",
    "poliza",
    "poliza_certificado",
    "recibo",
    "amparo",
    "cdsubgarantia",
    "numero_documento_sap",
    "moneda",
    "fecha_expedicion_poliza",
    "fecha_contabilizacion_recibo",
    "fecha_inicio_vigencia_recibo",
    "fecha_fin_vigencia_recibo",
    "fecha_inicio_vigencia_cobertura",
    "fecha_fin_vigencia_cobertura",
]

SQL: dict[str, str] = dict(LITERALS)


def _given(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _text(c: str) -> Column:
    return F.col(c).cast("string")


def _cases(column: str, values: dict, default) -> Column:
    out = None
    for key, value in values.items():
        hit = F.col(column) == key
        out = F.when(hit, value) if out is None else out.when(hit, value)
    return out.otherwise(default)


def base_receipts(spark: SparkSession, sf: str) -> DataFrame:
    """Receipts with the raw columns other inputs derive from (names starting with ``x_``)."""
    shipped, ordered = F.col("l_shipdate").cast("date"), F.col("o_orderdate").cast("date")
    end = F.date_add(
        shipped, F.when(F.col("l_linenumber") <= 3, 27).when(F.col("l_linenumber") == 4, 14)
        .otherwise(364)
    )
    # Line items and orders both grow, so they meet in a shuffled join at every size; what follows is then
    # dealt out by order, however few pieces the files come in. Each side has its own table joined before,
    # so that neither is dealt out again.
    items = _given(spark, sf, "lineitem").join(
        _given(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey")
    )
    placed = _given(spark, sf, "orders").join(
        _given(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey")
    )
    joined = items.join(placed.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))
    price = F.col("l_extendedprice")
    return joined.select(
        F.lit("produccion_directo").alias("tipo_insumo"),
        F.lit("directo").alias("tipo_negocio"),
        F.when(F.col("l_suppkey") % 2 == 0, "01").otherwise("02").alias("compania"),
        _cases(
            "p_type",
            {"STANDARD": "040", "PROMO": "083", "ECONOMY": "084", "MEDIUM": "092", "SMALL": "095"},
            "003",
        ).alias("ramo_sura"),
        F.col("c_mktsegment").alias("canal"),
        F.col("p_brand").alias("producto"),
        _cases("l_returnflag", {"R": "26", "A": "16"}, "23").alias("tipo_op"),
        F.concat(F.lit("P"), _text("o_custkey")).alias("poliza"),
        _text("l_suppkey").alias("poliza_certificado"),
        _text("l_orderkey").alias("recibo"),
        F.col("l_linestatus").alias("amparo"),
        _text("l_linenumber").alias("cdsubgarantia"),
        _text("l_partkey").alias("numero_documento_sap"),
        F.when(F.col("l_linenumber") % 3 == 0, "COP")
        .when(F.col("l_linenumber") % 3 == 1, "USD")
        .otherwise("EUR")
        .alias("moneda"),
        F.least(ordered, shipped).alias("fecha_expedicion_poliza"),
        ordered.alias("fecha_contabilizacion_recibo"),
        shipped.alias("fecha_inicio_vigencia_recibo"),
        end.alias("fecha_fin_vigencia_recibo"),
        F.date_add(shipped, 3).alias("fecha_inicio_vigencia_cobertura"),
        end.alias("fecha_fin_vigencia_cobertura"),
        F.when(F.col("l_returnflag") == "R", -price).otherwise(price).alias("valor_prima_emitida"),
        F.col("l_discount").alias("x_descuento"),
        F.col("l_tax").alias("x_impuesto"),
        F.col("l_suppkey").alias("x_proveedor"),
        F.col("l_linenumber").alias("x_linea"),
        F.col("o_custkey").alias("x_cliente"),
    )


SQL["base"] = """
SELECT 'produccion_directo' AS tipo_insumo, 'directo' AS tipo_negocio,
  CASE WHEN l_suppkey % 2 = 0 THEN '01' ELSE '02' END AS compania,
  CASE p_type WHEN 'STANDARD' THEN '040' WHEN 'PROMO' THEN '083' WHEN 'ECONOMY' THEN '084'
    WHEN 'MEDIUM' THEN '092' WHEN 'SMALL' THEN '095' ELSE '003' END AS ramo_sura,
  c_mktsegment AS canal, p_brand AS producto,
  CASE l_returnflag WHEN 'R' THEN '26' WHEN 'A' THEN '16' ELSE '23' END AS tipo_op,
  'P' || CAST(o_custkey AS VARCHAR) AS poliza,
  CAST(l_suppkey AS VARCHAR) AS poliza_certificado, CAST(l_orderkey AS VARCHAR) AS recibo,
  l_linestatus AS amparo, CAST(l_linenumber AS VARCHAR) AS cdsubgarantia,
  CAST(l_partkey AS VARCHAR) AS numero_documento_sap,
  CASE l_linenumber % 3 WHEN 0 THEN 'COP' WHEN 1 THEN 'USD' ELSE 'EUR' END AS moneda,
  LEAST(CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS fecha_expedicion_poliza,
  CAST(o_orderdate AS DATE) AS fecha_contabilizacion_recibo,
  CAST(l_shipdate AS DATE) AS fecha_inicio_vigencia_recibo,
  CAST(l_shipdate AS DATE) + CASE WHEN l_linenumber <= 3 THEN 27 WHEN l_linenumber = 4 THEN 14
    ELSE 364 END AS fecha_fin_vigencia_recibo,
  CAST(l_shipdate AS DATE) + 3 AS fecha_inicio_vigencia_cobertura,
  CAST(l_shipdate AS DATE) + CASE WHEN l_linenumber <= 3 THEN 27 WHEN l_linenumber = 4 THEN 14
    ELSE 364 END AS fecha_fin_vigencia_cobertura,
  CASE WHEN l_returnflag = 'R' THEN -l_extendedprice ELSE l_extendedprice END
    AS valor_prima_emitida,
  l_discount AS x_descuento, l_tax AS x_impuesto, l_suppkey AS x_proveedor,
  l_linenumber AS x_linea, o_custkey AS x_cliente
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN part ON l_partkey = p_partkey"""


def receipts(spark: SparkSession, sf: str) -> DataFrame:
    return base_receipts(spark, sf).select(*RECEIPT, "valor_prima_emitida")


SQL["recibos"] = f"SELECT {', '.join(RECEIPT)}, valor_prima_emitida FROM base"

_CONTRACT = [
    "contrato_reaseguro",
    "nit_reasegurador",
    "tipo_reasegurador",
    "porc_participacion_reasegurador",
    "porc_cesion",
    "fe_ini_vig_contrato_reaseguro",
    "fe_fin_vig_contrato_reaseguro",
    "recibo_rea",
]


def _ceded(spark: SparkSession, sf: str) -> DataFrame:
    year = F.year("fecha_inicio_vigencia_recibo")
    supplier = F.col("x_proveedor")
    share = 0.2 + F.col("x_descuento")
    return (
        base_receipts(spark, sf)
        .withColumns(
            {
                "tipo_insumo": F.lit("cesion_rea_prop"),
                "tipo_negocio": F.when(supplier % 6 == 0, "retrocedido").otherwise("mantenido"),
                "contrato_reaseguro": F.concat(F.lit("C"), supplier.cast("string")),
                "nit_reasegurador": supplier.cast("string"),
                "tipo_reasegurador": F.when(supplier % 5 == 0, F.lit(None))
                .when(supplier % 2 == 0, "ext")
                .otherwise("int"),
                "porc_participacion_reasegurador": F.lit(0.5),
                "porc_cesion": share,
                "fe_ini_vig_contrato_reaseguro": F.make_date(year, F.lit(1), F.lit(1)),
                "fe_fin_vig_contrato_reaseguro": F.make_date(year, F.lit(12), F.lit(31)),
                "recibo_rea": F.col("recibo"),
                "valor_prima_cedida": F.col("valor_prima_emitida") * share,
            }
        )
    )


def cessions(spark: SparkSession, sf: str) -> DataFrame:
    return _ceded(spark, sf).select(*RECEIPT, *_CONTRACT, "valor_prima_cedida")


def commissions(spark: SparkSession, sf: str) -> DataFrame:
    amount = F.col("valor_prima_emitida") * F.col("x_impuesto")
    return (
        _ceded(spark, sf)
        .withColumn("tipo_insumo", F.lit("comision_rea_prop"))
        .select(*RECEIPT, *_CONTRACT, amount.alias("valor_comision_rea"))
    )


SQL["cedido"] = """
SELECT * REPLACE ('cesion_rea_prop' AS tipo_insumo,
    CASE WHEN x_proveedor % 6 = 0 THEN 'retrocedido' ELSE 'mantenido' END AS tipo_negocio),
  'C' || CAST(x_proveedor AS VARCHAR) AS contrato_reaseguro,
  CAST(x_proveedor AS VARCHAR) AS nit_reasegurador,
  CASE WHEN x_proveedor % 5 = 0 THEN NULL WHEN x_proveedor % 2 = 0 THEN 'ext' ELSE 'int' END
    AS tipo_reasegurador,
  CAST(0.5 AS DOUBLE) AS porc_participacion_reasegurador,
  CAST(0.2 AS DOUBLE) + x_descuento AS porc_cesion,
  make_date(year(fecha_inicio_vigencia_recibo), 1, 1) AS fe_ini_vig_contrato_reaseguro,
  make_date(year(fecha_inicio_vigencia_recibo), 12, 31) AS fe_fin_vig_contrato_reaseguro,
  recibo AS recibo_rea,
  valor_prima_emitida * (CAST(0.2 AS DOUBLE) + x_descuento) AS valor_prima_cedida
FROM base"""
SQL["cesion_rea"] = (
    f"SELECT {', '.join(RECEIPT + _CONTRACT)}, valor_prima_cedida FROM cedido"
)
SQL["comision_rea"] = (
    "SELECT * REPLACE ('comision_rea_prop' AS tipo_insumo) FROM ("
    f"SELECT {', '.join(RECEIPT + _CONTRACT)}, valor_prima_emitida * x_impuesto "
    "AS valor_comision_rea FROM cedido)"
)


def discounts(spark: SparkSession, sf: str) -> DataFrame:
    return (
        base_receipts(spark, sf)
        .filter(F.col("x_descuento") > 0)
        .select(
            "compania",
            "ramo_sura",
            "poliza",
            "recibo",
            F.col("recibo").alias("recibo_rea"),
            "poliza_certificado",
            "amparo",
            "tipo_op",
            "producto",
            "numero_documento_sap",
            F.col("x_descuento").alias("podto_comercial"),
            F.col("x_impuesto").alias("podto_tecnico"),
        )
        .distinct()
    )


SQL["descuento"] = """
SELECT DISTINCT compania, ramo_sura, poliza, recibo, recibo AS recibo_rea, poliza_certificado,
  amparo, tipo_op, producto, numero_documento_sap, x_descuento AS podto_comercial,
  x_impuesto AS podto_tecnico FROM base WHERE x_descuento > 0"""


def literal(name: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf: spark.sql(LITERALS[name])


def fx_rates(spark: SparkSession, sf: str) -> DataFrame:
    """Daily rates of two currencies; some days are left out, so that they read as 1."""
    day = F.col("o_orderdate").cast("date")
    daily = _given(spark, sf, "orders").groupBy(day.alias("fecha")).agg(
        F.sum("o_custkey").alias("_n")
    )
    extra = F.create_map(F.lit("USD"), F.lit(0), F.lit("EUR"), F.lit(500))
    return (
        daily.filter(F.dayofyear("fecha") % 97 != 0)
        .select("fecha", "_n", F.explode(extra).alias("moneda_origen", "_extra"))
        .select(
            "fecha",
            "moneda_origen",
            F.lit("COP").alias("moneda_destino"),
            (3000 + F.col("_n") % 1000 + F.col("_extra")).cast("double").alias("tasa_cambio"),
        )
    )


SQL["tasa_cambio"] = """
SELECT fecha, m.moneda_origen, 'COP' AS moneda_destino,
  CAST(3000 + n % 1000 + m.extra AS DOUBLE) AS tasa_cambio
FROM (SELECT CAST(o_orderdate AS DATE) AS fecha, CAST(SUM(o_custkey) AS BIGINT) AS n
      FROM orders GROUP BY 1) AS d,
  (VALUES ('USD', 0), ('EUR', 500)) AS m(moneda_origen, extra)
WHERE dayofyear(fecha) % 97 <> 0"""


def credit_risk(spark: SparkSession, sf: str) -> DataFrame:
    """Two windows per reinsurer; one in ten reinsurers has none."""
    supplier = F.col("s_suppkey")
    first = F.abs("s_acctbal") % 100 / 1000
    later = first * F.when(supplier % 2 == 0, 1.2).otherwise(0.8)
    windows = F.array(
        F.struct(
            first.alias("p"),
            F.lit(date(1990, 1, 1)).alias("ini"),
            F.lit(date(1998, 5, 14)).alias("fin"),
        ),
        F.struct(
            later.alias("p"),
            F.lit(date(1998, 5, 15)).alias("ini"),
            F.lit(None).cast("date").alias("fin"),
        ),
    )
    return (
        _given(spark, sf, "supplier")
        .filter(supplier % 10 != 9)
        .select(supplier.cast("string").alias("nit_reasegurador"), F.explode(windows).alias("v"))
        .select(
            "nit_reasegurador",
            F.col("v.p").alias("probabilidad_incumplimiento"),
            F.col("v.ini").alias("fecha_inicio_vigencia"),
            F.col("v.fin").alias("fecha_fin_vigencia"),
        )
    )


SQL["riesgo_credito"] = """
SELECT CAST(s_suppkey AS VARCHAR) AS nit_reasegurador,
  abs(s_acctbal) % 100 / 1000 AS probabilidad_incumplimiento,
  DATE '1990-01-01' AS fecha_inicio_vigencia, DATE '1998-05-14' AS fecha_fin_vigencia
FROM supplier WHERE s_suppkey % 10 <> 9
UNION ALL
SELECT CAST(s_suppkey AS VARCHAR), abs(s_acctbal) % 100 / 1000
    * CASE WHEN s_suppkey % 2 = 0 THEN CAST(1.2 AS DOUBLE) ELSE CAST(0.8 AS DOUBLE) END,
  DATE '1998-05-15', NULL
FROM supplier WHERE s_suppkey % 10 <> 9"""


def onerosity(spark: SparkSession, sf: str) -> DataFrame:
    booked = F.col("fecha_contabilizacion_recibo")
    return (
        base_receipts(spark, sf)
        .filter(F.col("ramo_sura") == "084")
        .select(
            F.lit("onerosidad").alias("tipo_insumo"),
            "tipo_negocio",
            "compania",
            "ramo_sura",
            "poliza",
            "recibo",
            "moneda",
            "fecha_expedicion_poliza",
            booked.alias("fecha_operacion"),
            F.date_add(booked, F.when(F.col("x_linea") % 2 == 1, 200).otherwise(20)).alias(
                "fecha_fin_vigencia_poliza"
            ),
            booked.alias("fecha_calculo_onerosidad"),
            F.floor(F.abs("valor_prima_emitida") / 1000).cast("double").alias("valor_onerosidad"),
            "valor_prima_emitida",
        )
    )


SQL["onerosidad"] = """
SELECT 'onerosidad' AS tipo_insumo, tipo_negocio, compania, ramo_sura, poliza, recibo, moneda,
  fecha_expedicion_poliza, fecha_contabilizacion_recibo AS fecha_operacion,
  fecha_contabilizacion_recibo + CASE WHEN x_linea % 2 = 1 THEN 200 ELSE 20 END
    AS fecha_fin_vigencia_poliza,
  fecha_contabilizacion_recibo AS fecha_calculo_onerosidad,
  floor(abs(valor_prima_emitida) / 1000) AS valor_onerosidad, valor_prima_emitida
FROM base WHERE ramo_sura = '084'"""


def contract_costs(spark: SparkSession, sf: str) -> DataFrame:
    """One cost receipt per contract; odd contracts were reinstated or end in the close month."""
    n = F.col("s_suppkey")
    booked = F.date_add(F.lit(date(1998, 1, 15)), (n % 150).cast("int"))
    ends = F.when(n % 7 == 0, F.lit(date(1998, 5, 20))).otherwise(F.lit(date(1998, 12, 31)))
    start = F.lit(date(1998, 1, 1))
    return _given(spark, sf, "supplier").select(
        F.lit("costo_contrato_rea_noprop").alias("tipo_insumo"),
        F.lit("mantenido").alias("tipo_negocio"),
        F.when(n % 2 == 0, "01").otherwise("02").alias("compania"),
        F.when(n % 3 == 0, "083").otherwise("040").alias("ramo_sura"),
        F.concat(F.lit("C"), n.cast("string")).alias("contrato_reaseguro"),
        n.cast("string").alias("nit_reasegurador"),
        n.cast("string").alias("recibo"),
        F.when(n % 4 == 0, "USD").otherwise("COP").alias("moneda"),
        start.alias("fecha_expedicion_poliza"),
        booked.alias("fecha_contabilizacion_recibo"),
        start.alias("fecha_inicio_vigencia_recibo"),
        ends.alias("fecha_fin_vigencia_recibo"),
        start.alias("fecha_inicio_vigencia_cobertura"),
        ends.alias("fecha_fin_vigencia_cobertura"),
        start.alias("fe_ini_vig_contrato_reaseguro"),
        F.when(n % 3 == 1, F.lit(date(1998, 3, 15))).alias("fe_reinstalamento"),
        (F.col("s_acctbal") + 2000).alias("valor_costo_contrato"),
        (n % 3 * 100).cast("double").alias("valor_reinstalamento"),
    )


def rolled_contract_costs(spark: SparkSession, sf: str) -> DataFrame:
    """Costs that carry the balance of the month before; new contracts carry none."""
    odd = F.col("nit_reasegurador").cast("long") % 2 == 1
    left = F.when(~odd, F.col("valor_costo_contrato") * 0.5)
    return contract_costs(spark, sf).withColumn("saldo_anterior", left)


SQL["costo_contrato_rea"] = """
SELECT 'costo_contrato_rea_noprop' AS tipo_insumo, 'mantenido' AS tipo_negocio,
  CASE WHEN s_suppkey % 2 = 0 THEN '01' ELSE '02' END AS compania,
  CASE WHEN s_suppkey % 3 = 0 THEN '083' ELSE '040' END AS ramo_sura,
  'C' || CAST(s_suppkey AS VARCHAR) AS contrato_reaseguro,
  CAST(s_suppkey AS VARCHAR) AS nit_reasegurador, CAST(s_suppkey AS VARCHAR) AS recibo,
  CASE WHEN s_suppkey % 4 = 0 THEN 'USD' ELSE 'COP' END AS moneda,
  DATE '1998-01-01' AS fecha_expedicion_poliza,
  DATE '1998-01-15' + CAST(s_suppkey % 150 AS INT) AS fecha_contabilizacion_recibo,
  DATE '1998-01-01' AS fecha_inicio_vigencia_recibo,
  CASE WHEN s_suppkey % 7 = 0 THEN DATE '1998-05-20' ELSE DATE '1998-12-31' END
    AS fecha_fin_vigencia_recibo,
  DATE '1998-01-01' AS fecha_inicio_vigencia_cobertura,
  CASE WHEN s_suppkey % 7 = 0 THEN DATE '1998-05-20' ELSE DATE '1998-12-31' END
    AS fecha_fin_vigencia_cobertura,
  DATE '1998-01-01' AS fe_ini_vig_contrato_reaseguro,
  CASE WHEN s_suppkey % 3 = 1 THEN DATE '1998-03-15' END AS fe_reinstalamento,
  s_acctbal + 2000 AS valor_costo_contrato,
  CAST(s_suppkey % 3 * 100 AS DOUBLE) AS valor_reinstalamento
FROM supplier"""
SQL["costo_contrato_roll"] = """
SELECT *, CASE WHEN CAST(nit_reasegurador AS BIGINT) % 2 = 0
  THEN valor_costo_contrato * CAST(0.5 AS DOUBLE) END AS saldo_anterior
FROM costo_contrato_rea"""


def contract_tracking(spark: SparkSession, sf: str) -> DataFrame:
    """Month-end tracking: discounts given on the supplier's shipments stand for the claims."""
    claims = (F.col("l_extendedprice") * F.col("l_discount")).cast("decimal(18,4)")
    return (
        _given(spark, sf, "lineitem")
        .groupBy("l_suppkey", F.last_day(F.col("l_shipdate").cast("date")).alias("fecha_cierre"))
        .agg(F.sum(claims).cast("double").alias("_s"), F.count(F.lit(1)).alias("_n"))
        .join(_given(spark, sf, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .select(
            F.concat(F.lit("C"), _text("l_suppkey")).alias("contrato_reaseguro"),
            "fecha_cierre",
            (10 * (F.col("s_acctbal") + 2000)).alias("limite_agregado_valor_instalado"),
            F.col("_s").alias("valor_siniestros_incurridos_mes"),
            (F.col("_s") * -0.125).alias("valor_salvamentos_mes"),
            F.lit(100.0).alias("limite_agregado_casos_instalado"),
            F.col("_n").cast("double").alias("casos_incurridos_mes"),
        )
    )


SQL["seguimiento_rea"] = """
SELECT 'C' || CAST(l_suppkey AS VARCHAR) AS contrato_reaseguro, fecha_cierre,
  10 * (s_acctbal + 2000) AS limite_agregado_valor_instalado,
  s AS valor_siniestros_incurridos_mes, s * CAST(-0.125 AS DOUBLE) AS valor_salvamentos_mes,
  CAST(100 AS DOUBLE) AS limite_agregado_casos_instalado,
  CAST(n AS DOUBLE) AS casos_incurridos_mes
FROM (SELECT l_suppkey, last_day(CAST(l_shipdate AS DATE)) AS fecha_cierre,
        CAST(SUM(CAST(l_extendedprice * l_discount AS DECIMAL(18,4))) AS DOUBLE) AS s,
        COUNT(*) AS n FROM lineitem GROUP BY 1, 2)
  JOIN supplier ON l_suppkey = s_suppkey"""


def np_recoveries(spark: SparkSession, sf: str) -> DataFrame:
    n = F.col("s_suppkey")
    return _given(spark, sf, "supplier").select(
        F.lit("recup_onerosidad_np").alias("tipo_insumo"),
        F.when(n % 2 == 0, "mantenido").otherwise("retrocedido").alias("tipo_negocio"),
        F.when(n % 2 == 0, "01").otherwise("02").alias("compania"),
        F.lit("084").alias("ramo_sura"),
        F.concat(F.lit("P"), n.cast("string")).alias("poliza"),
        F.lit("COP").alias("moneda"),
        F.concat(F.lit("C"), n.cast("string")).alias("contrato_reaseguro"),
        n.cast("string").alias("nit_reasegurador"),
        F.lit(date(1998, 1, 1)).alias("fecha_expedicion_poliza"),
        F.date_add(F.lit(date(1998, 2, 1)), (n % 130).cast("int")).alias(
            "fecha_calculo_recuperacion"
        ),
        (F.col("s_acctbal") + 3000).alias("valor_recuperacion"),
        F.lit(0.5).alias("porc_participacion_reasegurador"),
        F.lit(date(1998, 1, 1)).alias("fe_ini_vig_contrato_reaseguro"),
        F.when(n % 5 == 0, F.lit(date(1998, 5, 25)))
        .otherwise(F.lit(date(1998, 12, 31)))
        .alias("fe_fin_vig_contrato_reaseguro"),
    )


def rolled_np_recoveries(spark: SparkSession, sf: str) -> DataFrame:
    odd = F.col("nit_reasegurador").cast("long") % 2 == 1
    return np_recoveries(spark, sf).withColumn(
        "saldo_anterior", F.when(~odd, F.col("valor_recuperacion") * 0.25)
    )


SQL["recup_onerosidad"] = """
SELECT 'recup_onerosidad_np' AS tipo_insumo,
  CASE WHEN s_suppkey % 2 = 0 THEN 'mantenido' ELSE 'retrocedido' END AS tipo_negocio,
  CASE WHEN s_suppkey % 2 = 0 THEN '01' ELSE '02' END AS compania, '084' AS ramo_sura,
  'P' || CAST(s_suppkey AS VARCHAR) AS poliza, 'COP' AS moneda,
  'C' || CAST(s_suppkey AS VARCHAR) AS contrato_reaseguro,
  CAST(s_suppkey AS VARCHAR) AS nit_reasegurador,
  DATE '1998-01-01' AS fecha_expedicion_poliza,
  DATE '1998-02-01' + CAST(s_suppkey % 130 AS INT) AS fecha_calculo_recuperacion,
  s_acctbal + 3000 AS valor_recuperacion,
  CAST(0.5 AS DOUBLE) AS porc_participacion_reasegurador,
  DATE '1998-01-01' AS fe_ini_vig_contrato_reaseguro,
  CASE WHEN s_suppkey % 5 = 0 THEN DATE '1998-05-25' ELSE DATE '1998-12-31' END
    AS fe_fin_vig_contrato_reaseguro
FROM supplier"""
SQL["recup_onerosidad_roll"] = """
SELECT *, CASE WHEN CAST(nit_reasegurador AS BIGINT) % 2 = 0
  THEN valor_recuperacion * CAST(0.25 AS DOUBLE) END AS saldo_anterior
FROM recup_onerosidad"""


def investment_receipts(spark: SparkSession, sf: str) -> DataFrame:
    return (
        base_receipts(spark, sf)
        .filter(F.col("ramo_sura") == "003")
        .select(
            F.lit("componente_inversion_directo").alias("tipo_insumo"),
            "tipo_negocio",
            "poliza",
            "recibo",
            "cdsubgarantia",
            "numero_documento_sap",
            "poliza_certificado",
            "compania",
            "ramo_sura",
            "tipo_op",
            "moneda",
            F.when(
                F.col("x_cliente") % 2 == 0, F.date_add("fecha_contabilizacion_recibo", 40)
            ).alias("fecha_cancelacion_poliza"),
            "fecha_expedicion_poliza",
            "fecha_contabilizacion_recibo",
            F.col("fecha_inicio_vigencia_recibo").alias("fecha_inicio_vigencia_poliza"),
            F.date_add("fecha_fin_vigencia_recibo", 100).alias("fecha_fin_vigencia_poliza"),
            "valor_prima_emitida",
        )
    )


SQL["componente_inversion"] = """
SELECT 'componente_inversion_directo' AS tipo_insumo, tipo_negocio, poliza, recibo, cdsubgarantia,
  numero_documento_sap, poliza_certificado, compania, ramo_sura, tipo_op, moneda,
  CASE WHEN x_cliente % 2 = 0 THEN fecha_contabilizacion_recibo + 40 END
    AS fecha_cancelacion_poliza,
  fecha_expedicion_poliza, fecha_contabilizacion_recibo,
  fecha_inicio_vigencia_recibo AS fecha_inicio_vigencia_poliza,
  fecha_fin_vigencia_recibo + 100 AS fecha_fin_vigencia_poliza, valor_prima_emitida
FROM base WHERE ramo_sura = '003'"""


def _balances(spark: SparkSession, sf: str, kind: str, business: str) -> DataFrame:
    n, day = F.col("o_custkey"), F.col("o_orderdate").cast("date")
    return _given(spark, sf, "orders").select(
        F.lit(kind).alias("tipo_insumo"),
        F.lit(business).alias("tipo_negocio"),
        F.when(n % 2 == 0, "01").otherwise("02").alias("compania"),
        F.lit("040").alias("ramo_sura"),
        F.concat(F.lit("P"), n.cast("string")).alias("poliza"),
        _text("o_orderkey").alias("recibo"),
        day.alias("fecha_corte"),
        day.alias("fecha_expedicion_poliza"),
        F.lit("cartera").alias("tipo_movimiento"),
        F.col("o_totalprice").alias("valor_ml"),
        "o_orderstatus",
    )


def receivable_balances(spark: SparkSession, sf: str) -> DataFrame:
    return _balances(spark, sf, "cartera", "directo").drop("o_orderstatus")


def current_accounts(spark: SparkSession, sf: str) -> DataFrame:
    rows = _balances(spark, sf, "cuenta_corriente", "mantenido")
    return rows.filter(F.col("o_orderstatus") == "F").drop("o_orderstatus")


for _name, _kind, _business, _where in (
    ("cartera", "cartera", "directo", ""),
    ("cuenta_corriente", "cuenta_corriente", "mantenido", " WHERE o_orderstatus = 'F'"),
):
    SQL[_name] = f"""
SELECT '{_kind}' AS tipo_insumo, '{_business}' AS tipo_negocio,
  CASE WHEN o_custkey % 2 = 0 THEN '01' ELSE '02' END AS compania, '040' AS ramo_sura,
  'P' || CAST(o_custkey AS VARCHAR) AS poliza, CAST(o_orderkey AS VARCHAR) AS recibo,
  CAST(o_orderdate AS DATE) AS fecha_corte, CAST(o_orderdate AS DATE) AS fecha_expedicion_poliza,
  'cartera' AS tipo_movimiento, o_totalprice AS valor_ml
FROM orders{_where}"""


def inflation(spark: SparkSession, sf: str) -> DataFrame:
    month = F.trunc(F.col("o_orderdate").cast("date"), "MM")
    return (
        _given(spark, sf, "orders")
        .groupBy(month.alias("fecha"))
        .agg(((F.count(F.lit(1)) % 50 + 30) / 10000).alias("tasa"))
    )


SQL["inflacion"] = """
SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS fecha,
  CAST(COUNT(*) % 50 + 30 AS DOUBLE) / 10000 AS tasa FROM orders GROUP BY 1"""


def yield_curves(spark: SparkSession, sf: str) -> DataFrame:
    """Monthly curves of two currencies with forty nodes, their level set by the orders."""
    month_end = F.last_day(F.col("o_orderdate").cast("date"))
    months = _given(spark, sf, "orders").groupBy(month_end.alias("_fin")).agg(
        F.count(F.lit(1)).alias("_n")
    )
    country = F.create_map(F.lit("CO"), F.lit("COP"), F.lit("US"), F.lit("USD"))
    level = 3 + F.col("_n") % 100 / 100
    return (
        months.select("_fin", "_n", F.explode(country).alias("pais", "moneda"))
        .withColumn("mes", F.explode(F.sequence(F.lit(1), F.lit(40))))
        .select(
            F.date_format("_fin", "yyyyMMdd").cast("int").alias("fecha_clave"),
            "pais",
            "moneda",
            "mes",
            (level + F.lit(0.05) * F.col("mes")).alias("tasa_interes"),
        )
    )


SQL["curvas"] = """
SELECT CAST(strftime(fin, '%Y%m%d') AS INT) AS fecha_clave, p.pais, p.moneda,
  CAST(k.mes AS INT) AS mes,
  3 + CAST(n % 100 AS DOUBLE) / 100 + CAST(0.05 AS DOUBLE) * k.mes AS tasa_interes
FROM (SELECT last_day(CAST(o_orderdate AS DATE)) AS fin, COUNT(*) AS n FROM orders GROUP BY 1) AS m,
  (VALUES ('CO', 'COP'), ('US', 'USD')) AS p(pais, moneda), range(1, 41) AS k(mes)"""


def assistance_master(spark: SparkSession, sf: str) -> DataFrame:
    return (
        base_receipts(spark, sf)
        .select(
            F.col("ramo_sura").alias("CDRAMO"),
            F.col("producto").alias("CDSUBRAMO"),
            F.col("amparo").alias("CDGARANTIA"),
            F.col("cdsubgarantia").alias("CDSUBGARANTIA"),
            F.when(F.col("x_linea") % 4 == 0, "SERV ASISTENCIA")
            .otherwise("BASICO")
            .alias("DSALIAS_2"),
        )
        .distinct()
    )


SQL["maestro_asistencias"] = """
SELECT DISTINCT ramo_sura AS CDRAMO, producto AS CDSUBRAMO, amparo AS CDGARANTIA,
  cdsubgarantia AS CDSUBGARANTIA,
  CASE WHEN x_linea % 4 = 0 THEN 'SERV ASISTENCIA' ELSE 'BASICO' END AS DSALIAS_2
FROM base"""


def workers_comp(spark: SparkSession, sf: str) -> DataFrame:
    """Receipts with a contribution month instead of terms."""
    drop = [c for c in RECEIPT if "vigencia" in c or c == "fecha_expedicion_poliza"]
    return receipts(spark, sf).withColumn("mes_cotizacion", F.col("fecha_contabilizacion_recibo")).drop(
        *drop
    )


SQL["produccion_arl"] = f"""
SELECT {', '.join(c for c in RECEIPT if 'vigencia' not in c and c != 'fecha_expedicion_poliza')},
  valor_prima_emitida, fecha_contabilizacion_recibo AS mes_cotizacion FROM base"""


def _order_receipts(spark: SparkSession, sf: str, kind: str, line: str, prefix: str) -> DataFrame:
    """One receipt per order of another system, with policies and receipts of its own."""
    n, day = F.col("o_custkey"), F.col("o_orderdate").cast("date")
    own = {
        "tipo_insumo": F.lit(kind),
        "tipo_negocio": F.lit("directo"),
        "compania": F.when(n % 2 == 0, "01").otherwise("02"),
        "ramo_sura": F.lit(line),
        "canal": F.lit(prefix),
        "producto": F.lit("Brand#2"),
        "tipo_op": F.lit("23"),
        "poliza": F.concat(F.lit(prefix), n.cast("string")),
        "poliza_certificado": F.lit("1"),
        "recibo": F.concat(F.lit(prefix), _text("o_orderkey")),
        "amparo": F.lit("O"),
        "cdsubgarantia": F.lit("1"),
        "numero_documento_sap": _text("o_orderkey"),
        "moneda": F.lit("COP"),
        "fecha_expedicion_poliza": day,
        "fecha_contabilizacion_recibo": day,
        "fecha_inicio_vigencia_recibo": day,
        "fecha_fin_vigencia_recibo": F.date_add(day, 364),
        "fecha_inicio_vigencia_cobertura": day,
        "fecha_fin_vigencia_cobertura": F.date_add(day, 364),
        "valor_prima_emitida": F.col("o_totalprice") / 16,
    }
    return _given(spark, sf, "orders").select(*[c.alias(k) for k, c in own.items()])


def _order_receipts_sql(kind: str, line: str, prefix: str) -> str:
    return f"""
SELECT '{kind}' AS tipo_insumo, 'directo' AS tipo_negocio,
  CASE WHEN o_custkey % 2 = 0 THEN '01' ELSE '02' END AS compania, '{line}' AS ramo_sura,
  '{prefix}' AS canal, 'Brand#2' AS producto, '23' AS tipo_op,
  '{prefix}' || CAST(o_custkey AS VARCHAR) AS poliza, '1' AS poliza_certificado,
  '{prefix}' || CAST(o_orderkey AS VARCHAR) AS recibo, 'O' AS amparo, '1' AS cdsubgarantia,
  CAST(o_orderkey AS VARCHAR) AS numero_documento_sap, 'COP' AS moneda,
  CAST(o_orderdate AS DATE) AS fecha_expedicion_poliza,
  CAST(o_orderdate AS DATE) AS fecha_contabilizacion_recibo,
  CAST(o_orderdate AS DATE) AS fecha_inicio_vigencia_recibo,
  CAST(o_orderdate AS DATE) + 364 AS fecha_fin_vigencia_recibo,
  CAST(o_orderdate AS DATE) AS fecha_inicio_vigencia_cobertura,
  CAST(o_orderdate AS DATE) + 364 AS fecha_fin_vigencia_cobertura,
  o_totalprice / 16 AS valor_prima_emitida
FROM orders"""


def soat_pool(spark: SparkSession, sf: str) -> DataFrame:
    return _order_receipts(spark, sf, "camara_soat", "041", "S")


def monthly_workers_comp(spark: SparkSession, sf: str) -> DataFrame:
    """Workers' compensation receipts with a contribution month instead of terms."""
    rows = _order_receipts(spark, sf, "produccion_directo", "095", "A")
    month = F.col("fecha_contabilizacion_recibo")
    drop = [c for c in RECEIPT if "vigencia" in c or c == "fecha_expedicion_poliza"]
    return rows.withColumn("mes_cotizacion", month).drop(*drop)


SQL["camara_soat"] = _order_receipts_sql("camara_soat", "041", "S")
SQL["arl_mensual"] = f"""
SELECT * REPLACE (
    CAST(date_trunc('month', fecha_contabilizacion_recibo) AS DATE) AS fecha_expedicion_poliza,
    CAST(date_trunc('month', fecha_contabilizacion_recibo) AS DATE) AS fecha_inicio_vigencia_recibo,
    last_day(fecha_contabilizacion_recibo) AS fecha_fin_vigencia_recibo,
    CAST(date_trunc('month', fecha_contabilizacion_recibo) AS DATE)
      AS fecha_inicio_vigencia_cobertura,
    last_day(fecha_contabilizacion_recibo) AS fecha_fin_vigencia_cobertura)
FROM ({_order_receipts_sql("produccion_directo", "095", "A")})"""


def workers_comp_costs(spark: SparkSession, sf: str) -> DataFrame:
    """Contract costs again under contracts that no tracking table knows."""
    own = {c: F.concat(F.lit("A"), F.col(c)) for c in ("contrato_reaseguro", "recibo")}
    return contract_costs(spark, sf).withColumns(own)


SQL["costo_contrato_arl"] = """
SELECT * REPLACE ('A' || contrato_reaseguro AS contrato_reaseguro, 'A' || recibo AS recibo)
FROM costo_contrato_rea"""


def workers_comp_receivables(spark: SparkSession, sf: str) -> DataFrame:
    rows = receivable_balances(spark, sf).drop("fecha_expedicion_poliza")
    return rows.withColumns(
        {
            "poliza": F.concat(F.lit("A"), F.col("poliza")),
            "mes_cotizacion": F.col("fecha_corte"),
            "valor_ml": F.col("valor_ml") / 32,
        }
    )


def workers_comp_accounts(spark: SparkSession, sf: str) -> DataFrame:
    own = {"poliza": F.concat(F.lit("A"), F.col("poliza")), "valor_ml": F.col("valor_ml") / 64}
    return current_accounts(spark, sf).withColumns(own)


SQL["cartera_arl"] = """
SELECT * REPLACE ('A' || poliza AS poliza, valor_ml / 32 AS valor_ml,
  CAST(date_trunc('month', fecha_corte) AS DATE) AS fecha_expedicion_poliza) FROM cartera"""
SQL["cuenta_corriente_arl"] = (
    "SELECT * REPLACE ('A' || poliza AS poliza, valor_ml / 64 AS valor_ml) FROM cuenta_corriente"
)


SPARK: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    **{name: literal(name) for name in LITERALS},
    "recibos": receipts,
    "produccion_directo": receipts,
    "cesion_rea": cessions,
    "comision_rea": commissions,
    "descuento": discounts,
    "tasa_cambio": fx_rates,
    "riesgo_credito": credit_risk,
    "onerosidad": onerosity,
    "costo_contrato_rea": contract_costs,
    "costo_contrato_roll": rolled_contract_costs,
    "seguimiento_rea": contract_tracking,
    "recup_onerosidad": np_recoveries,
    "recup_onerosidad_roll": rolled_np_recoveries,
    "componente_inversion": investment_receipts,
    "cartera": receivable_balances,
    "cuenta_corriente": current_accounts,
    "inflacion": inflation,
    "curvas": yield_curves,
    "maestro_asistencias": assistance_master,
    "produccion_arl": workers_comp,
    "camara_soat": soat_pool,
    "arl_mensual": monthly_workers_comp,
    "costo_contrato_arl": workers_comp_costs,
    "cartera_arl": workers_comp_receivables,
    "cuenta_corriente_arl": workers_comp_accounts,
}


class Inputs:
    """Inputs of one scale-factor folder, built on first use."""

    def __init__(self, spark: SparkSession, sf: str):
        self.spark, self.sf = spark, sf
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = SPARK[name](self.spark, self.sf)
        return self._built[name]

    def __contains__(self, name: str) -> bool:
        return name in SPARK

    def only(self, *names: str) -> dict[str, DataFrame]:
        return {n: self[n] for n in names}
