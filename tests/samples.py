"""Small parameter tables and receipts for unit tests."""

from __future__ import annotations

from datetime import date

from remanente.vocabulary import ESTANDARES


def params(spark, kind="produccion_directo", business="directo", sign=-1, contract="directo"):
    rows = [
        (1, kind, business, s, "prima", "no_aplica", contract,
         "recibo" if s == "ifrs4_local" else "cobertura", sign)
        for s in ESTANDARES
    ]
    return spark.createDataFrame(
        rows,
        "estado_insumo int, tipo_insumo string, tipo_negocio string, tipo_contabilidad string, "
        "componente string, clasificacion_adicional string, tipo_contrato string, "
        "nivel_detalle string, signo_constitucion int",
    )


def exceptions(spark):
    """Only the local IFRS 4 standard is a candidate for the half/half rule."""
    return spark.createDataFrame(
        [(1, "ifrs17_local", 0), (2, "ifrs17_corporativo", 0)],
        "orden int, tipo_contabilidad string, candidato_devengo_50_50 int",
    )


def day(text: str | None) -> date | None:
    return date.fromisoformat(text) if text else None


def receipts(spark, rows):
    """Rows of (id, booked, receipt start, receipt end, coverage start, coverage end, currency)."""
    full = [
        (i, "produccion_directo", "directo", *(day(d) for d in (booked, booked, s, e, cs, ce)),
         currency, 1200.0)
        for i, booked, s, e, cs, ce, currency in rows
    ]
    return spark.createDataFrame(
        full,
        "id int, tipo_insumo string, tipo_negocio string, fecha_expedicion_poliza date, "
        "fecha_contabilizacion_recibo date, fecha_inicio_vigencia_recibo date, "
        "fecha_fin_vigencia_recibo date, fecha_inicio_vigencia_cobertura date, "
        "fecha_fin_vigencia_cobertura date, moneda string, valor_prima_emitida double",
    )
