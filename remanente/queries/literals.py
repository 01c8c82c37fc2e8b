"""Parameter tables of the sample close, as SQL text that Spark and DuckDB both read."""

from __future__ import annotations

from collections.abc import Iterable
from itertools import product

from remanente.vocabulary import ESTANDARES

LINES = ["003", "040", "083", "084", "092", "095"]
COMPANIES = ["01", "02"]


def _literal(value) -> str:
    if value is None:
        return "NULL"
    return f"'{value}'" if isinstance(value, str) else str(value)


def values_table(fields: str, rows: Iterable[tuple]) -> str:
    """``SELECT`` over a ``VALUES`` list with one cast per declared field."""
    named = [f.split() for f in fields.split(",")]
    casts = ", ".join(f"CAST({n} AS {t}) AS {n}" for n, t in named)
    body = ",\n".join("(" + ", ".join(map(_literal, r)) + ")" for r in rows)
    return f"SELECT {casts} FROM (VALUES\n{body}\n) AS v({', '.join(n for n, _ in named)})"


def _accounting_parameters() -> Iterable[tuple]:
    """Each input once per standard; the local IFRS 4 standard reads receipt terms."""
    direct = [
        ("produccion_directo", "prima", "no_aplica", -1),
        ("camara_soat", "prima", "no_aplica", -1),
        ("dcto_directo", "descuento", "no_aplica", 1),
        ("gasto_comi_directo", "gasto", "comisiones", 1),
        ("gasto_otro_directo", "gasto", "otros", 1),
        ("terremoto_factor_pprr", "gasto", "terremoto", 1),
        ("terremoto_nota_tecnica", "gasto", "terremoto", 1),
        ("matematica_local_gasto_comi_directo", "gasto", "matematica", 1),
        ("matematica_local_gasto_otro_directo", "gasto", "matematica", 1),
        ("componente_inversion_directo", "inversion", "no_aplica", -1),
        ("onerosidad", "onerosidad", "no_aplica", -1),
        ("cartera", "cartera", "no_aplica", 1),
    ]
    ceded = [
        ("cesion_rea_prop", "prima", "no_aplica", 1, "proporcional"),
        ("dcto_rea_prop", "descuento", "no_aplica", -1, "proporcional"),
        ("gasto_comi_rea_prop", "gasto", "comisiones", -1, "proporcional"),
        ("gasto_otro_rea_prop", "gasto", "otros", -1, "proporcional"),
        ("matematica_local_gasto_comi_rea_prop", "gasto", "matematica", -1, "proporcional"),
        ("comision_rea_prop", "comision", "no_aplica", -1, "proporcional"),
        ("recup_onerosidad_pp", "onerosidad", "no_aplica", 1, "proporcional"),
        ("costo_contrato_rea_noprop", "costo", "no_aplica", 1, "no_proporcional"),
        ("recup_onerosidad_np", "onerosidad", "no_aplica", 1, "no_proporcional"),
        ("cuenta_corriente", "cartera", "no_aplica", -1, "proporcional"),
    ]
    for standard in ESTANDARES:
        level = "recibo" if standard == "ifrs4_local" else "cobertura"
        for name, component, extra, sign in direct:
            yield 1, name, "directo", standard, component, extra, "directo", level, sign
        for (name, component, extra, sign, contract), business in product(
            ceded, ["mantenido", "retrocedido"]
        ):
            yield 1, name, business, standard, component, extra, contract, level, sign
    yield 0, "produccion_directo", "directo", "ifrs4_local", "prima", "baja", "directo", "recibo", 1


def _expenses() -> Iterable[tuple]:
    """Named channel and product, channel only, neither, and the unranked product only.

    Some ranges overlap: a later start wins while it lasts, and of equal starts the lower rate.
    """
    scopes = [("AUTOMOBILE", "Brand#1"), ("AUTOMOBILE", "*"), ("*", "*"), ("*", "Brand#2")]
    kinds = [
        "expedicion_comisiones",
        "expedicion_otros",
        "terremoto_factor_pprr",
        "terremoto_nota_tecnica",
    ]
    for company, line, (p, scope), (i, kind), (j, standard) in product(
        COMPANIES, LINES, enumerate(scopes), enumerate(kinds), enumerate(ESTANDARES)
    ):
        rate = ((4 * p + i + j) % 9 + 1) / 10
        yield company, line, *scope, kind, rate, standard, "1995-01-01", "2002-12-31"
        if scope == ("*", "*"):
            yield company, line, *scope, kind, rate / 2, standard, "1996-03-15", "1997-02-28"
            yield company, line, *scope, kind, rate / 4, standard, "1996-12-01", "1997-01-31"
        elif scope == ("AUTOMOBILE", "*") and i % 2:
            yield company, line, *scope, kind, rate / 5, standard, "1997-06-01", "1997-06-30"
            yield company, line, *scope, kind, rate / 8, standard, "1997-06-01", "1998-12-31"
            yield company, line, *scope, kind, rate / 8, standard, "1997-06-01", "1997-12-31"


def _bt_rows() -> Iterable[tuple]:
    """Business transactions of premium and expense movements outside transition."""
    movements = [
        ("CON", "NA", "ZC", "C"),
        ("LIB", "AC", "ZD", "D"),
        ("LIB", "AN", "ZE", "D"),
        ("SAL", "NA", "ZT", "C"),
        ("FCO", "NA", "ZF", "C"),
    ]
    # Concept and class -> number of the business transaction.
    numbers = {("PRI", "NA"): "1099", ("GAS", "COM"): "3100", ("GAS", "OTR"): "3101",
               ("GAS", "MAT"): "3105"}
    for (move, year, prefix, nature), ((concept, extra), number) in product(
        movements, numbers.items()
    ):
        kinds = [("D", "DIR", "na")]
        if concept == "PRI":
            kinds += [("M", "PRO", "ext"), ("R", "PRO", "ext")]
        for (business, contract, reinsurer), insurance, company, standard in product(
            kinds, ["GEN", "VID"], ["C01", "C02"], ["I4", "L17", "C17"]
        ):
            yield (
                move, year, concept, extra, business, contract, reinsurer, insurance, company,
                standard, "PCR_CP", "N", nature, f"{prefix}{number}",
                f"{prefix} {concept} {extra}",
            )


NOMENCLATURE = {
    "tipo_movimiento": {
        "valor_constitucion": "CON",
        "valor_liberacion": "LIB",
        "saldo": "SAL",
        "acreditacion_intereses": "ACR",
        "fluctuacion_constitucion": "FCO",
        "fluctuacion_liberacion": "FLI",
        "constitucion_deterioro": "DCO",
        "liberacion_deterioro": "DLI",
        "cartera": "CAR",
    },
    "indicativo_periodo_movimiento": {
        "no_aplica": "NA",
        "anio_actual": "AC",
        "anio_anterior": "AN",
    },
    "concepto": {
        "prima": "PRI",
        "descuento": "DES",
        "gasto": "GAS",
        "comision": "COM",
        "costo": "COS",
        "onerosidad": "ONE",
        "cartera": "CAR",
    },
    "clasificacion_adicional": {
        "no_aplica": "NA",
        "comisiones": "COM",
        "otros": "OTR",
        "matematica": "MAT",
    },
    "tipo_negocio": {"directo": "D", "mantenido": "M", "retrocedido": "R"},
    "tipo_reaseguro": {"directo": "DIR", "proporcional": "PRO", "no_proporcional": "NPR"},
    "tipo_reasegurador": {"no_aplica": "NA", "int": "INT", "ext": "EXT"},
    "compania": {"01": "C01", "02": "C02"},
    "tipo_contabilidad": {"ifrs4_local": "I4", "ifrs17_local": "L17", "ifrs17_corporativo": "C17"},
    "transicion": {"0": "N", "1": "S"},
}

LITERALS = {
    "param_contabilidad": values_table(
        "estado_insumo INT, tipo_insumo STRING, tipo_negocio STRING, tipo_contabilidad STRING, "
        "componente STRING, clasificacion_adicional STRING, tipo_contrato STRING, "
        "nivel_detalle STRING, signo_constitucion INT",
        _accounting_parameters(),
    ),
    "excepciones_50_50": values_table(
        "orden INT, tipo_insumo STRING, tipo_contabilidad STRING, ramo_sura STRING, "
        "campania STRING, candidato_devengo_50_50 INT",
        [
            (1, "*", "ifrs17_local", "*", "*", 0),
            (2, "*", "ifrs17_corporativo", "*", "*", 0),
            (3, "*", "ifrs17_local", "040", "*", 1),
            (4, "*", "*", "*", "verano", 0),
            (5, "dcto_directo", "ifrs4_local", "083", "*", 0),
        ],
    ),
    "gasto": values_table(
        "compania STRING, ramo_sura STRING, canal STRING, producto STRING, tipo_gasto STRING, "
        "porc_gasto DOUBLE, tipo_contabilidad STRING, fecha_inicio DATE, fecha_fin DATE",
        _expenses(),
    ),
    "componente_financiacion": values_table(
        "tipo_contabilidad STRING, moneda STRING, tipo_insumo STRING, compania STRING, "
        "ramo_sura STRING, producto STRING, tipo_op STRING, aplica_comp_financ INT, "
        "aplica_ipc_mensual INT, pais_curva STRING, moneda_curva STRING, meses_max_vigencia INT",
        [
            ("ifrs17_local", "COP", "produccion_directo", "*", "003", "*", "*", 1, 1, "CO", "COP", 36),
            ("ifrs17_local", "USD", "produccion_directo", "*", "003", "*", "*", 1, 0, "US", "USD", 36),
            ("ifrs17_local", "COP", "produccion_directo", "*", "003", "Brand#1", "*", 0, 0, None, None, None),
            ("ifrs17_local", "USD", "*", "*", "*", "*", "*", 0, 0, None, None, None),
            ("ifrs17_corporativo", "COP", "*", "*", "003", "*", "*", 1, 1, "CO", "COP", 36),
            ("ifrs17_corporativo", "USD", "*", "01", "003", "*", "23", 1, 0, "US", "USD", 24),
        ],
    ),
    "relacion_bt": values_table(
        "tipo_movimiento STRING, indicativo_periodo_movimiento STRING, concepto STRING, "
        "clasificacion_adicional STRING, tipo_negocio STRING, tipo_reaseguro STRING, "
        "tipo_reasegurador STRING, tipo_seguro STRING, compania STRING, "
        "tipo_contabilidad STRING, tipo_reserva STRING, transicion STRING, naturaleza STRING, "
        "bt STRING, descripcion_bt STRING",
        _bt_rows(),
    ),
    "tipo_seguro": values_table(
        "ramo STRING, tipo_seguro_codigo STRING",
        [("003", "GEN"), ("040", "GEN"), ("083", "VID"), ("092", "GEN"), ("095", "VID")],
    ),
    "nomenclatura": values_table(
        "campo STRING, prototipo STRING, codigo STRING",
        [(f, p, c) for f, codes in NOMENCLATURE.items() for p, c in codes.items()],
    ),
}
