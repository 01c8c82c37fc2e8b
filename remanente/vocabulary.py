"""Names and codes of the reserve domain that results must carry exactly."""

# Detail levels a term can be read from.
NIVELES_DETALLE = ["recibo", "cobertura"]

# Accounting standards.
ESTANDARES = ["ifrs4_local", "ifrs17_local", "ifrs17_corporativo"]
ESTANDARES_LOCALES = ["ifrs4_local", "ifrs17_local"]

# Inputs with a rule of their own.
INSUMO_INVERSION = "componente_inversion_directo"
INSUMOS_LIMITE = ["costo_contrato_rea_noprop", "recup_onerosidad_np"]

# Expense type -> input name, direct and ceded.
GASTO_A_INSUMO_DIRECTO = {
    "expedicion_comisiones": "gasto_comi_directo",
    "expedicion_otros": "gasto_otro_directo",
    "terremoto_factor_pprr": "terremoto_factor_pprr",
    "terremoto_nota_tecnica": "terremoto_nota_tecnica",
}
GASTO_A_INSUMO_REA = {
    "expedicion_comisiones": "gasto_comi_rea_prop",
    "expedicion_otros": "gasto_otro_rea_prop",
}
PREFIJO_MATEMATICA = "matematica_local_"

# Business kinds that carry reinsurer credit risk.
NEGOCIOS_CEDIDOS = ["mantenido", "retrocedido"]

# Receipt operations that end an investment component early.
OPERACIONES_ANULACION = ["16", "26"]

# Business-transaction classes outside this reserve.
CLASES_FUERA_DE_ALCANCE = ["MAT", "REC"]

# Wide amount columns that become accounting movements.
MOVIMIENTOS = [
    "valor_constitucion",
    "valor_liberacion",
    "saldo",
    "acreditacion_intereses",
    "fluctuacion_liberacion",
    "fluctuacion_constitucion",
    "constitucion_deterioro",
    "liberacion_deterioro",
]
MOVIMIENTOS_FLUCTUACION = ["fluctuacion_constitucion", "fluctuacion_liberacion"]
MOVIMIENTOS_SIN_ANIO = [
    "valor_constitucion",
    "fluctuacion_constitucion",
    "constitucion_deterioro",
    "saldo",
    "acreditacion_intereses",
]

# Nomenclature field -> column that carries the prototype value.
CAMPOS_HOMOLOGADOS = {
    "tipo_movimiento": "tipo_movimiento",
    "indicativo_periodo_movimiento": "anio_liberacion",
    "concepto": "componente",
    "clasificacion_adicional": "clasificacion_adicional",
    "tipo_negocio": "tipo_negocio",
    "tipo_reaseguro": "tipo_contrato",
    "tipo_reasegurador": "tipo_reasegurador",
    "compania": "compania",
    "tipo_contabilidad": "tipo_contabilidad",
    "transicion": "transicion",
}

# Policies left out of a reconciliation.
POLIZAS_EXCLUIDAS = ["-1", "", "124324091"]

# Business-transaction endings re-labelled as assistance.
FINALES_BT_ASISTENCIA = ["1099", "3100", "3101"]

# Company number in the receipts system -> company code.
SOCIEDAD_A_COMPANIA = {"1000": "01", "2000": "02"}

# Reconciliation tolerance.
TOLERANCIA = 1e-6

WILDCARD = "*"
