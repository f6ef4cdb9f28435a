"""Table shapes and the fixed values the indicator rules depend on."""

from pyspark.sql import types as T

# --- fixed values -----------------------------------------------------------

# States whose time counts against the limit (spelled as the desk exports them).
WORKING_STATES = (
    "En Validación",
    "En gestión",
    "En validación",
    "En Gestión",
    "Validación",
)

# A row in one of these states opens a new ticket.
CREATE_STATES = ("Crear ticket", "Crear Ticket")

# Text written where a value is missing.
NO_NEXT = "Nan"
NO_DATE = "0"

SLA_DAYS = 5.0
HOLIDAY_YEARS = (2020,)

INDICATOR_TYPES = ("Q", "ANS", "KPI")
ALL_REQUESTS = "Todas"

# Flow and request names that differ between the category table and the tickets.
NAME_REPAIRS = {
    "Alta de obras en plan SGT y GODA": "Alta de obras de plan SGT y GODA",
    "Alta solicitudes": "Altas Solicitudes",
    "Propuestas de Inversión PIs PGAs": "Propuestas de inversión PIs PGAs",
    "Órdenes de trabajo OTs": "Ordenes de trabajo OTs",
    "Ordenes de Entrega y Certificaciones": "Ordenes Entrega y Certificaciones",
}

# The same for whole project_flow_request keys.
KEY_REPAIRS = {
    "SSPP Gestión económica_Órdenes de trabajo OTs_Todas": "SSPP Gestión económica_Ordenes de trabajo OTs_Todas",
    "SSPP Operaciones_SGT_Alta de obras en plan SGT y GODA": "SSPP Operaciones_SGT_Alta de obras de plan SGT y GODA",
    "SSPP Operaciones_SGM_Alta solicitudes": "SSPP Operaciones_SGM_Altas Solicitudes",
    "SSPP Operaciones_SGT_Adjudicación de trabajos en SGT ": "SSPP Operaciones_SGT_Adjudicación de trabajos en SGT",
    "SSPP Operaciones_SGT_Modificación trabajos en SGT ": "SSPP Operaciones_SGT_Modificación trabajos en SGT",
    "SSPP Operaciones_SGM_Anulación y Modificación Solicitudes ": "SSPP Operaciones_SGM_Anulación y Modificación Solicitudes",
    "SSPP Operaciones_SGM_Solicitud de Verificación de Reformados ": "SSPP Operaciones_SGM_Solicitud de Verificación de Reformados",
    "SSPP Recursos Medios y Servicios_Vehículos_Todas ": "SSPP Recursos Medios y Servicios_Vehículos_Todas",
    "SSPP Compras_Ordenes de Entrega y Certificaciones_Todas": "SSPP Compras_Ordenes Entrega y Certificaciones_Todas",
}

# --- shapes: fixed values too, column names and types of the tables ---------------


def _fields(spec):
    return T.StructType([T.StructField(name, kind, True) for name, kind in spec])


_TEXT, _LONG, _DOUBLE = T.StringType(), T.LongType(), T.DoubleType()

HISTORY = _fields(
    [("id_ticket", _TEXT), ("estado", _TEXT), ("fecha", _TEXT), ("date", _TEXT), ("row_seq", _LONG)]
)

HOLIDAYS = _fields([("date", _TEXT)])

DESCRIPTION = _fields(
    [
        ("id_ticket", _TEXT),
        ("proyecto", _TEXT),
        ("flujo", _TEXT),
        ("tipo_solicitud", _TEXT),
        ("volumen_total_casos", _DOUBLE),
        ("total_casos_ok", _DOUBLE),
        ("user_name", _TEXT),
        ("date", _TEXT),
    ]
)

CATEGORIES = _fields(
    [
        (name, _TEXT)
        for name in (
            "id_indicador",
            "tipo_indicador",
            "nombre_indicador",
            "proyecto",
            "id_grupo",
            "flujo",
            "tipo_solicitud",
            "fichero",
            "id_pro_flu_sol",
        )
    ]
)

DETAIL_COLUMNS = (
    "id_ticket",
    "estado",
    "fecha",
    "date_particion",
    "Estadofinal",
    "FechaFinal",
    "date",
    "dias_festivos",
    "diferencia_tiempo_dias",
    "diferencia_tiempo_festivos",
)

VERDICT_COLUMNS = (
    "id_ticket",
    "date",
    "Diferencia_tiempo",
    "dias_festivos",
    "diferencia_tiempo_festivos",
    "Diferencia_tiempo_dias",
    "ok_ko",
)

# The standard indicator row as it is landed and published.
STANDARD = _fields(
    [
        ("tipo_reg", _LONG),
        ("id", _TEXT),
        ("nombre", _TEXT),
        ("fecha", _TEXT),
        ("valor", _TEXT),
        ("valor_ant", _TEXT),
        ("medida1", _TEXT),
        ("medida2", _TEXT),
        ("medida3", _TEXT),
        ("aplicación_proceso", _TEXT),
        ("alegación", _TEXT),
        ("calibración", _LONG),
        ("descripción", _TEXT),
    ]
)
STANDARD_COLUMNS = tuple(STANDARD.fieldNames())
STANDARD_KEY = ("id", "fecha", "aplicación_proceso")

# Once landed, calibración is text.
PUBLISHED = T.StructType(
    [T.StructField(f.name, _TEXT if f.name == "calibración" else f.dataType, True) for f in STANDARD]
)

# The computed indicators use the same row without accents and with a number in valor.
INDICATOR_COLUMNS = (
    "tipo_reg",
    "id",
    "nombre",
    "fecha",
    "valor",
    "valor_ant",
    "medida1",
    "medida2",
    "medida3",
    "aplicacion_proceso",
    "alegacion",
    "calibracion",
    "descripcion",
)
