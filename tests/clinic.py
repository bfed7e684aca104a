"""Small dirty extracts, one row per rule, as text like the sources deliver."""

from tierlake.plans.entities import BY_NAME
from tierlake.sources.readers import text_schema

OLD, MID, NEW = "2026-01-01 08:00:00", "2026-02-01 08:00:00", "2026-03-01 08:00:00"

_DEFAULTS = {
    "pacientes": {
        "tipo_documento": "CC", "numero_documento": "100", "nombres": "Ana", "apellidos": "Paz",
        "fecha_nacimiento": "1990-05-06 00:00:00", "sexo": "F", "aseguradora": "A", "ciudad": "Cali",
        "estado": "Activo", "creado_en": OLD, "actualizado_en": OLD,
    },
    "citas": {
        "id_paciente": "p1", "id_profesional": "m1", "especialidad": "Medicina", "sede": "Norte",
        "fecha_hora_cita": "2026-01-15 09:30:00", "tipo_cita": "Control", "estado_cita": "Atendida",
        "creado_en": OLD, "actualizado_en": OLD,
    },
    "eventos_clinicos": {
        "id_cita": "c1", "id_paciente": "p1", "tipo_evento": "Diagnóstico", "codigo_evento": "D1",
        "descripcion_evento": "x", "fecha_hora_evento": "2026-01-15 10:00:00", "valor_resultado": "1.5",
        "unidad_resultado": "mg", "estado_evento": "Finalizado", "creado_en": OLD, "actualizado_en": OLD,
    },
    "facturacion": {
        "id_paciente": "p1", "id_cita": "c1", "tipo_servicio": "Consulta", "pagador": "EPS",
        "fecha_factura": "2026-01-16 00:00:00", "valor_bruto": "100.00", "valor_descuento": "10.00",
        "valor_neto": "90.00", "estado_pago": "Pagado", "creado_en": OLD, "actualizado_en": OLD,
    },
}

ROWS = {
    "pacientes": [
        {"id_paciente": " p1 "},
        {"id_paciente": "p2", "ciudad": "nan", "sexo": "M"},
        {"id_paciente": "p3", "fecha_nacimiento": "00:00:00"},
        {"id_paciente": "p4", "fecha_nacimiento": "abc"},
        {"id_paciente": "p5", "fecha_nacimiento": None},
        {"id_paciente": "p6", "sexo": "X"},
        {"id_paciente": "p7", "sexo": None},
        {"id_paciente": "p8", "actualizado_en": OLD, "estado": "Activo"},
        {"id_paciente": "p8", "actualizado_en": MID, "estado": "Inactivo"},
        {"id_paciente": "p8", "actualizado_en": "nan", "estado": "Perdido"},
        {"id_paciente": "Nan"},
        *[{"id_paciente": k} for k in ("", "  ", "nan", "None", "NaT", "null", "NULL", None)],
    ],
    "citas": [
        {"id_cita": "c1"},
        {"id_cita": "c2", "id_paciente": "p2", "estado_cita": "Cancelada", "motivo_cancelacion": "clima"},
        {"id_cita": "c3", "estado_cita": "Cancelada", "motivo_cancelacion": None},
        {"id_cita": "c4", "estado_cita": "No asistió", "motivo_cancelacion": "sobra"},
        {"id_cita": "c5", "id_paciente": "zz"},
        {"id_cita": "c6", "id_paciente": None},
        {"id_cita": "c7", "fecha_hora_cita": "2026"},
        {"id_cita": "c8", "id_paciente": "p3"},
        {"id_cita": "c9", "especialidad": None, "id_profesional": "None", "sede": ""},
    ],
    "eventos_clinicos": [
        {"id_evento": "e1"},
        {"id_evento": "e2", "valor_resultado": "nan"},
        {"id_evento": "e3", "valor_resultado": "abc"},
        {"id_evento": "e4", "id_cita": "zz", "id_paciente": "zz"},
        {"id_evento": "e5", "id_paciente": "zz"},
        {"id_evento": "e6", "id_paciente": "p2"},
        {"id_evento": "e7", "fecha_hora_evento": "ayer"},
        {"id_evento": "e8", "id_cita": "c5"},
        {"id_evento": "e9", "id_paciente": None},
    ],
    "facturacion": [
        {"id_factura": "f1"},
        {"id_factura": "f2", "valor_neto": "90.01"},
        {"id_factura": "f3", "valor_bruto": "-5", "valor_descuento": "0", "valor_neto": "-5"},
        {"id_factura": "f4", "valor_descuento": "N/A"},
        {"id_factura": "f5", "id_paciente": "zz", "id_cita": "zz"},
        {"id_factura": "f6", "id_cita": "c8"},
        {"id_factura": "f7", "fecha_factura": None},
        {"id_factura": "f8", "estado_pago": "Pago parcial", "pagador": "NULL"},
        {"id_factura": "f9", "estado_pago": "Cancelado"},
    ],
}

REASONS = {
    "pacientes": {
        "p3": "fecha_nacimiento no parseable",
        "p4": "fecha_nacimiento no parseable",
        "p6": "sexo fuera de dominio F/M",
    },
    "citas": {
        "c5": "FK id_paciente inexistente",
        "c6": "FK id_paciente inexistente",
        "c7": "PK o fecha_hora_cita inválida",
        "c8": "FK id_paciente inexistente",
    },
    "eventos_clinicos": {
        "e4": "FK id_cita inexistente",
        "e5": "FK id_paciente inexistente",
        "e6": "id_paciente no coincide con cita",
        "e7": "PK o fecha_hora_evento inválida",
        "e8": "FK id_cita inexistente",
        "e9": "FK id_paciente inexistente",
    },
    "facturacion": {
        "f2": "Regla financiera o montos negativos",
        "f3": "Regla financiera o montos negativos",
        "f4": "Regla financiera o montos negativos",
        "f5": "FK id_paciente inexistente",
        "f6": "FK id_cita inexistente",
        "f7": "PK o fecha_factura inválida",
    },
}


def extract(spark, entity, rows=None):
    columns = BY_NAME[entity].columns
    full = [{**_DEFAULTS[entity], **row} for row in (ROWS[entity] if rows is None else rows)]
    return spark.createDataFrame([tuple(r.get(c) for c in columns) for r in full], text_schema(columns))


def extracts(spark):
    return {entity: extract(spark, entity) for entity in ROWS}
