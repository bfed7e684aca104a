"""The four clinic entities: patients, appointments, clinical events and billing lines.

Fixed values: column names, domain values and reject reasons are data that results carry.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tierlake.functions import (
    amounts_balance,
    age_in_years,
    canonical_number,
    clean_text,
    is_set,
    known_text,
    measure,
    money,
    non_negative,
    only_when,
    parse_date,
    parse_timestamp,
)
from tierlake.operators.entity import EntitySpec, ParentRef, Rule

CURSOR = "actualizado_en"
APPOINTMENT_STATES = ("Atendida", "Programada", "Cancelada", "No asistió")
OTHER_STATE = "OTRO"
SEXES = ("F", "M")
OPEN_PAYMENT_STATES = ("Pendiente", "Pago parcial")

_AUDIT = {"creado_en": parse_timestamp, "actualizado_en": parse_timestamp}

PACIENTES = EntitySpec(
    name="pacientes",
    pk="id_paciente",
    cursor=CURSOR,
    columns=(
        "id_paciente",
        "tipo_documento",
        "numero_documento",
        "nombres",
        "apellidos",
        "fecha_nacimiento",
        "sexo",
        "aseguradora",
        "ciudad",
        "estado",
        "creado_en",
        "actualizado_en",
    ),
    casts={
        "numero_documento": canonical_number,
        "fecha_nacimiento": parse_date,
        "ciudad": known_text,
        **_AUDIT,
    },
    from_raw={
        "_bad_birth_date": lambda: clean_text("fecha_nacimiento").isNotNull()
        & parse_date("fecha_nacimiento").isNull(),
    },
    derived=({"edad_anios": lambda run: age_in_years("fecha_nacimiento", run.as_of)},),
    rules=(
        Rule("PK id_paciente nula", lambda: F.col("id_paciente").isNull()),
        Rule("fecha_nacimiento no parseable", lambda: F.col("_bad_birth_date")),
        Rule("sexo fuera de dominio F/M", lambda: ~F.col("sexo").isin(*SEXES), when_unknown=False),
    ),
    scratch=("_bad_birth_date",),
)

_PATIENT_REF = ParentRef("id_paciente", "pacientes", "id_paciente", "_patient_found")

CITAS = EntitySpec(
    name="citas",
    pk="id_cita",
    cursor=CURSOR,
    columns=(
        "id_cita",
        "id_paciente",
        "id_profesional",
        "especialidad",
        "sede",
        "fecha_hora_cita",
        "tipo_cita",
        "estado_cita",
        "motivo_cancelacion",
        "creado_en",
        "actualizado_en",
    ),
    casts={"sede": known_text, "fecha_hora_cita": parse_timestamp, **_AUDIT},
    derived=(
        {
            "es_cita_cancelada": lambda run: F.col("estado_cita") == "Cancelada",
            "es_no_asistencia": lambda run: F.col("estado_cita") == "No asistió",
            "es_cita_atendida": lambda run: F.col("estado_cita") == "Atendida",
            "sin_profesional_asignado": lambda run: ~is_set("id_profesional"),
            "fecha_cita": lambda run: F.to_date("fecha_hora_cita"),
        },
        {
            "motivo_cancelacion": lambda run: only_when(
                F.col("es_cita_cancelada"), "motivo_cancelacion"
            ),
        },
        {
            "motivo_cancelacion_faltante": lambda run: F.col("es_cita_cancelada")
            & ~is_set("motivo_cancelacion"),
        },
    ),
    parents=(_PATIENT_REF,),
    rules=(
        Rule("FK id_paciente inexistente", lambda: F.col("_patient_found").isNull()),
        Rule(
            "PK o fecha_hora_cita inválida",
            lambda: F.col("id_cita").isNull() | F.col("fecha_hora_cita").isNull(),
        ),
    ),
)

EVENTOS = EntitySpec(
    name="eventos_clinicos",
    pk="id_evento",
    cursor=CURSOR,
    columns=(
        "id_evento",
        "id_cita",
        "id_paciente",
        "tipo_evento",
        "codigo_evento",
        "descripcion_evento",
        "fecha_hora_evento",
        "valor_resultado",
        "unidad_resultado",
        "estado_evento",
        "creado_en",
        "actualizado_en",
    ),
    casts={"fecha_hora_evento": parse_timestamp, "valor_resultado": measure, **_AUDIT},
    derived=({"tiene_resultado": lambda run: is_set("valor_resultado")},),
    # One join on the appointment answers both whether it exists and whose it is.
    parents=(
        ParentRef(
            "id_cita", "citas", "id_cita", "_appointment_found", {"id_paciente": "_appointment_patient"}
        ),
        _PATIENT_REF,
    ),
    after_parents={
        "paciente_coherente_con_cita": lambda: F.col("id_paciente") == F.col("_appointment_patient"),
    },
    rules=(
        Rule("FK id_cita inexistente", lambda: F.col("_appointment_found").isNull()),
        Rule("FK id_paciente inexistente", lambda: F.col("_patient_found").isNull()),
        Rule("id_paciente no coincide con cita", lambda: ~F.col("paciente_coherente_con_cita")),
        Rule(
            "PK o fecha_hora_evento inválida",
            lambda: F.col("id_evento").isNull() | F.col("fecha_hora_evento").isNull(),
        ),
    ),
)

FACTURACION = EntitySpec(
    name="facturacion",
    pk="id_factura",
    cursor=CURSOR,
    columns=(
        "id_factura",
        "id_paciente",
        "id_cita",
        "tipo_servicio",
        "pagador",
        "fecha_factura",
        "valor_bruto",
        "valor_descuento",
        "valor_neto",
        "estado_pago",
        "creado_en",
        "actualizado_en",
    ),
    casts={
        "pagador": known_text,
        "fecha_factura": parse_timestamp,
        "valor_bruto": money,
        "valor_descuento": money,
        "valor_neto": money,
        **_AUDIT,
    },
    derived=(
        {
            "fecha_factura_date": lambda run: F.to_date("fecha_factura"),
            "es_factura_anulada": lambda run: F.col("estado_pago") == "Cancelado",
            "monto_cartera": lambda run: F.when(
                F.col("estado_pago").isin(*OPEN_PAYMENT_STATES), F.col("valor_neto")
            ).otherwise(F.lit(0).cast("decimal(18,2)")),
            "ecuacion_financiera_ok": lambda run: amounts_balance(
                "valor_bruto", "valor_descuento", "valor_neto"
            ),
            "montos_no_negativos": lambda run: non_negative(
                "valor_bruto", "valor_descuento", "valor_neto"
            ),
        },
    ),
    parents=(
        _PATIENT_REF,
        ParentRef("id_cita", "citas", "id_cita", "_appointment_found"),
    ),
    rules=(
        Rule("FK id_paciente inexistente", lambda: F.col("_patient_found").isNull()),
        Rule("FK id_cita inexistente", lambda: F.col("_appointment_found").isNull()),
        # Amounts that do not parse leave the verdict unknown, which counts as a violation.
        Rule(
            "Regla financiera o montos negativos",
            lambda: ~F.col("ecuacion_financiera_ok") | ~F.col("montos_no_negativos"),
        ),
        Rule(
            "PK o fecha_factura inválida",
            lambda: F.col("id_factura").isNull() | F.col("fecha_factura").isNull(),
        ),
    ),
)

# Dependency order: parents come before children.
ENTITIES = (PACIENTES, CITAS, EVENTOS, FACTURACION)
BY_NAME = {spec.name: spec for spec in ENTITIES}
