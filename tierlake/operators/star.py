"""Star schema: calendar, patient and lookup dimensions, and fact tables."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierlake.functions import date_key, keyed_pseudonym, pseudonym, to_flag
from tierlake.operators.entity import Run
from tierlake.operators.skew import lookup
from tierlake.operators.surrogate import dense_key
from tierlake.sources.staging import Staging

# Columns of the patient view for reports, and what it must not show.
PATIENT_BI_COLUMNS = (
    "sk_paciente",
    "id_paciente",
    "tipo_documento",
    "numero_documento_hash",
    "sexo",
    "aseguradora",
    "ciudad",
    "estado_paciente",
    "fecha_nacimiento",
    "edad_anios",
)
DIRECT_IDENTIFIERS = ("nombres", "apellidos", "numero_documento")


def calendar_days(days: DataFrame) -> DataFrame:
    """Calendar attributes of a frame with a ``fecha`` date column."""
    day = F.col("fecha")
    return days.select(
        date_key(day).alias("sk_fecha"),
        day,
        F.year(day).alias("anio"),
        F.month(day).alias("mes"),
        F.quarter(day).alias("trimestre"),
        F.date_format(day, "MMMM").alias("nombre_mes"),
        F.dayofweek(day).isin(1, 7).alias("es_fin_semana"),
    )


def calendar(spark: SparkSession, start: date, end: date) -> DataFrame:
    """One row per day, ``start`` to ``end`` inclusive."""
    if end < start:
        raise ValueError(f"calendar ends on {end}, before it starts on {start}")
    days = spark.range(1).select(F.explode(F.sequence(F.lit(start), F.lit(end))).alias("fecha"))
    return calendar_days(days)


def calendar_of(*dates: DataFrame) -> DataFrame:
    """Every day of every year in which a date of the one-column date frames falls.

    A stray date costs its own year only, so no span between extremes is ever filled.
    """
    years = None
    for frame in dates:
        found = frame.select(F.year(F.col(frame.columns[0])).alias("anio")).where(F.col("anio").isNotNull()).distinct()
        years = found if years is None else years.unionByName(found)
    first, last = F.make_date("anio", F.lit(1), F.lit(1)), F.make_date("anio", F.lit(12), F.lit(31))
    return calendar_days(years.distinct().select(F.explode(F.sequence(first, last)).alias("fecha")))


def describe_patients(patients: DataFrame, salt: str | None = None, key: bytes | None = None) -> DataFrame:
    """Patient attributes by allow-list: names never enter, the document number only as a hash, keyed
    if there is a key."""
    document = "numero_documento"
    hashed = pseudonym(document, salt) if key is None else keyed_pseudonym(document, key)
    return patients.select(
        "id_paciente",
        "tipo_documento",
        hashed.alias("numero_documento_hash"),
        "sexo",
        "aseguradora",
        "ciudad",
        F.col("estado").alias("estado_paciente"),
        "fecha_nacimiento",
        "edad_anios",
    )


def dim_patient(
    patients: DataFrame, run: Run, staging: Staging, salt: str | None = None, key: bytes | None = None
) -> DataFrame:
    """Patient dimension: described patients, numbered in the order of their ids."""
    described = describe_patients(patients, salt, key)
    keyed = dense_key(described, "id_paciente", "sk_paciente", staging)
    return keyed.withColumn("_valid_from", run.timestamp())


def patient_bi(dim: DataFrame) -> DataFrame:
    return dim.select(*PATIENT_BI_COLUMNS)


def dim_lookup(df: DataFrame, column: str, key: str, staging: Staging) -> DataFrame:
    """Distinct non-NULL values with an ordinal key. NULL gets no key: no fact could match it."""
    values = df.select(F.col(column).alias("nombre")).where(F.col("nombre").isNotNull()).distinct()
    return dense_key(values, "nombre", key, staging)


@dataclass(frozen=True)
class FactSpec:
    """Columns of a fact: degenerate ones, date keys, 0/1 measures and looked-up keys."""

    name: str
    entity: str
    pk: str
    keep: tuple[str, ...]
    date_keys: Mapping[str, str]
    flags: Mapping[str, str]
    lookups: Mapping[str, str]  # column -> key column of its lookup dimension
    cluster_by: tuple[str, ...]


FACT_CITAS = FactSpec(
    name="fact_citas",
    entity="citas",
    pk="id_cita",
    keep=(
        "id_cita",
        "id_paciente",
        "especialidad",
        "sede",
        "tipo_cita",
        "estado_cita",
        "fecha_hora_cita",
        "fecha_cita",
    ),
    date_keys={"sk_fecha_cita": "fecha_cita"},
    flags={
        "es_atendida": "es_cita_atendida",
        "es_cancelada": "es_cita_cancelada",
        "es_no_asistencia": "es_no_asistencia",
    },
    lookups={"especialidad": "sk_especialidad", "sede": "sk_sede"},
    cluster_by=("sk_fecha_cita", "sk_paciente"),
)

FACT_EVENTOS = FactSpec(
    name="fact_eventos_clinicos",
    entity="eventos_clinicos",
    pk="id_evento",
    keep=(
        "id_evento",
        "id_cita",
        "tipo_evento",
        "estado_evento",
        "fecha_hora_evento",
        "valor_resultado",
    ),
    date_keys={"sk_fecha_evento": "fecha_hora_evento"},
    flags={"tiene_resultado": "tiene_resultado"},
    lookups={"tipo_evento": "sk_tipo_evento"},
    cluster_by=("sk_fecha_evento", "sk_paciente"),
)

FACT_FACTURACION = FactSpec(
    name="fact_facturacion",
    entity="facturacion",
    pk="id_factura",
    keep=(
        "id_factura",
        "id_cita",
        "tipo_servicio",
        "pagador",
        "fecha_factura",
        "fecha_factura_date",
        "valor_bruto",
        "valor_descuento",
        "valor_neto",
        "monto_cartera",
        "estado_pago",
    ),
    date_keys={"sk_fecha_factura": "fecha_factura_date"},
    flags={"es_factura_anulada": "es_factura_anulada"},
    lookups={"tipo_servicio": "sk_tipo_servicio", "pagador": "sk_pagador"},
    cluster_by=("sk_fecha_factura", "sk_paciente"),
)

FACTS = (FACT_CITAS, FACT_EVENTOS, FACT_FACTURACION)
LOOKUP_DIMS = {
    "especialidad": "dim_especialidad",
    "sede": "dim_sede",
    "tipo_servicio": "dim_tipo_servicio",
    "pagador": "dim_pagador",
    "tipo_evento": "dim_tipo_evento",
}


def columns_read(spec: FactSpec) -> list[str]:
    """Columns of an entity's rows that its fact is built from."""
    read = (*spec.keep, spec.pk, "id_paciente", *spec.lookups, *spec.date_keys.values(), *spec.flags.values())
    return list(dict.fromkeys(read))


def build_fact(
    spec: FactSpec,
    rows: DataFrame,
    patients: DataFrame,
    lookups: Mapping[str, DataFrame],
    run: Run,
    heavy_patients: DataFrame | None = None,
) -> DataFrame:
    """Resolve surrogate keys: patients inner (rows without one drop out), lookups left.

    Lookup dimensions carry no broadcast hint: they are scans of staged or stored tables, so
    Spark knows their size and broadcasts them exactly when that is safe.
    """
    keys = patients.select("id_paciente", "sk_paciente")
    df = lookup(rows, keys, "id_paciente", heavy_patients, [spec.pk])
    df = df.where(F.col("sk_paciente").isNotNull())
    for column, key in spec.lookups.items():
        df = df.join(lookups[column].select(F.col("nombre").alias(column), key), column, "left")
    return df.select(
        *spec.keep,
        "sk_paciente",
        *spec.lookups.values(),
        *[date_key(source).alias(name) for name, source in spec.date_keys.items()],
        *[to_flag(source).alias(name) for name, source in spec.flags.items()],
        run.timestamp().alias("_gold_loaded_at"),
    )
