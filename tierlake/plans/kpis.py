"""Operational, clinical and financial indicators over the star schema."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierlake.functions import UNKNOWN, ratio, zero_filled
from tierlake.operators.star import PATIENT_BI_COLUMNS

# Names of the month columns, and below those of the three published views.
MONTH = ("anio", "mes")


def _rows() -> Column:
    return F.count(F.lit(1))


def _live_income() -> Column:
    """Net amount of invoices that are not void."""
    return F.sum(F.when(F.col("es_factura_anulada") == 0, F.col("valor_neto")).otherwise(F.lit(0)))


def with_month(fact: DataFrame, date_key: str) -> DataFrame:
    """Fact rows with year and month, taken from the date key itself: no date is left out, and
    rows without a date keep a NULL month."""
    key = F.col(date_key)
    return fact.withColumns(
        {"anio": F.floor(key / 10000).cast("int"), "mes": (F.floor(key / 100) % 100).cast("int")}
    )


def in_calendar(fact: DataFrame, calendar: DataFrame, date_key: str, how: str = "inner") -> DataFrame:
    """Fact rows with the calendar's year and month, as the published views define them.

    A left join keeps dates outside the calendar with a NULL month; an inner join drops them. The
    calendar is a stored table of days, so Spark sees its size and broadcasts it when that is safe.
    """
    months = calendar.select(F.col("sk_fecha").alias("_day"), *MONTH)
    return fact.join(months, F.col(date_key) == F.col("_day"), how)


# --- the three published views -------------------------------------------------------------


def appointment_operations(appointments: DataFrame, calendar: DataFrame) -> DataFrame:
    return (
        in_calendar(appointments, calendar, "sk_fecha_cita", "left")
        .groupBy("fecha_cita", *MONTH, "especialidad", "sede", "estado_cita")
        .agg(
            _rows().alias("total_citas"),
            F.sum("es_atendida").alias("citas_atendidas"),
            F.sum("es_cancelada").alias("citas_canceladas"),
            F.sum("es_no_asistencia").alias("citas_no_asistencia"),
        )
    )


def billing_monthly(billing: DataFrame, calendar: DataFrame) -> DataFrame:
    return (
        in_calendar(billing, calendar, "sk_fecha_factura", "left")
        .groupBy(*MONTH, "pagador", "tipo_servicio")
        .agg(
            F.sum("valor_bruto").alias("total_bruto"),
            F.sum("valor_descuento").alias("total_descuento"),
            F.sum("valor_neto").alias("total_neto"),
            _live_income().alias("ingreso_neto_vigente"),
            F.sum("monto_cartera").alias("cartera_pendiente"),
            _rows().alias("lineas_factura"),
        )
    )


def monthly_summary(
    appointments: DataFrame,
    billing: DataFrame,
    calendar: DataFrame,
    unique_appointments: bool = False,
) -> DataFrame:
    """Executive summary per month: appointments and billing joined on both sides.

    Appointments are counted distinct by id. With ``unique_appointments`` the caller vouches for
    one row per id (a fact built from a deduplicated table), and a plain count gives the same
    number without shuffling every id.
    """
    ids = F.count("id_cita") if unique_appointments else F.count_distinct("id_cita")
    visits = (
        in_calendar(appointments, calendar, "sk_fecha_cita")
        .groupBy(*MONTH)
        .agg(
            ids.alias("total_citas"),
            F.sum("es_atendida").alias("citas_atendidas"),
            F.sum("es_cancelada").alias("citas_canceladas"),
            F.sum("es_no_asistencia").alias("citas_no_asistencia"),
        )
    )
    money = (
        in_calendar(billing, calendar, "sk_fecha_factura")
        .groupBy(*MONTH)
        .agg(
            _live_income().alias("ingreso_neto"),
            F.sum("monto_cartera").alias("cartera_pendiente"),
            F.count("id_factura").alias("lineas_factura"),
        )
    )
    counts = ("total_citas", "citas_atendidas", "citas_canceladas", "citas_no_asistencia")
    both = visits.join(money, list(MONTH), "full_outer").select(
        *MONTH,
        *[zero_filled(c).alias(c) for c in (*counts, "ingreso_neto", "cartera_pendiente", "lineas_factura")],
    )
    closed = F.col("citas_atendidas") + F.col("citas_canceladas") + F.col("citas_no_asistencia")
    return both.select(
        *MONTH,
        *counts,
        ratio("citas_atendidas", closed, 4).alias("tasa_asistencia"),
        ratio("citas_canceladas", "total_citas", 4).alias("tasa_cancelacion"),
        "ingreso_neto",
        "cartera_pendiente",
        ratio("ingreso_neto", "lineas_factura", 2).alias("ticket_promedio"),
    )


# --- appointments ----------------------------------------------------------------------------


def rows_by(df: DataFrame, *columns: str) -> DataFrame:
    """Row counts by the given columns."""
    return df.groupBy(*columns).agg(_rows().alias("total"))


def appointment_rates(appointments: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """Volume, attendance, cancellation and no-show rates, and attended share of all."""
    sums = appointments.groupBy(*by).agg(
        _rows().alias("total_citas"),
        F.sum("es_atendida").alias("_attended"),
        F.sum("es_cancelada").alias("_cancelled"),
        F.sum("es_no_asistencia").alias("_missed"),
    )
    closed = F.col("_attended") + F.col("_cancelled") + F.col("_missed")
    return sums.select(
        *by,
        "total_citas",
        ratio("_attended", closed, 4).alias("tasa_asistencia"),
        ratio("_cancelled", "total_citas", 4).alias("tasa_cancelacion"),
        ratio("_missed", "total_citas", 4).alias("tasa_no_asistencia"),
        ratio("_attended", "total_citas", 4).alias("atendidas_sobre_total"),
    )


#: Grains of the appointment indicators, from months by site to the whole.
APPOINTMENT_GRAINS = (
    (*MONTH, "sede"),
    (*MONTH, "especialidad"),
    (*MONTH, "estado_cita"),
    MONTH,
    ("tipo_cita",),
    ("sede",),
    ("especialidad",),
    (),
)


def appointment_rates_by_grain(appointments: DataFrame, grains: Iterable[Iterable[str]] = APPOINTMENT_GRAINS) -> DataFrame:
    """The rates at several grains from one scan, told apart by ``grain``.

    ``grain`` has a bit for each column that occurs in a grain, in the order of first mention, the
    first highest: 1 where the column is rolled up, 0 where NULL is a value. Rows are summed by
    all columns first; only those few sums are multiplied by the grains.
    """
    listed = [tuple(g) for g in grains]
    by = list(dict.fromkeys(c for grain in listed for c in grain))
    flags = {"es_atendida": "_attended", "es_cancelada": "_cancelled", "es_no_asistencia": "_missed"}
    finest = appointments.groupBy(*by).agg(_rows().alias("_rows"), *[F.sum(c).alias(name) for c, name in flags.items()])
    sums = finest.groupingSets([[F.col(c) for c in grain] for grain in listed], *by).agg(
        F.grouping_id().cast("long").alias("grain"),
        F.sum("_rows").alias("total_citas"),
        *[F.sum(name).alias(name) for name in flags.values()],
    )
    closed = F.col("_attended") + F.col("_cancelled") + F.col("_missed")
    return sums.select(
        "grain",
        *by,
        "total_citas",
        ratio("_attended", closed, 4).alias("tasa_asistencia"),
        ratio("_cancelled", "total_citas", 4).alias("tasa_cancelacion"),
        ratio("_missed", "total_citas", 4).alias("tasa_no_asistencia"),
    )


def appointment_reach(appointments: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """Distinct patients with an appointment, and appointments per such patient."""
    return (
        appointments.groupBy(*by)
        .agg(
            _rows().alias("total_citas"),
            F.count_distinct("id_paciente").alias("pacientes_con_cita"),
        )
        .withColumn("citas_por_paciente", ratio("total_citas", "pacientes_con_cita", 4))
    )


def top_specialties(appointments: DataFrame, n: int = 5) -> DataFrame:
    return (
        rows_by(appointments.where(F.col("especialidad").isNotNull()), "especialidad")
        .orderBy(F.desc("total"), "especialidad")
        .limit(n)
    )


# --- clinical events -------------------------------------------------------------------------


def event_completion(events: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """Events, finalised share and share with a numeric result."""
    return (
        events.groupBy(*by)
        .agg(
            _rows().alias("total_eventos"),
            F.count_if(F.col("estado_evento") == "Finalizado").alias("_final"),
            F.sum("tiene_resultado").alias("_measured"),
        )
        .select(
            *by,
            "total_eventos",
            ratio("_final", "total_eventos", 4).alias("pct_finalizados"),
            ratio("_measured", "total_eventos", 4).alias("pct_con_resultado"),
        )
    )


def events_per_appointment(events: DataFrame, by: tuple[str, ...]) -> DataFrame:
    return (
        events.groupBy(*by)
        .agg(_rows().alias("total_eventos"), F.count_distinct("id_cita").alias("citas_con_evento"))
        .withColumn("eventos_por_cita", ratio("total_eventos", "citas_con_evento", 4))
    )


def documented_appointments(appointments: DataFrame, events: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """Share of attended appointments with at least one event."""
    seen = events.select("id_cita").distinct().withColumn("_event", F.lit(1))
    return (
        appointments.where("es_atendida = 1")
        .join(seen, "id_cita", "left")
        .groupBy(*by)
        .agg(_rows().alias("citas_atendidas"), F.count("_event").alias("citas_con_evento"))
        .withColumn("cobertura_clinica", ratio("citas_con_evento", "citas_atendidas", 4))
    )


def appointment_to_event_hours(appointments: DataFrame, events: DataFrame) -> DataFrame:
    """Time from an appointment to its events, by event type.

    Events are summed up per appointment before the join, so an appointment with very many of
    them crosses the network as one row per task.
    """
    at = F.unix_timestamp("fecha_hora_evento")
    per_visit = (
        events.where(F.col("fecha_hora_evento").isNotNull())
        .groupBy("id_cita", "tipo_evento")
        .agg(_rows().alias("_n"), F.sum(at).alias("_sum"), F.min(at).alias("_min"), F.max(at).alias("_max"))
    )
    start = F.unix_timestamp("fecha_hora_cita")
    return (
        per_visit.join(appointments.select("id_cita", start.alias("_start")), "id_cita")
        .groupBy("tipo_evento")
        .agg(
            F.sum("_n").alias("total_eventos"),
            F.sum(F.col("_sum") - F.col("_n") * F.col("_start")).alias("_seconds"),
            F.min(F.col("_min") - F.col("_start")).alias("segundos_min"),
            F.max(F.col("_max") - F.col("_start")).alias("segundos_max"),
        )
        .select(
            "tipo_evento",
            "total_eventos",
            F.round(F.col("_seconds") / F.col("total_eventos") / 3600, 2).alias("horas_promedio"),
            "segundos_min",
            "segundos_max",
        )
    )


# --- billing ---------------------------------------------------------------------------------


def billing_totals(billing: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """Amounts, discount share, receivables and the two average tickets.

    ``ticket_vigente`` divides non-void income by all lines, as the summary view does;
    ``ticket_total`` divides all net amounts by all lines, as the written definition says.
    """
    return (
        billing.groupBy(*by)
        .agg(
            F.sum("valor_bruto").alias("bruto"),
            F.sum("valor_descuento").alias("descuento"),
            F.sum("valor_neto").alias("neto"),
            _live_income().alias("ingreso_neto"),
            F.sum("monto_cartera").alias("cartera_pendiente"),
            _rows().alias("lineas_factura"),
        )
        .withColumns(
            {
                "pct_descuento": ratio("descuento", "bruto", 4),
                "ticket_vigente": ratio("ingreso_neto", "lineas_factura", 2),
                "ticket_total": ratio("neto", "lineas_factura", 2),
            }
        )
    )


def billing_per_attended(appointments: DataFrame, billing: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """Net billing of attended appointments per attended appointment.

    Billing is summed per appointment first; that aggregate is already laid out for the join.
    """
    per_visit = billing.groupBy("id_cita").agg(F.sum("valor_neto").alias("_net"))
    return (
        appointments.where("es_atendida = 1")
        .join(per_visit, "id_cita", "left")
        .groupBy(*by)
        .agg(_rows().alias("citas_atendidas"), zero_filled(F.sum("_net")).alias("neto_atendidas"))
        .withColumn("neto_por_cita_atendida", ratio("neto_atendidas", "citas_atendidas", 2))
    )


# --- patients --------------------------------------------------------------------------------


def active_patients(patients: DataFrame) -> DataFrame:
    return patients.where("estado_paciente = 'Activo'").agg(
        F.count_distinct("id_paciente").alias("pacientes_activos")
    )


def patients_by_city(patients: DataFrame, unknown: str = UNKNOWN) -> DataFrame:
    return rows_by(patients.where(F.col("ciudad") != unknown), "ciudad")


def patients_without_appointments(patients: DataFrame, appointments: DataFrame) -> DataFrame:
    """Patients with no appointment among the given ones (filter those to a period first)."""
    return patients.join(appointments.select("id_paciente").distinct(), "id_paciente", "left_anti")


def mean_age_by_specialty(patients: DataFrame, appointments: DataFrame) -> DataFrame:
    """Mean age of the distinct patients attended in each specialty."""
    attended = (
        appointments.where("es_atendida = 1").select("especialidad", "id_paciente").distinct()
    )
    return (
        attended.join(patients.select("id_paciente", "edad_anios"), "id_paciente")
        .groupBy("especialidad")
        .agg(_rows().alias("pacientes"), F.round(F.avg("edad_anios"), 4).alias("edad_promedio"))
    )


# --- runs ------------------------------------------------------------------------------------


def run_health(rejects: DataFrame, checks: DataFrame, runs: DataFrame, batch_id: str) -> DataFrame:
    """Rejected rows and failed critical checks of a run, and the last successful load."""
    parts = (
        rejects.where(F.col("_batch_id") == batch_id)
        .agg(_rows().cast("string").alias("value"))
        .withColumn("metric", F.lit("rejected_rows")),
        checks.where((F.col("batch_id") == batch_id) & (F.col("severity") == "CRIT"))
        .agg(F.count_if(~F.col("passed")).cast("string").alias("value"))
        .withColumn("metric", F.lit("failed_critical_checks")),
        runs.where((F.col("stage") == "bronze") & (F.col("status") == "success"))
        .agg(F.date_format(F.max("ended_at"), "yyyy-MM-dd HH:mm:ss").alias("value"))
        .withColumn("metric", F.lit("last_successful_load")),
    )
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).select("metric", "value")


# The published views' names, columns and rules.
_VIEWS = {
    "v_kpi_operacion_citas": """
        SELECT fecha_cita, anio, mes, especialidad, sede, estado_cita, count(*) AS total_citas, sum(es_atendida) AS citas_atendidas,
          sum(es_cancelada) AS citas_canceladas, sum(es_no_asistencia) AS citas_no_asistencia
        FROM {db}.fact_citas LEFT JOIN {db}.dim_tiempo ON sk_fecha_cita = sk_fecha
        GROUP BY fecha_cita, anio, mes, especialidad, sede, estado_cita""",
    "v_kpi_facturacion_mensual": """
        SELECT anio, mes, pagador, tipo_servicio, sum(valor_bruto) AS total_bruto, sum(valor_descuento) AS total_descuento,
          sum(valor_neto) AS total_neto, sum(CASE WHEN es_factura_anulada = 0 THEN valor_neto ELSE 0 END) AS ingreso_neto_vigente,
          sum(monto_cartera) AS cartera_pendiente, count(*) AS lineas_factura
        FROM {db}.fact_facturacion LEFT JOIN {db}.dim_tiempo ON sk_fecha_factura = sk_fecha
        GROUP BY anio, mes, pagador, tipo_servicio""",
    "summary": """
        WITH visits AS (
          SELECT anio, mes, count(id_cita) AS total_citas, sum(es_atendida) AS attended, sum(es_cancelada) AS cancelled,
            sum(es_no_asistencia) AS missed
          FROM {db}.fact_citas JOIN {db}.dim_tiempo ON sk_fecha_cita = sk_fecha GROUP BY anio, mes
        ), money AS (
          SELECT anio, mes, sum(CASE WHEN es_factura_anulada = 0 THEN valor_neto ELSE 0 END) AS income,
            sum(monto_cartera) AS due, count(id_factura) AS lines
          FROM {db}.fact_facturacion JOIN {db}.dim_tiempo ON sk_fecha_factura = sk_fecha GROUP BY anio, mes
        )
        SELECT anio, mes, coalesce(total_citas, 0) AS total_citas, coalesce(attended, 0) AS citas_atendidas,
          coalesce(cancelled, 0) AS citas_canceladas, coalesce(missed, 0) AS citas_no_asistencia,
          round(attended / nullif(attended + cancelled + missed, 0), 4) AS tasa_asistencia,
          round(cancelled / nullif(total_citas, 0), 4) AS tasa_cancelacion,
          coalesce(income, 0) AS ingreso_neto, coalesce(due, 0) AS cartera_pendiente,
          round(income / nullif(lines, 0), 2) AS ticket_promedio
        FROM visits FULL JOIN money USING (anio, mes)""",
}


def create_kpi_views(spark: SparkSession, database: str = "gold", summary_view: str = "v_kpi_resumen") -> None:
    """Views in the catalog over published gold tables, for every session that shares it."""
    views = {summary_view if name == "summary" else name: text.format(db=database) for name, text in _VIEWS.items()}
    views["dim_paciente_bi"] = f"SELECT {', '.join(PATIENT_BI_COLUMNS)} FROM {database}.dim_paciente"
    for name, text in views.items():
        spark.sql(f"CREATE OR REPLACE VIEW {database}.{name} AS {text}")
