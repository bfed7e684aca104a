"""Registered queries: every operator over the driver tables, in full.

A query takes (session, folder) and returns a frame. Decimals leave as doubles and dates and
times as ISO text, so results compare the same way in any engine.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime, date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierlake.functions import (
    age_in_years,
    as_utc,
    canonical_number,
    clean_text,
    in_domain_or,
    keyed_pseudonym,
    known_text,
    measure,
    money,
    null_like,
    parse_date,
    parse_timestamp,
    pseudonym,
)
from tierlake.operators import profile, quality
from tierlake.operators.colocated import ColocatedTable
from tierlake.operators.dedupe import latest_per_key, newest_first
from tierlake.operators.deltas import DeltaTable
from tierlake.operators.entity import (
    EntitySpec,
    Run,
    add_lineage,
    attach_parents,
    reject_counts,
    split_missing_keys,
    union_rejects,
)
from tierlake.operators import sketches
from tierlake.operators.open_rejects import field, open_rejects, write_open_rejects
from tierlake.operators.history import first_versions, next_versions, observed, version_at, version_key, versions_of
from tierlake.operators.skew import heavy_keys, lookup
from tierlake.operators.star import FACTS, LOOKUP_DIMS, calendar, calendar_of, patient_bi
from tierlake.operators.surrogate import dense_key, stable_key
from tierlake.operators.upsert import BUCKET, mark_missing, overwrite_bucketed, upsert_table
from tierlake.operators.watermark import Watermarks, newer_than
from tierlake.plans import incremental_gold, jobs, kpis
from tierlake.plans.chain import RUN, Chain, chain
from tierlake.plans.entities import APPOINTMENT_STATES, BY_NAME, CURSOR, ENTITIES, OTHER_STATE
from tierlake.plans.feed import STATEMENTS
from tierlake.sources.concurrent import side_by_side
from tierlake.sources.readers import read_as_text
from tierlake.sources.store import LayerStore
from tierlake.streaming import admit_arrivals, distinct_arrivals, upsert_arrivals, with_source_file

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

MONTH = kpis.MONTH
MARK = "1998-06-30 00:00:00"
LATE = "30 days"


def comparable(df: DataFrame) -> DataFrame:
    columns = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        columns.append(c.alias(f.name))
    return df.select(*columns)


def query(build: Callable[[Chain], DataFrame]) -> Query:
    """Register a query under its function's name."""

    def run(spark: SparkSession, tables_dir: str) -> DataFrame:
        return comparable(build(chain(spark, tables_dir)))

    QUERIES[build.__name__] = run
    return run


def _fresh_store(c: Chain) -> LayerStore:
    return LayerStore(c.spark, f"{c.staging.path}/store-{uuid.uuid4().hex[:8]}")


def _labelled(frames: dict[str, DataFrame], name: str) -> DataFrame:
    return reduce(DataFrame.unionByName, [f.withColumn(name, F.lit(k)) for k, f in frames.items()])


# --- sources and bronze --------------------------------------------------------------------------


@query
def orders_read_as_text(c: Chain) -> DataFrame:
    return read_as_text(c.spark, f"{c.dir}/orders.parquet", "parquet")


@query
def lineage_and_row_hash(c: Chain) -> DataFrame:
    return add_lineage(c.raw("facturacion"), RUN, "facturacion").select(
        "id_factura", "_row_hash", "_batch_id", "_source_file", "_ingested_at"
    )


@query
def quarantine_counts(c: Chain) -> DataFrame:
    counted = {
        s.name: c.loaded(s.name).agg(
            F.count_if(~null_like(s.pk)).alias("valid"), F.count_if(null_like(s.pk)).alias("quarantined")
        )
        for s in ENTITIES
    }
    return _labelled(counted, "_entity")


@query
def quarantine_rows(c: Chain) -> DataFrame:
    return union_rejects([c.quarantine(s.name) for s in ENTITIES]).select(
        "_entity", "_reject_reason", "_row_hash", "id_paciente", "id_cita", "id_evento", "id_factura"
    )


@query
def calendar_from_data(c: Chain) -> DataFrame:
    ordered = c.table("orders").select(F.col("o_orderdate").cast("date"))
    shipped = c.table("lineitem").select(F.col("l_shipdate").cast("date"))
    return calendar_of(ordered, shipped)


# --- scalar functions ----------------------------------------------------------------------------


@query
def text_cleaning(c: Chain) -> DataFrame:
    return c.raw("citas").select(
        null_like("id_cita").alias("key_missing"),
        clean_text("id_cita").alias("id_cita"),
        clean_text("id_paciente").alias("id_paciente"),
        clean_text("id_profesional").alias("id_profesional"),
        known_text("sede").alias("sede"),
    )


@query
def timestamp_parsing(c: Chain) -> DataFrame:
    return c.raw("citas").select(
        "id_cita",
        "fecha_hora_cita",
        parse_timestamp("fecha_hora_cita").alias("stamp"),
        parse_date("fecha_hora_cita").alias("day"),
    )


@query
def money_parsing(c: Chain) -> DataFrame:
    return c.raw("facturacion").select(
        "id_factura", *[money(x).alias(x) for x in ("valor_bruto", "valor_descuento", "valor_neto")]
    )


@query
def measure_parsing(c: Chain) -> DataFrame:
    return c.raw("eventos_clinicos").select("id_evento", measure("valor_resultado").alias("valor"))


@query
def canonical_documents(c: Chain) -> DataFrame:
    return c.raw("pacientes").select(
        "numero_documento", canonical_number("numero_documento").alias("canonical")
    )


@query
def state_domain(c: Chain) -> DataFrame:
    mapped = in_domain_or(clean_text("estado_cita"), APPOINTMENT_STATES, OTHER_STATE)
    return c.raw("citas").groupBy(mapped.alias("estado")).agg(F.count(F.lit(1)).alias("rows"))


@query
def zoned_times_to_utc(c: Chain) -> DataFrame:
    text = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return c.table("events").select(
        "event_id",
        as_utc(F.concat(text, F.lit("-05:00"))).alias("from_offset"),
        as_utc(text, "America/Bogota").alias("from_zone"),
    )


@query
def ages_and_pseudonyms(c: Chain) -> DataFrame:
    return c.raw("pacientes").select(
        age_in_years(parse_date("fecha_nacimiento"), RUN.as_of).alias("age"),
        pseudonym(clean_text("numero_documento")).alias("document_hash"),
        pseudonym(clean_text("numero_documento"), salt="s1-").alias("salted_hash"),
    )


@query
def keyed_pseudonyms(c: Chain) -> DataFrame:
    document = clean_text("numero_documento")
    return c.raw("pacientes").select(
        document.alias("document"), keyed_pseudonym(document, b"key of the comparison").alias("document_hash")
    )


# --- silver --------------------------------------------------------------------------------------

_HIDDEN = ("_ingested_at", "_source_file", "_batch_id", "_silver_processed_at")


@query
def clean_pacientes(c: Chain) -> DataFrame:
    return c.cleaned("pacientes").drop(*_HIDDEN)


@query
def clean_citas(c: Chain) -> DataFrame:
    return c.cleaned("citas").drop(*_HIDDEN)


@query
def clean_eventos(c: Chain) -> DataFrame:
    return c.cleaned("eventos_clinicos").drop(*_HIDDEN)


@query
def clean_facturacion(c: Chain) -> DataFrame:
    return c.cleaned("facturacion").drop(*_HIDDEN)


@query
def latest_citas(c: Chain) -> DataFrame:
    return c.latest("citas").select("id_cita", "estado_cita", CURSOR, "_row_hash")


@query
def latest_facturacion(c: Chain) -> DataFrame:
    return c.latest("facturacion").select("id_factura", "valor_neto", CURSOR, "_row_hash")


@query
def tagged_pacientes(c: Chain) -> DataFrame:
    return c.tagged("pacientes").select("id_paciente", "sexo", "fecha_nacimiento", "_reject_reason")


@query
def tagged_citas(c: Chain) -> DataFrame:
    return c.tagged("citas").select("id_cita", "id_paciente", "fecha_hora_cita", "_reject_reason")


@query
def tagged_eventos(c: Chain) -> DataFrame:
    return c.tagged("eventos_clinicos").select(
        "id_evento", "id_cita", "id_paciente", "paciente_coherente_con_cita", "_reject_reason"
    )


@query
def tagged_facturacion(c: Chain) -> DataFrame:
    return c.tagged("facturacion").select(
        "id_factura", "id_cita", "id_paciente", "valor_neto", "_reject_reason"
    )


@query
def rejects_by_reason(c: Chain) -> DataFrame:
    return reject_counts(union_rejects([c.rejects(s.name) for s in ENTITIES]))


@query
def rejects_of_all_entities(c: Chain) -> DataFrame:
    return union_rejects([c.rejects(s.name) for s in ENTITIES]).select(
        "_entity", "_reject_reason", "id_paciente", "id_cita", "id_evento", "id_factura", "valor_bruto"
    )


@query
def open_rejects_of_five_entities(c: Chain) -> DataFrame:
    """Rejects of the four entities, and of suppliers, which no entity declares, in one open table."""
    store = _fresh_store(c)
    for spec in ENTITIES:
        rejected = c.tagged(spec.name).where("_reject_reason IS NOT NULL")
        write_open_rejects(rejected, store, spec.name, RUN.batch_id)
    indebted = c.table("supplier").where("s_acctbal < 0")
    for _ in range(2):
        write_open_rejects(indebted, store, "proveedores", RUN.batch_id, F.lit("Saldo negativo"))
    keys = [field(k).alias(k) for k in ("id_paciente", "id_cita", "id_evento", "id_factura", "s_name")]
    numbers = [field(n, "double").alias(n) for n in ("valor_bruto", "s_acctbal")]
    return open_rejects(store).select("_entity", "_batch_id", "_reject_reason", *keys, *numbers, field("s_nationkey", "bigint").alias("s_nationkey"))


@query
def row_conservation(c: Chain) -> DataFrame:
    """Rows in = older versions + valid + rejected, per entity."""

    def count(s) -> DataFrame:
        sides = c.bronze(s.name).select(F.lit(1).alias("i"), F.lit(0).alias("v"), F.lit(0).alias("r")).unionAll(
            c.tagged(s.name).select(
                F.lit(0),
                F.col("_reject_reason").isNull().cast("int"),
                F.col("_reject_reason").isNotNull().cast("int"),
            )
        )
        return sides.agg(
            F.sum("i").alias("rows_in"), F.sum("v").alias("valid"), F.sum("r").alias("rejected")
        ).withColumn("superseded", F.col("rows_in") - F.col("valid") - F.col("rejected"))

    return _labelled({s.name: count(s) for s in ENTITIES}, "_entity")


def _with_patient(c: Chain) -> DataFrame:
    known = c.silver("pacientes").select("id_paciente", F.lit(True).alias("_known"))
    return lookup(c.latest("citas"), known, "id_paciente", c.heavy("citas", "id_paciente"), ["id_cita"])


@query
def appointments_of_known_patients(c: Chain) -> DataFrame:
    return _with_patient(c).where("_known").select("id_cita", "id_paciente")


@query
def orphan_appointments(c: Chain) -> DataFrame:
    return _with_patient(c).where("_known IS NULL").select("id_cita", "id_paciente")


def _colocated(c: Chain, entity: str) -> ColocatedTable:
    """Silver of an entity, in as many buckets as shuffles have partitions."""
    buckets = int(c.spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"{entity}_{uuid.uuid4().hex[:8]}"
    table = ColocatedTable(_fresh_store(c), "silver", name, BY_NAME[entity].pk, buckets, "colocated")
    table.overwrite(c.silver(entity))
    return table


@query
def colocated_orphans(c: Chain) -> DataFrame:
    """References of appointments, events and bills, valid or not, to patients and appointments in silver,
    which are read from their buckets."""
    patients, visits = _colocated(c, "pacientes"), _colocated(c, "citas")
    pairs = {
        "citas": (patients, "citas"), "eventos_clinicos": (visits, "eventos_clinicos"), "facturacion": (visits, "facturacion"),
    }
    totals = {
        name: parents.matched(c.tagged(child).where(F.col(parents.key).isNotNull())).groupBy("found").agg(
            F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("keys")
        )
        for name, (parents, child) in pairs.items()
    }
    return _labelled(totals, "_entity")


@query
def event_patient_coherence(c: Chain) -> DataFrame:
    spec = BY_NAME["eventos_clinicos"]
    parents = {"citas": c.silver("citas"), "pacientes": c.silver("pacientes")}
    heavy = {ref.column: c.heavy(spec.name, ref.column) for ref in spec.parents}
    return (
        attach_parents(spec, c.latest(spec.name), parents, heavy)
        .groupBy("paciente_coherente_con_cita")
        .agg(F.count(F.lit(1)).alias("rows"))
    )


# --- incremental state ---------------------------------------------------------------------------


@query
def incremental_rows(c: Chain) -> DataFrame:
    return newer_than(c.bronze("citas"), "_cursor", MARK).select("id_cita", "_cursor", "_row_hash")


@query
def incremental_rows_with_lookback(c: Chain) -> DataFrame:
    return newer_than(c.bronze("citas"), "_cursor", MARK, LATE).groupBy(
        F.to_date("_cursor").alias("day")
    ).agg(F.count(F.lit(1)).alias("rows"))


def _slices(c: Chain) -> tuple[DataFrame, DataFrame]:
    """Appointments as known at the mark, and the versions that came after it."""
    cleaned = c.cleaned("citas")
    old = cleaned.where(F.col(CURSOR) <= F.lit(MARK).cast("timestamp"))
    new = newer_than(cleaned, CURSOR, MARK)
    keep = lambda df, n: c.staging.keep(
        latest_per_key(df, "id_cita", newest_first(CURSOR), keep_missing_keys=False), n
    )
    return keep(old, "slice-old"), keep(new, "slice-new")


_MERGED = ("id_cita", "estado_cita", CURSOR, "_row_hash")


@query
def upsert_appointments(c: Chain) -> DataFrame:
    old, new = _slices(c)
    store = _fresh_store(c)
    overwrite_bucketed(old, store, "silver", "citas", "id_cita", 8)
    upsert_table(new, store, "silver", "citas", "id_cita", 8)
    return store.read("silver", "citas").select(*_MERGED)


@query
def upsert_appointments_twice(c: Chain) -> DataFrame:
    """Merging the same rows again, and then older ones, changes nothing."""
    old, new = _slices(c)
    store = _fresh_store(c)
    order = newest_first(CURSOR)
    for rows in (new, new, old):
        upsert_table(rows, store, "silver", "citas", "id_cita", 8, order)
    return store.read("silver", "citas").select(*_MERGED)


@query
def delta_merged_appointments(c: Chain) -> DataFrame:
    """A base, the newer versions and the older ones again as deltas: read before and after folding."""
    old, new = _slices(c)
    table = DeltaTable(_fresh_store(c), "silver", "citas", "id_cita", newest_first(CURSOR))
    for rows in (old, new, old):
        table.upsert(rows)
    before = c.staging.keep(table.read().select(*_MERGED), "before-folding")
    table.compact(ratio=float("inf"))
    return _labelled({"deltas": before, "folded": table.read().select(*_MERGED)}, "state")


@query
def delta_deleted_appointments(c: Chain) -> DataFrame:
    """The last upsert wins: keys of the older versions go, then those of the newer ones arrive."""
    old, new = _slices(c)
    table = DeltaTable(_fresh_store(c), "silver", "citas", "id_cita")
    table.upsert(old)
    table.delete(old.where(F.col("estado_cita") == "Programada"))
    table.upsert(new)
    table.compact()
    return table.read().select(*_MERGED)


@query
def upsert_only_changed(c: Chain) -> DataFrame:
    """A re-delivered snapshot updates only the rows whose content hash differs."""
    old, _ = _slices(c)
    later = Run("20020102_000000_cafe0002", datetime(2002, 1, 2), date(2002, 1, 2))
    changed = F.col("estado_cita") == "Cancelada"
    redelivered = c.staging.keep(
        old.withColumn("_row_hash", F.when(changed, F.sha2(F.concat("_row_hash", F.lit("x")), 256)).otherwise(F.col("_row_hash")))
        .withColumn("_batch_id", F.lit(later.batch_id)),
        "redelivered",
    )
    store = _fresh_store(c)
    overwrite_bucketed(old, store, "silver", "citas", "id_cita", 8)
    upsert_table(redelivered, store, "silver", "citas", "id_cita", 8, only_changed_by="_row_hash")
    return store.read("silver", "citas").groupBy("_batch_id", "estado_cita").agg(
        F.count(F.lit(1)).alias("rows")
    )


@query
def soft_deleted_patients(c: Chain) -> DataFrame:
    """Patients whose customer placed no order after the mark count as gone from the snapshot."""
    recent = c.table("orders").where(F.col("o_orderdate") > F.lit("2001-03-31").cast("timestamp_ntz"))
    snapshot = recent.select(F.col("o_custkey").cast("string").alias("id_paciente"))
    return mark_missing(c.silver("pacientes"), snapshot, "id_paciente").select("id_paciente", "_is_active")


@query
def watermarks_by_layer(c: Chain) -> DataFrame:
    """Seed, advance, and try to move back: one mark per layer and entity, never behind."""
    marks = Watermarks(_fresh_store(c), CURSOR)
    marks.seed(("bronze", "silver"), [s.name for s in ENTITIES], RUN)
    reached = reduce(
        DataFrame.unionAll,
        [
            c.bronze(s.name).agg(F.max("_cursor").alias("reached")).select(
                F.lit("bronze").alias("layer"), F.lit(s.name).alias("source_table"), "reached"
            )
            for s in ENTITIES
        ],
    )
    marks.advance_all(reached, RUN)
    marks.advance("bronze", "citas", "1990-01-01 00:00:00", RUN)
    return marks.table().select("layer", "source_table", "last_watermark")


@query
def patient_history(c: Chain) -> DataFrame:
    """Type-2 history of patients: as first registered, then as last updated."""
    attributes = ("ciudad", "estado", "aseguradora")
    rows = c.cleaned("pacientes")
    oldest = [F.col(CURSOR).asc_nulls_last(), F.col("estado"), F.col("_row_hash")]
    first = latest_per_key(rows, "id_paciente", oldest, keep_missing_keys=False)
    second = c.latest("pacientes")
    at = lambda text: F.lit(text).cast("timestamp")
    history = first_versions(first, "id_paciente", attributes, at("1995-01-01 00:00:00"))
    return next_versions(history, second, "id_paciente", attributes, at("1996-01-01 00:00:00")).drop(
        "_version_hash"
    )


_VERSIONED = ("ciudad", "estado", "aseguradora")


def _patient_versions(c: Chain) -> DataFrame:
    """History of patients by the times of their own rows, the newest third arriving first."""
    seen = observed(c.cleaned("pacientes"), "id_paciente", _VERSIONED, CURSOR, "_row_hash")
    third = F.pmod(F.xxhash64("_tie"), F.lit(3))
    kept = None
    for number in (2, 0, 1):
        part = seen.where(third == number)
        kept = c.staging.keep(part if kept is None else kept.unionByName(part), "patients-seen")
    return versions_of(kept, "id_paciente", _VERSIONED)


def _payer_versions(c: Chain, split: bool) -> DataFrame:
    """Who paid for a patient, from when to when, as all billing lines show it."""
    seen = observed(c.silver("facturacion"), "id_paciente", ("pagador",), "fecha_factura", "_row_hash")
    heavy = c.silver("facturacion").select("id_paciente").where("id_paciente IS NOT NULL")
    heavy = c.staging.keep(heavy_keys(heavy, "id_paciente", 64, 0.0), "heavy-payers") if split else None
    return versions_of(seen, "id_paciente", ("pagador",), heavy)


@query
def patient_history_out_of_order(c: Chain) -> DataFrame:
    return _patient_versions(c).drop("_version_hash")


@query
def payer_history(c: Chain) -> DataFrame:
    return _payer_versions(c, split=False).drop("_version_hash")


@query
def payer_history_split(c: Chain) -> DataFrame:
    """The same history with the most frequent patients worked on month by month."""
    return _payer_versions(c, split=True).drop("_version_hash")


@query
def fact_appointment_versions(c: Chain) -> DataFrame:
    """Appointments with the version of their patient, and the payer, valid when they took place."""
    patients = _patient_versions(c).withColumn("version_paciente", version_key("id_paciente"))
    payers = c.staging.keep(_payer_versions(c, split=False), "payers")
    facts = c.fact("citas").select("id_cita", "id_paciente", "fecha_hora_cita")
    dated = version_at(facts, c.staging.keep(patients, "versions"), "id_paciente", "fecha_hora_cita", ("version_paciente", "estado"))
    return version_at(dated, payers, "id_paciente", "fecha_hora_cita", ("pagador",))


# --- gold ----------------------------------------------------------------------------------------


@query
def dim_patients(c: Chain) -> DataFrame:
    return c.patients


@query
def dim_lookups(c: Chain) -> DataFrame:
    frames = {}
    for fact in FACTS:
        for column, key in fact.lookups.items():
            frames[column] = c.lookup(column).select(F.col(key).alias("sk"), "nombre")
    return _labelled(frames, "dimension")


@query
def dim_patients_for_bi(c: Chain) -> DataFrame:
    return patient_bi(c.patients)


@query
def dim_document_numbers(c: Chain) -> DataFrame:
    """A dimension as wide as its fact: every billing line numbered in key order."""
    lines = c.silver("facturacion").select("id_factura")
    return dense_key(lines, "id_factura", "sk_factura", c.staging)


@query
def stable_patient_keys(c: Chain) -> DataFrame:
    """Keys assigned to the first registered half of insurers stay when the rest arrive."""
    patients = c.silver("pacientes").select("id_paciente", "aseguradora")
    early = patients.where("aseguradora < 'G'")
    existing = dense_key(early, "id_paciente", "sk_paciente", c.staging)
    return stable_key(patients, existing, "id_paciente", "sk_paciente", c.staging)


@query
def fact_appointments(c: Chain) -> DataFrame:
    return c.fact("citas").drop("_gold_loaded_at")


@query
def fact_clinical_events(c: Chain) -> DataFrame:
    return c.fact("eventos_clinicos").drop("_gold_loaded_at")


@query
def fact_billing(c: Chain) -> DataFrame:
    return c.fact("facturacion").drop("_gold_loaded_at")


# --- published views -----------------------------------------------------------------------------


@query
def kpi_appointment_operations(c: Chain) -> DataFrame:
    return kpis.appointment_operations(c.fact_for_once("citas"), c.calendar)


@query
def kpi_billing_monthly(c: Chain) -> DataFrame:
    return kpis.billing_monthly(c.fact("facturacion"), c.calendar)


@query
def kpi_monthly_summary(c: Chain) -> DataFrame:
    return kpis.monthly_summary(
        c.fact("citas"), c.fact("facturacion"), c.calendar, unique_appointments=True
    ).orderBy(*MONTH)


@query
def kpi_monthly_summary_distinct(c: Chain) -> DataFrame:
    return kpis.monthly_summary(c.fact("citas"), c.fact("facturacion"), c.calendar)


@query
def summary_outside_calendar(c: Chain) -> DataFrame:
    """The summary view's rule for dates outside a given calendar: they are left out."""
    given = calendar(c.spark, date(1995, 1, 1), date(2000, 12, 31))
    return kpis.monthly_summary(c.fact("citas"), c.fact("facturacion"), given, unique_appointments=True)


# --- indicators ----------------------------------------------------------------------------------


def _visits(c: Chain) -> DataFrame:
    return kpis.with_month(c.fact("citas"), "sk_fecha_cita")


def _bills(c: Chain) -> DataFrame:
    return kpis.with_month(c.fact("facturacion"), "sk_fecha_factura")


def _events(c: Chain) -> DataFrame:
    return kpis.with_month(c.fact("eventos_clinicos"), "sk_fecha_evento")


@query
def kpi_active_patients(c: Chain) -> DataFrame:
    return kpis.active_patients(c.patients)


@query
def kpi_rates_by_month_and_site(c: Chain) -> DataFrame:
    return kpis.appointment_rates(_visits(c), (*MONTH, "sede"))


@query
def kpi_rates_by_month_and_specialty(c: Chain) -> DataFrame:
    return kpis.appointment_rates(_visits(c), (*MONTH, "especialidad"))


@query
def kpi_appointment_rates_all_grains(c: Chain) -> DataFrame:
    return kpis.appointment_rates_by_grain(_visits(c))


@query
def kpi_appointments_by_state(c: Chain) -> DataFrame:
    return kpis.rows_by(_visits(c), *MONTH, "estado_cita")


@query
def kpi_appointments_by_type(c: Chain) -> DataFrame:
    return kpis.rows_by(c.fact("citas"), "tipo_cita")


@query
def kpi_appointments_by_site(c: Chain) -> DataFrame:
    return kpis.rows_by(c.fact("citas"), "sede")


@query
def kpi_appointments_by_specialty(c: Chain) -> DataFrame:
    return kpis.rows_by(c.fact("citas"), "especialidad")


@query
def kpi_top_specialties(c: Chain) -> DataFrame:
    return kpis.top_specialties(c.fact("citas"))


@query
def kpi_appointment_reach(c: Chain) -> DataFrame:
    return kpis.appointment_reach(_visits(c), MONTH)


@query
def kpi_events_by_type(c: Chain) -> DataFrame:
    return kpis.event_completion(c.fact("eventos_clinicos"), ("tipo_evento",))


@query
def kpi_events_total(c: Chain) -> DataFrame:
    return kpis.event_completion(c.fact("eventos_clinicos"), ())


@query
def kpi_events_per_appointment(c: Chain) -> DataFrame:
    return kpis.events_per_appointment(c.fact("eventos_clinicos"), ("tipo_evento",))


@query
def kpi_events_by_month(c: Chain) -> DataFrame:
    return kpis.event_completion(_events(c), MONTH)


@query
def kpi_events_per_appointment_by_month(c: Chain) -> DataFrame:
    return kpis.events_per_appointment(_events(c), MONTH)


@query
def kpi_documented_appointments(c: Chain) -> DataFrame:
    return kpis.documented_appointments(_visits(c), c.fact("eventos_clinicos"), MONTH)


@query
def kpi_appointment_to_event_time(c: Chain) -> DataFrame:
    return kpis.appointment_to_event_hours(c.fact("citas"), c.fact("eventos_clinicos"))


@query
def kpi_billing_by_payer(c: Chain) -> DataFrame:
    return kpis.billing_totals(c.fact("facturacion"), ("pagador",))


@query
def kpi_billing_by_service(c: Chain) -> DataFrame:
    return kpis.billing_totals(c.fact("facturacion"), ("tipo_servicio",))


@query
def kpi_billing_by_month(c: Chain) -> DataFrame:
    return kpis.billing_totals(_bills(c), MONTH)


@query
def kpi_invoices_by_payment_state(c: Chain) -> DataFrame:
    return kpis.rows_by(c.fact_for_once("facturacion"), "estado_pago")


@query
def kpi_billing_per_attended_appointment(c: Chain) -> DataFrame:
    return kpis.billing_per_attended(_visits(c), c.fact("facturacion"), MONTH)


@query
def kpi_patients_by_insurer(c: Chain) -> DataFrame:
    return kpis.rows_by(c.patients, "aseguradora")


@query
def kpi_patients_by_city(c: Chain) -> DataFrame:
    return kpis.patients_by_city(c.patients)


@query
def kpi_patients_without_appointments(c: Chain) -> DataFrame:
    in_period = c.fact("citas").where("sk_fecha_cita >= 20010101")
    return kpis.patients_without_appointments(c.patients, in_period).select("id_paciente")


@query
def kpi_distinct_patients_merged(c: Chain) -> DataFrame:
    """Patients seen by month and site, by year and specialty and in all: exactly, and from sketches by
    day, site and specialty to which half of the rows were added later, twice."""
    store, fact = _fresh_store(c), c.fact("citas").where("sk_fecha_cita IS NOT NULL")
    later = F.pmod(F.xxhash64("id_cita"), F.lit(2)) == 1
    by, month = ("sk_fecha_cita", "sede", "especialidad"), F.floor(F.col("sk_fecha_cita") / 100).cast("int")
    sketches.rebuild_sketches(fact.where(~later), store, "distinct_pacientes", by, "id_paciente", month)
    for _ in range(2):
        sketches.add_to_sketches(fact.where(later), store, "distinct_pacientes", by, "id_paciente", month)
    stored = store.read("gold", "distinct_pacientes")
    found = {}
    for grain, keys in {
        "month and site": (month.alias("periodo"), F.col("sede").alias("grupo")),
        "year and specialty": (F.floor(F.col("sk_fecha_cita") / 10000).cast("int").alias("periodo"), F.col("especialidad").alias("grupo")),
        "all": (F.lit(None).cast("int").alias("periodo"), F.lit(None).cast("string").alias("grupo")),
    }.items():
        exact = fact.groupBy(*keys).agg(F.count_distinct("id_paciente").alias("exact"))
        same = F.col("x.periodo").eqNullSafe(F.col("m.periodo")) & F.col("x.grupo").eqNullSafe(F.col("m.grupo"))
        both = exact.alias("x").join(sketches.merged_distincts(stored, keys).alias("m"), same, "full")
        close = sketches.within_error(F.col("exact"), F.col(sketches.ESTIMATE))
        found[grain] = both.select("x.periodo", "x.grupo", "exact", F.coalesce(close, F.lit(False)).alias("within_error"))
    return _labelled(found, "grain")


@query
def kpi_mean_age_by_specialty(c: Chain) -> DataFrame:
    return kpis.mean_age_by_specialty(c.patients, c.fact("citas"))


# --- profiling -----------------------------------------------------------------------------------


@query
def profile_missing_values(c: Chain) -> DataFrame:
    return profile.null_counts(c.raw("citas"))


@query
def profile_duplicates(c: Chain) -> DataFrame:
    return _labelled({s.name: profile.duplicate_count(c.arriving(s.name), s.pk) for s in ENTITIES}, "_entity")


@query
def profile_cardinality(c: Chain) -> DataFrame:
    columns = ("id_cita", "id_paciente", "id_profesional", "especialidad", "sede", "tipo_cita", "estado_cita")
    return profile.cardinality(c.loaded("citas"), columns)


@query
def profile_top_values(c: Chain) -> DataFrame:
    return profile.top_values(c.raw("facturacion"), "pagador", 5)


@query
def profile_time_ranges(c: Chain) -> DataFrame:
    columns = {
        "pacientes": "fecha_nacimiento",
        "citas": "fecha_hora_cita",
        "eventos_clinicos": "fecha_hora_evento",
        "facturacion": "fecha_factura",
    }
    return _labelled({e: profile.time_range(c.arriving(e), col) for e, col in columns.items()}, "_entity")


@query
def profile_coverage(c: Chain) -> DataFrame:
    visits = c.loaded("citas").select(clean_text("id_cita").alias("id_cita"), clean_text("id_paciente").alias("id_paciente"))
    events = c.loaded("eventos_clinicos").select(clean_text("id_cita").alias("id_cita"))
    bills = c.loaded("facturacion").select(clean_text("id_cita").alias("id_cita"))
    return _labelled(
        {
            "patients with appointments": profile.coverage(c.loaded("pacientes"), visits, "id_paciente"),
            "appointments with events": profile.coverage(visits, events, "id_cita"),
            "appointments with bills": profile.coverage(visits, bills, "id_cita"),
        },
        "relation",
    )


@query
def profile_value_shapes(c: Chain) -> DataFrame:
    shapes = {
        "fecha_nacimiento": profile.value_shapes(c.raw("pacientes"), "fecha_nacimiento"),
        "numero_documento": profile.value_shapes(c.raw("pacientes"), "numero_documento"),
        "valor_resultado": profile.value_shapes(c.raw("eventos_clinicos"), "valor_resultado"),
    }
    return _labelled(shapes, "column")


@query
def profile_batches(c: Chain) -> DataFrame:
    return _labelled({s.name: profile.batch_count(c.bronze(s.name)) for s in ENTITIES}, "_entity")


@query
def profile_integrity(c: Chain) -> DataFrame:
    """Orphans, event/appointment mismatches and unbalanced bills, on current versions, valid or not."""
    visits, patients = c.tagged("citas"), c.tagged("pacientes")
    events, bills = c.tagged("eventos_clinicos"), c.tagged("facturacion")
    frames = {
        "appointments without patient": profile.orphan_count(visits, patients, "id_paciente"),
        "events without appointment": profile.orphan_count(events, visits, "id_cita"),
        "events without patient": profile.orphan_count(events, patients, "id_paciente"),
        "bills without appointment": profile.orphan_count(bills, visits, "id_cita"),
        "event patient differs": profile.mismatch_count(events, visits, "id_cita", "id_paciente"),
        "unbalanced bills": profile.unbalanced_count(
            c.loaded("facturacion"), "valor_bruto", "valor_descuento", "valor_neto"
        ),
    }
    return _labelled({k: f.toDF("rows") for k, f in frames.items()}, "check")


@query
def profile_unbalanced_rows(c: Chain) -> DataFrame:
    found = profile.unbalanced_rows(c.loaded("facturacion"), "valor_bruto", "valor_descuento", "valor_neto")
    return found.select("id_factura", "valor_bruto", "valor_descuento", "valor_neto")


@query
def profile_preview(c: Chain) -> DataFrame:
    return profile.preview(c.tagged("citas").select("id_cita", "id_paciente", "estado_cita"), "id_cita", 20)


# --- whole-run queries ---------------------------------------------------------------------------

_settings: dict[str, jobs.Settings] = {}


def _bands(c: Chain) -> dict[str, tuple[int, int]]:
    """Silver rows may fall short of the distinct source keys by half, and never exceed them. Only keys
    are read; the source is not loaded a second time for them."""

    def keys(spec: EntitySpec) -> DataFrame:
        present = split_missing_keys(c.raw(spec.name).select(spec.pk), spec.pk)[0]
        return present.select(clean_text(spec.pk)).distinct()

    counts = side_by_side(keys(spec).count for spec in ENTITIES)
    return {spec.name: (n // 2, n) for spec, n in zip(ENTITIES, counts, strict=True)}


def _loaded_store(c: Chain) -> jobs.Settings:
    """A store filled by the batch jobs: full load, silver and gold."""
    if c.staging.path not in _settings:
        settings = jobs.Settings(_fresh_store(c), 8, row_bands=_bands(c))
        sources = {s.name: c.raw(s.name) for s in ENTITIES}
        jobs.run_all(settings, sources, RUN, fail_on=(quality.CRIT,))
        _settings[c.staging.path] = settings
    return _settings[c.staging.path]


@query
def job_full_load_rows(c: Chain) -> DataFrame:
    """What a full run leaves in each table."""
    store = _loaded_store(c).store
    tables = {f"silver.{s.name}": store.read("silver", s.name) for s in ENTITIES}
    tables |= {f"bronze.{s.name}": store.read("bronze", s.name) for s in ENTITIES}
    tables |= {f"gold.{f.name}": store.read("gold", f.name) for f in FACTS}
    tables["gold.dim_paciente"] = store.read("gold", "dim_paciente")
    tables["gold.dim_tiempo"] = store.read("gold", "dim_tiempo")
    tables["bronze.quarantine"] = jobs.quarantine_table(store)
    tables["silver.rejects"] = jobs.rejects_table(store)
    return _labelled({n: t.agg(F.count(F.lit(1)).alias("rows")) for n, t in tables.items()}, "table_name")


@query
def job_quality_report(c: Chain) -> DataFrame:
    settings = _loaded_store(c)
    frames = jobs.bronze_results(settings) + jobs.silver_results(settings) + jobs.gold_results(settings)
    frames += jobs.load_results(settings, {s.name: c.raw(s.name) for s in ENTITIES}, RUN)
    return quality.all_results(frames).select(
        "check_id", "severity", F.round("metric_value", 6).alias("metric_value"), "passed"
    )


def _starts(key: str, digit: str) -> Column:
    """A sixteenth of the keys, chosen by their digest."""
    return F.md5(key).startswith(digit)


def _changed(df: DataFrame, key: str, digit: str, column: str, value: Column) -> DataFrame:
    changed = F.when(_starts(key, digit), value).otherwise(F.col(column))
    return df.withColumn(column, changed.cast(df.schema[column].dataType))


@query
def job_quality_failures(c: Chain) -> DataFrame:
    """The checks over copies of all layers that were damaged on purpose, each in a sixteenth of a table."""
    source = _loaded_store(c).store
    settings = jobs.Settings(_fresh_store(c), 8, row_bands={s.name: (10**12, 10**13) for s in ENTITIES})
    silver = {s.name: jobs.silver_table(source, s) for s in ENTITIES}
    visits = silver["citas"]
    visits = visits.unionAll(visits.where(_starts("id_cita", "1")))
    visits = _changed(visits, "id_cita", "2", "id_paciente", F.lit("nobody"))
    silver["citas"] = _changed(visits, "id_cita", "3", "estado_cita", F.lit("Otra"))
    events = _changed(silver["eventos_clinicos"], "id_evento", "4", "id_cita", F.lit("none"))
    silver["eventos_clinicos"] = _changed(events, "id_evento", "5", "id_paciente", F.lit("nobody"))
    bills = _changed(silver["facturacion"], "id_factura", "6", "valor_neto", F.col("valor_neto") + 1)
    bills = _changed(bills, "id_factura", "7", "valor_bruto", F.lit(-1))
    silver["facturacion"] = _changed(bills, "id_factura", "8", "id_cita", F.lit("none"))
    for spec in ENTITIES:
        # Rows are read from bucket folders and go to folders of the same names.
        settings.store.overwrite(silver[spec.name], "silver", spec.name, [BUCKET], placed=True)
        bronze = _changed(jobs.bronze_table(source, spec), "_row_hash", "9", "_batch_id", F.lit(None))
        bronze = _changed(bronze, "_row_hash", "a", spec.pk, F.lit("nan"))
        settings.store.overwrite(bronze, "bronze", spec.name, [BUCKET], placed=True)
    for fact in FACTS:
        rows = source.read("gold", fact.name).where(~_starts(fact.pk, "b"))
        settings.store.overwrite(_changed(rows, fact.pk, "c", "sk_paciente", F.lit(None)), "gold", fact.name)
    for name in ("dim_tiempo", "dim_paciente"):
        settings.store.overwrite(source.read("gold", name), "gold", name)
    frames = jobs.bronze_results(settings) + jobs.silver_results(settings) + jobs.gold_results(settings)
    found = quality.all_results(frames).where((F.col("severity") == quality.CRIT) | (F.col("check_id") == "Q-S12"))
    # Q-S10 compares row hashes with bronze, Q-G02 amounts with silver; both are damaged otherwise. These
    # and Q-G04 fail over copies of their own, below.
    return found.where(~F.col("check_id").isin("Q-S10", "Q-G02", "Q-G04")).select("check_id", "metric_value", "passed")


@query
def job_quality_failures_alone(c: Chain) -> DataFrame:
    """Checks between two tables of which one alone is damaged: birth dates that silver lost, bills that
    gold raised, and a report table that shows names and documents."""
    store = _loaded_store(c).store
    patients, bills = jobs.silver_table(store, BY_NAME["pacientes"]), jobs.silver_table(store, BY_NAME["facturacion"])
    fact = store.read("gold", "fact_facturacion")
    frames = [
        jobs.lost_birth_dates(
            jobs.bronze_table(store, BY_NAME["pacientes"]), _changed(patients, "id_paciente", "1", "fecha_nacimiento", F.lit(None))
        ),
        jobs.billed_difference(bills, _changed(fact, "id_factura", "2", "valor_neto", F.col("valor_neto") + 1)),
        jobs.exposed_identifiers(patients),
    ]
    return quality.all_results(frames).select("check_id", "metric_value", "passed")


@query
def reconciled_contents(c: Chain) -> DataFrame:
    """Billing facts against copies with as many rows and the same sums, whose rows are moved,
    renamed, or exchange their payer; only the first copy is the same table."""
    fact = c.fact("facturacion")
    taken = _starts("id_factura", "1")
    columns = ("id_factura", "sk_paciente", "pagador", "valor_neto")
    copies = {
        "moved": fact.repartition("pagador"),
        "renamed": fact.withColumn("id_factura", F.when(taken, F.concat("id_factura", F.lit("x"))).otherwise(F.col("id_factura"))),
        "exchanged": fact.withColumn("pagador", F.when(taken, F.lit("nadie")).otherwise(F.col("pagador"))),
    }
    found = {n: quality.differing_groups(fact, other, "id_factura", columns) for n, other in copies.items()}
    return _labelled(found, "copy")


@query
def job_rejects_table(c: Chain) -> DataFrame:
    return jobs.rejects_table(_loaded_store(c).store).select(
        "_entity", "_batch_id", "_reject_reason", "id_paciente", "id_cita", "id_evento", "id_factura"
    )


@query
def job_stored_summary(c: Chain) -> DataFrame:
    """The monthly summary from the clustered gold tables the jobs wrote, through SQL views."""
    settings = _loaded_store(c)
    jobs.publish(settings)
    kpis.create_kpi_views(c.spark)
    return c.spark.newSession().sql("SELECT * FROM gold.v_kpi_resumen ORDER BY anio, mes")


def _view(c: Chain, name: str) -> DataFrame:
    settings = _loaded_store(c)
    jobs.publish(settings)
    kpis.create_kpi_views(c.spark)
    return c.spark.newSession().table(f"gold.{name}")


@query
def job_view_appointments(c: Chain) -> DataFrame:
    return _view(c, "v_kpi_operacion_citas")


@query
def job_view_billing(c: Chain) -> DataFrame:
    return _view(c, "v_kpi_facturacion_mensual")


@query
def job_published_tables(c: Chain) -> DataFrame:
    """Rows of log, reject and quarantine tables and of a view, by catalog name from another session."""
    settings = _loaded_store(c)
    jobs.publish(settings)
    kpis.create_kpi_views(c.spark)
    other = c.spark.newSession()
    names = ("bronze.quarantine", "silver.rejects", "gold.dim_paciente_bi", "gold.v_kpi_resumen", "ops.ingestion_watermark")
    return _labelled({n: other.table(n).agg(F.count(F.lit(1)).alias("rows")) for n in names}, "table_name")


@query
def job_run_health(c: Chain) -> DataFrame:
    store = _loaded_store(c).store
    health = kpis.run_health(
        jobs.rejects_table(store),
        store.read("ops", "data_quality_results"),
        store.read("ops", "pipeline_runs"),
        RUN.batch_id,
    )
    # The time of the load is the machine's; only whether there is one can be compared.
    loaded = F.when(F.col("metric") == "last_successful_load", F.col("value").isNotNull().cast("string"))
    return health.select("metric", F.coalesce(loaded, "value").alias("value"))


@query
def job_incremental_runs(c: Chain) -> DataFrame:
    """Full load of the versions up to the mark, then everything again incrementally, twice."""
    settings = jobs.Settings(_fresh_store(c), 8)
    everything = {s.name: c.raw(s.name) for s in ENTITIES}
    early = dict(everything)
    early["citas"] = everything["citas"].where(
        parse_timestamp(CURSOR).isNull() | (parse_timestamp(CURSOR) <= F.lit(MARK).cast("timestamp"))
    )
    jobs.run_all(settings, early, RUN, gold=False, check=False)
    rows = []
    for number in (1, 2):
        at = RUN.at + timedelta(days=number)
        run = Run(f"{at:%Y%m%d}_000000_cafe000{number}", at, RUN.as_of)
        result = jobs.run_all(settings, everything, run, jobs.INCREMENTAL, gold=False, check=False)
        by_name = {r.entity: r for r in result.cleaned}
        rows += [
            (number, r.entity, r.rows_read, by_name[r.entity].rows_in) for r in result.loaded
        ]
    return c.spark.createDataFrame(rows, "run INT, _entity STRING, rows_read BIGINT, rows_cleaned BIGINT")


@query
def job_incremental_state(c: Chain) -> DataFrame:
    """Silver after a full load of part of the data and two increments: late parents first, then
    all remaining versions, valid or not. It must hold what a rebuild from all rows holds."""
    settings = jobs.Settings(_fresh_store(c), 8, lookback="20000 days")
    everything = {s.name: c.raw(s.name) for s in ENTITIES}
    cursor = parse_timestamp(CURSOR)
    early = everything["citas"].where(cursor.isNull() | (cursor <= F.lit(MARK).cast("timestamp")))
    # Rows without a cursor arrive with full loads only.
    some = everything["pacientes"].where(cursor.isNull() | (F.pmod(F.xxhash64("id_paciente"), F.lit(2)) == 0))
    jobs.run_all(settings, {**everything, "citas": early, "pacientes": some}, RUN, gold=False, check=False)
    for number, sources in enumerate(({**everything, "citas": early}, everything), 1):
        at = RUN.at + timedelta(days=number)
        run = Run(f"{at:%Y%m%d}_000000_cafe100{number}", at, RUN.as_of)
        jobs.run_all(settings, sources, run, jobs.INCREMENTAL, gold=False, check=False)
    silver = {s.name: jobs.silver_table(settings.store, s).select(F.col(s.pk).alias("key"), "_row_hash") for s in ENTITIES}
    return _labelled(silver, "_entity")


def _followed_store(c: Chain) -> LayerStore:
    """Gold started from part of the data and brought up by two increments: late parents first, then
    all remaining versions, valid or not. It is never rebuilt."""
    name = f"{c.staging.path}-followed"
    if name not in _settings:
        settings = jobs.Settings(_fresh_store(c), 8, lookback="20000 days", record_changes=True)
        everything = {s.name: c.raw(s.name) for s in ENTITIES}
        cursor = parse_timestamp(CURSOR)
        early = everything["citas"].where(cursor.isNull() | (cursor <= F.lit(MARK).cast("timestamp")))
        # Rows without a cursor arrive with full loads only.
        some = everything["pacientes"].where(cursor.isNull() | (F.pmod(F.xxhash64("id_paciente"), F.lit(2)) == 0))
        jobs.run_all(settings, {**everything, "citas": early, "pacientes": some}, RUN, gold=False, check=False)
        incremental_gold.start_gold(settings, RUN)
        for number, sources in enumerate(({**everything, "citas": early}, everything), 1):
            at = RUN.at + timedelta(days=number)
            run = Run(f"{at:%Y%m%d}_000000_cafe200{number}", at, RUN.as_of)
            jobs.run_all(settings, sources, run, jobs.INCREMENTAL, gold=False, check=False)
            incremental_gold.update_gold(settings, run)
        _settings[name] = settings
    return _settings[name].store


@query
def incremental_gold_operations(c: Chain) -> DataFrame:
    """Stored sums of appointments that followed the increments; equal to those of a rebuild."""
    return incremental_gold.stored_operations(_followed_store(c))


@query
def incremental_gold_billing(c: Chain) -> DataFrame:
    return incremental_gold.stored_billing(_followed_store(c))


@query
def incremental_gold_summary(c: Chain) -> DataFrame:
    return incremental_gold.stored_summary(_followed_store(c))


@query
def incremental_gold_facts(c: Chain) -> DataFrame:
    """Rows of the three facts, each with the patient and the lookup value that its keys lead to."""
    store = _followed_store(c)
    patients = store.read("gold", "dim_paciente").select("sk_paciente", F.col("id_paciente").alias("patient"))
    frames = {}
    for fact in FACTS:
        column, key = next(iter(fact.lookups.items()))
        names = store.read("gold", LOOKUP_DIMS[column]).select(key, F.col("nombre").alias("value"))
        rows = store.read("gold", fact.name).join(patients, "sk_paciente", "left").join(names, key, "left")
        frames[fact.name] = rows.select(F.col(fact.pk).alias("key"), "patient", "value")
    return _labelled(frames, "fact")


@query
def job_with_empty_entity(c: Chain) -> DataFrame:
    """A full run in which one entity delivers nothing and another nothing valid."""
    settings = jobs.Settings(_fresh_store(c), 8)
    sources = {s.name: c.raw(s.name) for s in ENTITIES}
    sources["eventos_clinicos"] = sources["eventos_clinicos"].where("id_evento = ''")
    sources["facturacion"] = sources["facturacion"].withColumn("id_paciente", F.lit("nobody"))
    jobs.run_all(settings, sources, RUN, check=False)
    store = settings.store
    tables = {f"silver.{s.name}": jobs.silver_table(store, s) for s in ENTITIES}
    tables |= {f"gold.{f.name}": store.read("gold", f.name) for f in FACTS}
    return _labelled({n: t.agg(F.count(F.lit(1)).alias("rows")) for n, t in tables.items()}, "table_name")


@query
def snapshot_partition_replaced(c: Chain) -> DataFrame:
    """Two batches kept side by side; loading the first again replaces only its partition."""
    settings = jobs.Settings(_fresh_store(c))
    spec, rows = BY_NAME["pacientes"], c.raw("pacientes")
    later = Run("20020102_000000_cafe0002", datetime(2002, 1, 2), date(2002, 1, 2))
    for run in (RUN, later, RUN):
        jobs.load_bronze_snapshot(settings, spec, rows, run, spec.name)
    table = settings.store.read("bronze", "pacientes_snapshots")
    return table.groupBy("_batch_id").agg(F.count(F.lit(1)).alias("rows"))


@query
def clustered_fact_rows(c: Chain) -> DataFrame:
    """The clustered write keeps every row; totals by year read back from the files."""
    store = _fresh_store(c)
    store.clustered(c.fact("citas"), "gold", "fact_citas", ("sk_fecha_cita", "sk_paciente"), "id_cita")
    year = F.floor(F.col("sk_fecha_cita") / 10000).cast("int")
    return store.read("gold", "fact_citas").groupBy(year.alias("anio")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum("sk_paciente").alias("key_sum")
    )


@query
def curve_clustered_lookups(c: Chain) -> DataFrame:
    """All rows of the patient with the most appointments, and of the busiest month, read back
    from a fact that is clustered on both."""
    store = _fresh_store(c)
    store.clustered_on_curve(c.fact("citas"), "gold", "fact_citas", ("sk_fecha_cita", "sk_paciente"), "id_cita")
    month = F.floor(F.col("sk_fecha_cita") / 100)
    fact = store.read("gold", "fact_citas")
    busiest = lambda by: profile.top_values(fact.select(by.alias("k")).where("k IS NOT NULL"), "k", 1).first()["value"]
    patient, first = busiest(F.col("sk_paciente")), busiest(month) * 100
    kept = {
        "patient": fact.where(F.col("sk_paciente") == patient),
        "month": fact.where((F.col("sk_fecha_cita") > first) & (F.col("sk_fecha_cita") < first + 100)),
    }
    return _labelled({k: f.select("id_cita", "id_paciente", "sk_paciente", "sk_fecha_cita") for k, f in kept.items()}, "side")


@query
def streamed_appointments(c: Chain) -> DataFrame:
    """Order files read as a stream and merged into bronze, started twice."""
    store, spec = _fresh_store(c), BY_NAME["citas"]
    source = c.table("orders")
    arrivals = (
        c.spark.readStream.schema(source.schema)
        .option("pathGlobFilter", "orders.parquet")
        .parquet(c.dir)
    )

    def to_raw(batch: DataFrame) -> DataFrame:
        return batch.sparkSession.sql(STATEMENTS["citas"], orders=batch)

    for _ in range(2):
        stream = upsert_arrivals(
            arrivals, spec, store, RUN, f"{store.root}/checkpoint", "orders", 8, to_raw
        )
        stream.awaitTermination()
    return store.read("bronze", "citas").drop(BUCKET).select("id_cita", "estado_cita", "_cursor", "_row_hash")


DELAY = "500 days"


@query
def arrivals_out_of_order(c: Chain) -> DataFrame:
    """Three deliveries of orders, each in event time: the third brings a year that was left out, and
    the second once more. Rows behind the mark are late, others are taken once."""
    store = _fresh_store(c)
    landing = f"{store.root}/landing"
    orders = c.table("orders").select("o_orderkey", F.col("o_orderdate").cast("timestamp").alias("o_orderdate"))
    year = F.year("o_orderdate")
    second = orders.where(year.isin(1999, 2000))
    deliveries = (orders.where(year < 1998), second, orders.where((year == 1998) | (year > 2000)).unionByName(second))
    for number, rows in enumerate(deliveries, 1):
        rows.write.parquet(f"{landing}/delivery={number}")
        arrivals = with_source_file(c.spark.readStream.schema(orders.schema).parquet(f"{landing}/delivery=*"))
        admit_arrivals(arrivals, "o_orderdate", DELAY, store, "pedidos", f"{store.root}/cp-admit").awaitTermination()
        distinct = distinct_arrivals(
            arrivals, ("o_orderkey", "o_orderdate"), "o_orderdate", DELAY, store, "pedidos", f"{store.root}/cp-distinct"
        )
        distinct.awaitTermination()
    delivery = F.regexp_extract("_source_file", "delivery=([0-9]+)", 1).cast("int").alias("delivery")
    sides = {"taken": store.read("bronze", "pedidos"), "late": store.read("bronze", "pedidos__late")}
    return _labelled({k: f.select("o_orderkey", "o_orderdate", delivery) for k, f in sides.items()}, "side")
