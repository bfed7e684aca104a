"""Batch jobs: load bronze, clean into silver, build gold, check, and all of it in order."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import date, datetime, timezone
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierlake.functions import UNKNOWN, clean_text, parse_timestamp
from tierlake.operators import quality as q
from tierlake.operators.dedupe import latest_per_key, newest_first
from tierlake.operators.entity import (
    EntitySpec,
    Run,
    add_lineage,
    clean,
    latest,
    rejected_rows,
    split_missing_keys,
    tag,
    valid_rows,
)
from tierlake.operators.profile import orphans
from tierlake.operators.skew import heavy_keys, some_or_none
from tierlake.operators.star import (
    DIRECT_IDENTIFIERS,
    FACTS,
    LOOKUP_DIMS,
    FactSpec,
    build_fact,
    calendar,
    calendar_of,
    dim_lookup,
    dim_patient,
    patient_bi,
)
from tierlake.operators.upsert import (
    BUCKET,
    DEFAULT_BUCKETS,
    overwrite_bucketed,
    replace_keys,
    upsert_table,
)
from tierlake.operators.watermark import Watermarks, highest, newer_than
from tierlake.plans.entities import (
    APPOINTMENT_STATES,
    BY_NAME,
    CURSOR,
    ENTITIES,
    SEXES,
)
from tierlake.sources.concurrent import side_by_side
from tierlake.sources.staging import Relay, Staging
from tierlake.sources.store import LayerStore

FULL, INCREMENTAL = "full", "incremental"
DIMS = ("dim_tiempo", "dim_paciente", *LOOKUP_DIMS.values())

# Columns of the two log tables.
RUN_LOG_SCHEMA = (
    "run_id STRING, batch_id STRING, stage STRING, status STRING, started_at TIMESTAMP, "
    "ended_at TIMESTAMP, rows_in BIGINT, rows_out BIGINT, rows_rejected BIGINT, error_message STRING, checks_failed BIGINT"
)
QUALITY_LOG_SCHEMA = (
    "check_id STRING, batch_id STRING, severity STRING, table_name STRING, passed BOOLEAN, "
    "metric_value DOUBLE, threshold DOUBLE, evaluated_at TIMESTAMP"
)


@dataclass(frozen=True)
class Settings:
    """Where tables live and how they are laid out."""

    store: LayerStore
    buckets: int = DEFAULT_BUCKETS
    calendar_span: tuple[date, date] | None = None  # None: the years of the data
    split_heavy_keys: bool = True
    row_bands: Mapping[str, tuple[int, int]] = field(default_factory=dict)
    identifier_salt: str | None = None
    identifier_key: bytes | None = field(default=None, repr=False)  # instead of a salt: keyed hashes
    lookback: str | None = None
    record_changes: bool = False  # increments write down the keys they may change, for incremental gold

    @property
    def marks(self) -> Watermarks:
        return Watermarks(self.store, CURSOR)


@dataclass(frozen=True)
class LoadResult:
    entity: str
    rows_read: int
    rows_bronze: int
    rows_quarantined: int
    reached: str | None = None  # highest cursor among the rows


@dataclass(frozen=True)
class CleanResult:
    entity: str
    rows_in: int
    rows_superseded: int
    rows_silver: int
    rows_rejected: int
    reached: str | None = None  # highest cursor among the bronze rows taken


@dataclass(frozen=True)
class RunResult:
    batch_id: str
    mode: str
    loaded: tuple[LoadResult, ...]
    cleaned: tuple[CleanResult, ...]
    gold_rows: Mapping[str, int]
    quality: DataFrame | None  # one row per check

    @property
    def rows_in(self) -> int:
        return sum(c.rows_in for c in self.cleaned)

    @property
    def rows_silver(self) -> int:
        return sum(c.rows_silver for c in self.cleaned)

    @property
    def rows_rejected(self) -> int:
        return sum(c.rows_rejected for c in self.cleaned)


def new_run(now: datetime | None = None) -> Run:
    at = (now or datetime.now(timezone.utc)).astimezone(timezone.utc).replace(tzinfo=None)
    return Run(f"{at:%Y%m%d_%H%M%S}_{uuid.uuid4().hex[:8]}", at, at.date())


# --- table schemas shared by all entities ------------------------------------------------------


def _merged(schemas: list[T.StructType], tail: list[T.StructField]) -> T.StructType:
    fields: dict[str, T.StructField] = {}
    for schema in schemas:
        for f in schema.fields:
            fields.setdefault(f.name, T.StructField(f.name, f.dataType, True))
    last = {f.name for f in tail}
    return T.StructType([f for name, f in fields.items() if name not in last] + tail)


_BATCH_PARTITIONS = [T.StructField("_entity", T.StringType()), T.StructField("_batch_id", T.StringType())]


def quarantine_table(store: LayerStore) -> DataFrame:
    """All entities' quarantined rows. The declared union of their columns stands in for merging
    file footers, which would read every file's schema on each query."""
    reason = T.StructType(
        [T.StructField("_reject_reason", T.StringType()), T.StructField("_quarantined_at", T.TimestampType())]
    )
    schema = _merged([s.bronze_schema() for s in ENTITIES] + [reason], _BATCH_PARTITIONS)
    return store.read("bronze", "quarantine", schema)


def write_quarantine(store: LayerStore, rows: DataFrame, run: Run, batch: Mapping[str, str]) -> None:
    """Replace one batch's quarantined rows of one entity."""
    stamped = rows.withColumn("_quarantined_at", run.timestamp())
    store.replace_partition(stamped, "bronze", "quarantine", batch, compact=True)


_silver_schemas: dict[str, T.StructType] = {}


def silver_schema(spark: SparkSession, spec: EntitySpec) -> T.StructType:
    """Types of a cleaned and tagged entity, by analysing its plan over an empty table once."""
    if spec.name not in _silver_schemas:
        _silver_schemas[spec.name] = _analysed_schema(spark, spec)
    return _silver_schemas[spec.name]


def _analysed_schema(spark: SparkSession, spec: EntitySpec) -> T.StructType:
    run = Run("", datetime(1970, 1, 1), date(1970, 1, 1))
    bronze = spark.createDataFrame([], spec.bronze_schema())
    parents = {}
    for ref in spec.parents:
        parent = BY_NAME[ref.parent]
        parents[ref.parent] = clean(parent, spark.createDataFrame([], parent.bronze_schema()), run)
    return tag(spec, clean(spec, bronze, run), parents).schema


_BUCKET_FIELD = T.StructField(BUCKET, T.StringType())


def bronze_table(store: LayerStore, spec: EntitySpec) -> DataFrame:
    """Declared columns, so that a table without rows (and so without files) reads as empty."""
    return store.read("bronze", spec.name, T.StructType([*spec.bronze_schema().fields, _BUCKET_FIELD]))


def silver_table(store: LayerStore, spec: EntitySpec) -> DataFrame:
    """Valid rows: the tagged columns without the reason."""
    fields = [f for f in silver_schema(store.spark, spec).fields if f.name != "_reject_reason"]
    return store.read("silver", spec.name, T.StructType([*fields, _BUCKET_FIELD]))


def rejects_table(store: LayerStore) -> DataFrame:
    schemas = [silver_schema(store.spark, s) for s in ENTITIES]
    return store.read("silver", "rejects", _merged(schemas, _BATCH_PARTITIONS))


def reset_rejects(store: LayerStore) -> None:
    """Empty, typed reject table."""
    schema = _merged([silver_schema(store.spark, s) for s in ENTITIES], _BATCH_PARTITIONS)
    empty = store.spark.createDataFrame([], schema)
    store.overwrite(empty, "silver", "rejects", ("_entity", "_batch_id"))


# --- bronze ------------------------------------------------------------------------------------


def load_bronze(
    settings: Settings, spec: EntitySpec, raw: DataFrame, run: Run, mode: str, source_file: str
) -> LoadResult:
    """Load one source table: lineage, quarantine of rows without a key, overwrite or upsert. The
    mark moves after it (``run_bronze``)."""
    _check_mode(mode)
    store, marks = settings.store, settings.marks
    if mode == INCREMENTAL:
        mark = marks.get("bronze", spec.name)
        raw = newer_than(raw, parse_timestamp(spec.cursor), mark, settings.lookback)
    batch = {"_entity": spec.name, "_batch_id": run.batch_id}

    if mode == FULL:
        # The source is scanned once per output; its rows go to their buckets' folders where they are read.
        valid, quarantine = split_missing_keys(raw, spec.pk)
        enriched = add_lineage(valid, run, source_file, spec.cursor)
        overwrite_bucketed(enriched, store, "bronze", spec.name, spec.pk, settings.buckets, shuffled=False)
        quarantine = add_lineage(quarantine, run, source_file, spec.cursor)
        write_quarantine(store, quarantine, run, batch)
        loaded = bronze_table(store, spec).agg(
            F.count(F.lit(1)).alias("rows"), F.max("_cursor").cast("string").alias("reached")
        ).first()
    else:
        with Staging(store.spark) as staging:
            enriched = staging.keep(add_lineage(raw, run, source_file, spec.cursor), spec.name)
            valid, quarantine = split_missing_keys(enriched, spec.pk)

            def merge() -> None:
                newest = staging.keep(
                    latest_per_key(valid, spec.pk, newest_first("_cursor"), keep_missing_keys=False), "latest"
                )
                upsert_table(
                    newest, store, "bronze", spec.name, spec.pk, settings.buckets, newest_first("_cursor")
                )

            totals = valid.agg(F.count(F.lit(1)).alias("rows"), F.max("_cursor").cast("string").alias("reached"))
            _, loaded, _ = side_by_side((partial(write_quarantine, store, quarantine, run, batch), totals.first, merge))
    # Its own folder only: other entities write theirs at the same time.
    folder = f"quarantine/_entity={spec.name}/_batch_id={run.batch_id}"
    quarantined = store.read("bronze", folder, spec.bronze_schema()).count()
    return LoadResult(spec.name, loaded.rows + quarantined, loaded.rows, quarantined, loaded.reached)


def load_bronze_snapshot(settings: Settings, spec: EntitySpec, raw: DataFrame, run: Run, source_file: str) -> None:
    """Keep snapshots side by side: replace only this batch's partition."""
    valid, _ = split_missing_keys(add_lineage(raw, run, source_file, spec.cursor), spec.pk)
    settings.store.replace_partition(valid, "bronze", f"{spec.name}_snapshots", {"_batch_id": run.batch_id})


# --- silver ------------------------------------------------------------------------------------


def _parents(store: LayerStore, spec: EntitySpec) -> dict[str, DataFrame]:
    return {ref.parent: silver_table(store, BY_NAME[ref.parent]) for ref in spec.parents}


def _heavy(settings: Settings, spec: EntitySpec, bronze: DataFrame, staging: Staging) -> dict[str, DataFrame | None]:
    """Most frequent foreign keys, from a scan of just those columns. At most a few hundred each."""
    if not settings.split_heavy_keys:
        return {}

    def found(column: str) -> DataFrame | None:
        return some_or_none(staging.keep(heavy_keys(bronze.select(clean_text(column).alias(column)), column), column))

    columns = [ref.column for ref in spec.parents]
    return dict(zip(columns, side_by_side(partial(found, c) for c in columns), strict=True))


def clean_silver(
    settings: Settings, spec: EntitySpec, run: Run, mode: str, moved: dict[str, DataFrame], kept: Staging
) -> CleanResult:
    """Clean, deduplicate and validate one entity; write valid rows and rejects.

    An incremental run takes every key it can change: those of new bronze rows, and those of rows,
    valid or rejected, whose parents are among the keys this run has taken (``moved``, staged in
    ``kept``). All versions of these keys are cleaned again, and the table then holds exactly what they give, as
    if it had been rebuilt. The tagged rows are computed once and staged; both outputs and all
    counts come from there. The mark moves after it (``run_silver``).
    """
    _check_mode(mode)
    store, marks = settings.store, settings.marks
    bronze = fresh = bronze_table(store, spec)
    if mode == INCREMENTAL:
        mark = marks.get("silver", spec.name)
        fresh = newer_than(bronze, "_cursor", mark, settings.lookback)
    arrived = fresh.agg(F.count(F.lit(1)).alias("rows"), F.max("_cursor").cast("string").alias("reached")).first()

    with Staging(store.spark) as staging, Relay(store.spark) as relay:
        if mode == INCREMENTAL:
            keys = kept.keep(_affected_keys(settings, spec, fresh, moved), f"keys-{spec.name}")
            moved[spec.name] = keys
            if keys.isEmpty():
                return CleanResult(spec.name, 0, 0, 0, 0, None)
            bronze = bronze.withColumn("_clean_key", clean_text(spec.pk))
            chosen = keys.withColumnRenamed(spec.pk, "_clean_key")
            bronze = bronze.join(chosen, "_clean_key", "left_semi").drop("_clean_key")
            # Rows chosen by the key they are ranked by travel once for both.
            cleaned = clean(spec, bronze_table(store, spec), run).join(keys, spec.pk, "left_semi")
        else:
            cleaned = clean(spec, bronze, run)
        current = latest(spec, cleaned, keep_missing_keys=False)
        taken, heavy = side_by_side(
            (lambda: bronze.count() if mode == INCREMENTAL else arrived.rows, partial(_heavy, settings, spec, bronze, staging))
        )
        tagged = staging.keep(
            tag(spec, current, _parents(store, spec), heavy, unique_parents=True, relay=relay), spec.name
        )
        relay.release()
        valid = valid_rows(tagged)
        ok = F.col("_reject_reason").isNull()
        counts = tagged.agg(F.count_if(ok).alias("valid"), F.count_if(~ok).alias("rejected")).first()
        if mode == INCREMENTAL and settings.record_changes:
            # Before silver changes: a run that fails after it must not lose track of its keys.
            recorded = keys.select(F.col(spec.pk).alias("key"))
            store.replace_partition(recorded, "ops", CHANGED_KEYS, {"_batch_id": run.batch_id, "_entity": spec.name}, compact=True)

        def write_valid() -> None:
            if mode == FULL or not store.exists("silver", spec.name):
                overwrite_bucketed(valid, store, "silver", spec.name, spec.pk, settings.buckets, shuffled=False)
            else:
                replace_keys(valid, moved[spec.name], store, "silver", spec.name, spec.pk, settings.buckets)

        batch = {"_entity": spec.name, "_batch_id": run.batch_id}
        rejected = rejected_rows(tagged, spec.name)
        side_by_side((write_valid, partial(store.replace_partition, rejected, "silver", "rejects", batch, compact=True)))
    superseded = taken - counts.valid - counts.rejected
    return CleanResult(spec.name, arrived.rows, superseded, counts.valid, counts.rejected, arrived.reached)


CHANGED_KEYS = "changed_keys"


def changed_keys(store: LayerStore) -> DataFrame | None:
    """``(key, _batch_id, _entity)`` that increments have recorded; None if there are none."""
    if not store.exists("ops", CHANGED_KEYS) or not store.folders("ops", CHANGED_KEYS, "_batch_id"):
        return None
    return store.read("ops", CHANGED_KEYS, T.StructType.fromDDL("key STRING, _batch_id STRING, _entity STRING"))


def _affected_keys(settings: Settings, spec: EntitySpec, fresh: DataFrame, moved: Mapping[str, DataFrame]) -> DataFrame:
    """Keys of one entity that an incremental run may change, from scans of key columns only."""
    store = settings.store
    keys = fresh.select(clean_text(spec.pk).alias(spec.pk))
    stored = []
    if store.exists("silver", spec.name):
        stored.append(silver_table(store, spec))
    # The entity's own folder only: other entities write theirs at the same time.
    rejected = f"rejects/_entity={spec.name}"
    if store.exists("silver", rejected):
        stored.append(store.read("silver", rejected, silver_schema(store.spark, spec)))
    for ref in spec.parents:
        if ref.parent in moved:
            parents = moved[ref.parent].select(F.col(BY_NAME[ref.parent].pk).alias(ref.column))
            for rows in stored:
                keys = keys.unionAll(rows.select(spec.pk, ref.column).join(parents, ref.column, "left_semi").select(spec.pk))
    return keys.where(F.col(spec.pk).isNotNull()).distinct()


def sync_marks(settings: Settings, run: Run) -> None:
    """After a full load, each silver mark is the highest cursor that was read, rejects included,
    so that an unchanged source gives an incremental run nothing to do."""
    rejects = rejects_table(settings.store).where(F.col("_batch_id") == run.batch_id)
    reached = []
    for spec in ENTITIES:
        consumed = silver_table(settings.store, spec).select(spec.cursor).unionAll(
            rejects.where(F.col("_entity") == spec.name).select(spec.cursor)
        )
        reached.append(
            highest(consumed, spec.cursor).select(
                F.lit("silver").alias("layer"),
                F.lit(spec.name).alias("source_table"),
                F.col("last_watermark").alias("reached"),
            )
        )
    settings.marks.restart_all(reduce(DataFrame.unionAll, reached), run)


# --- gold --------------------------------------------------------------------------------------


def build_dimensions(settings: Settings, run: Run) -> None:
    """Rebuild calendar, patients and lookup dimensions from silver."""
    store = settings.store
    silver = {s.name: silver_table(store, s) for s in ENTITIES}
    with Staging(store.spark) as staging:
        if settings.calendar_span is None:
            days = calendar_of(
                silver["citas"].select("fecha_cita"),
                silver["facturacion"].select("fecha_factura_date"),
                silver["eventos_clinicos"].select(F.to_date("fecha_hora_evento")),
            )
        else:
            days = calendar(store.spark, *settings.calendar_span)

        def patients() -> None:
            described = dim_patient(silver["pacientes"], run, staging, settings.identifier_salt, settings.identifier_key)
            store.overwrite(described, "gold", "dim_paciente")

        def values(entity: str, column: str, key: str) -> None:
            store.overwrite(dim_lookup(silver[entity], column, key, staging), "gold", LOOKUP_DIMS[column])

        looked_up = [partial(values, fact.entity, c, key) for fact in FACTS for c, key in fact.lookups.items()]
        side_by_side([partial(store.overwrite, days, "gold", "dim_tiempo"), patients, *looked_up])


def build_gold(settings: Settings, run: Run) -> dict[str, int]:
    """Rebuild dimensions and facts from silver. Returns row counts."""
    store = settings.store
    build_dimensions(settings, run)
    silver = {s.name: silver_table(store, s) for s in ENTITIES}
    with Staging(store.spark) as staging:
        patients = store.read("gold", "dim_paciente")
        lookups = {c: store.read("gold", name) for c, name in LOOKUP_DIMS.items()}

        def fill(fact: FactSpec) -> None:
            rows = silver[fact.entity]
            heavy = None
            if settings.split_heavy_keys:
                heavy = some_or_none(staging.keep(heavy_keys(rows, "id_paciente"), "heavy-patients"))
            built = staging.keep(build_fact(fact, rows, patients, lookups, run, heavy), fact.name)
            store.clustered_on_curve(built, "gold", fact.name, fact.cluster_by, fact.pk)

        side_by_side(partial(fill, fact) for fact in FACTS)
    names = (*DIMS, *[f.name for f in FACTS])
    return dict(zip(names, side_by_side(store.read("gold", name).count for name in names), strict=True))


def publish(settings: Settings) -> None:
    """Register all layers in the catalog so SQL users can query ``layer.table``."""
    store = settings.store
    batches = ("_entity", "_batch_id")
    tables: dict[str, dict[str, tuple[T.StructType, tuple[str, ...]]]] = {
        "bronze": {s.name: (bronze_table(store, s).schema, (BUCKET,)) for s in ENTITIES if store.exists("bronze", s.name)},
        "silver": {s.name: (silver_table(store, s).schema, (BUCKET,)) for s in ENTITIES if store.exists("silver", s.name)},
        "gold": {n: (store.read("gold", n).schema, ()) for n in (*DIMS, *[f.name for f in FACTS]) if store.exists("gold", n)},
        "ops": {
            "pipeline_runs": (T.StructType.fromDDL(RUN_LOG_SCHEMA), ()),
            "data_quality_results": (T.StructType.fromDDL(QUALITY_LOG_SCHEMA), ()),
        },
    }
    if store.exists("bronze", "quarantine"):
        tables["bronze"]["quarantine"] = (quarantine_table(store).schema, batches)
    if store.exists("silver", "rejects"):
        tables["silver"]["rejects"] = (rejects_table(store).schema, batches)
    if store.exists("ops", "ingestion_watermark"):
        tables["ops"]["ingestion_watermark"] = (settings.marks.table().schema, ("layer", "source_table"))
    store.publish(tables)


# --- quality -----------------------------------------------------------------------------------


def bronze_results(settings: Settings) -> list[DataFrame]:
    frames = []
    for spec in ENTITIES:
        table = f"bronze.{spec.name}"
        present = settings.store.exists("bronze", spec.name)
        frames.append(
            q.known_result(
                settings.store.spark, table, f"Q-B00-{spec.name}", q.CRIT, 0.0 if present else 1.0, present, "table exists"
            )
        )
        if present:
            frames.append(
                q.run_checks(
                    bronze_table(settings.store, spec),
                    table,
                    [q.lineage_check(spec.name), q.missing_key_check(spec.name, spec.pk)],
                )
            )
    return frames


def load_results(settings: Settings, sources: Mapping[str, DataFrame], run: Run) -> list[DataFrame]:
    """Every source row arrived: in bronze or in quarantine (after a full load)."""
    store = settings.store
    quarantine = quarantine_table(store).where(F.col("_batch_id") == run.batch_id)
    frames = []
    for spec in ENTITIES:
        arrived = bronze_table(store, spec).select("_batch_id").unionAll(
            quarantine.where(F.col("_entity") == spec.name).select("_batch_id")
        )
        frames.append(
            q.same_total(sources[spec.name], arrived, f"bronze.{spec.name}", f"Q-B01-{spec.name}", None, 0)
        )
    return frames


def silver_results(settings: Settings, sla: float = 0.99) -> list[DataFrame]:
    store = settings.store
    silver = {s.name: silver_table(store, s) for s in ENTITIES}
    patients, visits = silver["pacientes"], silver["citas"]
    events, bills = silver["eventos_clinicos"], silver["facturacion"]
    own_checks = {
        "pacientes": [
            q.domain_check("Q-S11", "sexo", SEXES),
            q.completeness_check("Q-S14", F.col("ciudad") != UNKNOWN, 0.98, "city known"),
        ],
        "citas": [
            q.domain_check("Q-S12", "estado_cita", APPOINTMENT_STATES),
            q.flag_check("Q-S13", "motivo_cancelacion_faltante", "cancelled without a reason"),
        ],
        "eventos_clinicos": [
            q.completeness_check("Q-S15", F.col("tiene_resultado"), 0.5, "numeric result present"),
        ],
        "facturacion": [
            q.balance_check("valor_bruto", "valor_descuento", "valor_neto"),
            q.non_negative_check("valor_bruto", "valor_descuento", "valor_neto"),
        ],
    }
    frames = []
    for spec in ENTITIES:
        checks = [
            q.duplicate_check(spec.name, spec.pk),
            q.cursor_order_check(spec.name, "creado_en", "actualizado_en"),
            *own_checks[spec.name],
        ]
        if spec.name in settings.row_bands:
            checks.append(q.band_check(spec.name, *settings.row_bands[spec.name]))
        frames.append(q.run_checks(silver[spec.name], f"silver.{spec.name}", checks))

    for check_id, name, children, parents, key in (
        ("Q-S02", "citas", visits, patients, "id_paciente"),
        ("Q-S03", "eventos_clinicos", events, visits, "id_cita"),
        ("Q-S04", "eventos_clinicos", events, patients, "id_paciente"),
        ("Q-S06", "facturacion", bills, visits, "id_cita"),
        ("Q-S07", "facturacion", bills, patients, "id_paciente"),
    ):
        check = q.total_check(check_id, q.CRIT, f"{key} without a parent")
        frames.append(q.run_checks(orphans(children, parents, key), f"silver.{name}", [check]))

    owners = visits.select("id_cita", F.col("id_paciente").alias("_owner"))
    strangers = (
        events.groupBy("id_cita", "id_paciente")
        .agg(F.count(F.lit(1)).alias("rows"))
        .join(owners, "id_cita")
        .where("id_paciente <> _owner")
    )
    check = q.total_check("Q-S05", q.CRIT, "event patient differs from the appointment's")
    frames.append(q.run_checks(strangers, "silver.eventos_clinicos", [check]))
    frames.append(lost_birth_dates(bronze_table(store, BY_NAME["pacientes"]), patients))
    for spec in ENTITIES:
        keys = bronze_table(store, spec).select(clean_text(spec.pk).alias("k")).distinct()
        frames.append(q.kept_share(silver[spec.name], keys, f"silver.{spec.name}", sla))
    return frames


def lost_birth_dates(bronze: DataFrame, patients: DataFrame) -> DataFrame:
    """A birth date that was given but did not parse must be among the rejects, never in silver."""
    given = bronze.where(clean_text("fecha_nacimiento").isNotNull()).select("_row_hash")
    lost = patients.where(F.col("fecha_nacimiento").isNull()).select("_row_hash").join(given, "_row_hash", "left_semi")
    return q.run_checks(lost, "silver.pacientes", [q.empty_check("Q-S10", q.CRIT, "birth dates lost in parsing")])


def billed_difference(silver: DataFrame, gold: DataFrame) -> DataFrame:
    return q.same_total(silver, gold, "gold.fact_facturacion", "Q-G02", "valor_neto", 0.009)


def exposed_identifiers(reported: DataFrame) -> DataFrame:
    return q.forbidden_columns(reported, "gold.dim_paciente_bi", "Q-G04", DIRECT_IDENTIFIERS)


def gold_results(settings: Settings, reported: DataFrame | None = None) -> list[DataFrame]:
    """Checks of the gold tables; ``reported`` is the patient table as reports see it, where they do
    not read the one that ``create_kpi_views`` makes."""
    store = settings.store
    frames = []
    for fact in FACTS:
        silver, gold = silver_table(store, BY_NAME[fact.entity]), store.read("gold", fact.name)
        table = f"gold.{fact.name}"
        frames.append(q.same_total(silver, gold, table, f"Q-G01-{fact.name}", None, 0))
        frames.append(q.run_checks(gold, table, [q.null_check(f"Q-G03-{fact.name}", "sk_paciente", "rows without a patient key")]))
        day = next(iter(fact.date_keys))
        outside = gold.where(F.col(day).isNotNull()).join(
            store.read("gold", "dim_tiempo").select(F.col("sk_fecha").alias(day)), day, "left_anti"
        )
        check = q.empty_check(f"Q-G05-{fact.name}", q.WARN, "dates outside the calendar")
        frames.append(q.run_checks(outside, table, [check]))
    frames.append(billed_difference(silver_table(store, BY_NAME["facturacion"]), store.read("gold", "fact_facturacion")))
    frames.append(exposed_identifiers(patient_bi(store.read("gold", "dim_paciente")) if reported is None else reported))
    return frames


def mark_results(settings: Settings, before: Mapping[str, str]) -> list[DataFrame]:
    """No silver mark lies behind where it was before the run."""
    spark = settings.store.spark
    earlier = spark.createDataFrame(list(before.items()), "source_table STRING, _at STRING")
    behind = (
        settings.marks.table()
        .where(F.col("layer") == "silver")
        .join(F.broadcast(earlier), "source_table")
        .where(F.col("last_watermark") < F.col("_at").cast("timestamp"))
    )
    return [
        q.run_checks(behind, "ops.ingestion_watermark", [q.empty_check("Q-O01", q.WARN, "marks that moved back")])
    ]


def silver_content(store: LayerStore) -> dict[str, tuple[int, str, int]]:
    """Rows and digests of each silver table over what sources said, not over when it was loaded."""
    found = {}
    for spec in ENTITIES:
        table = silver_table(store, spec) if store.exists("silver", spec.name) else None
        if table is None:
            found[spec.name] = (0, "0", 0)
        else:
            columns = [c for c in table.columns if c in spec.columns]
            found[spec.name] = tuple(q.table_digest(table, [*columns, "_row_hash"]).first())
    return found


def repeat_results(
    settings: Settings, before: Mapping[str, tuple[int, str, int]], check_id: str, severity: str
) -> list[DataFrame]:
    """Silver holds the same rows as before a run that had nothing new to add: the metric is the
    change in their number, or 1 if as many rows have other contents."""
    after = silver_content(settings.store)
    return [
        q.known_result(
            settings.store.spark,
            f"silver.{name}",
            f"{check_id}-{name}",
            severity,
            abs(after[name][0] - before[name][0]) or int(after[name] != before[name]),
            after[name] == before[name],
            "rows added or replaced by a repeated or empty delivery",
        )
        for name in after
    ]


def already_succeeded(store: LayerStore, batch_id: str) -> bool:
    if not store.exists("ops", "pipeline_runs"):
        return False
    done = store.read("ops", "pipeline_runs").where(
        (F.col("batch_id") == batch_id) & (F.col("stage") == "silver") & (F.col("status") == "success")
    )
    return not done.isEmpty()


def log_quality(settings: Settings, results: DataFrame, run: Run) -> None:
    stamped = results.withColumns({"batch_id": F.lit(run.batch_id), "evaluated_at": run.timestamp()})
    columns = [field.split()[0] for field in QUALITY_LOG_SCHEMA.split(", ")]
    settings.store.append(stamped.select(*columns), "ops", "data_quality_results")


# --- runs --------------------------------------------------------------------------------------


@dataclass
class StageNote:
    """What a stage has to say when it ends."""

    rows: tuple[int | None, int | None, int | None] = (None, None, None)
    checks_failed: int | None = None


@contextmanager
def logged_stage(settings: Settings, run: Run, run_id: str, stage: str) -> Iterator[StageNote]:
    """Log a stage with its own start and end, and how it ended."""
    note, started, error = StageNote(), _now(), None
    try:
        yield note
    except Exception as failure:
        error = str(failure)
        raise
    finally:
        status = "success" if error is None else "failed"
        row = (run_id, run.batch_id, stage, status, started, _now(), *note.rows, error, note.checks_failed)
        frame = settings.store.spark.createDataFrame([row], RUN_LOG_SCHEMA)
        settings.store.append(frame, "ops", "pipeline_runs")


def run_bronze(settings: Settings, sources: Mapping[str, DataFrame], run: Run, mode: str = FULL) -> tuple[LoadResult, ...]:
    """All entities at once, as none needs another. The marks move together, after all data is written."""
    settings.marks.seed(("bronze", "silver"), [s.name for s in ENTITIES], run)
    results = tuple(
        side_by_side(partial(load_bronze, settings, s, sources[s.name], run, mode, s.name) for s in ENTITIES)
    )
    _move_marks(settings, "bronze", results, run, mode)
    return results


def _move_marks(settings: Settings, layer: str, results: Iterable[LoadResult | CleanResult], run: Run, mode: str) -> None:
    """Marks of one layer in one write: set by a full load, moved forward only by an increment."""
    rows = [(layer, r.entity, r.reached) for r in results]
    reached = settings.store.spark.createDataFrame(rows, "layer STRING, source_table STRING, reached STRING")
    reached = reached.withColumn("reached", F.col("reached").cast("timestamp"))
    (settings.marks.restart_all if mode == FULL else settings.marks.advance_all)(reached, run)


def run_silver(settings: Settings, run: Run, mode: str = FULL) -> tuple[CleanResult, ...]:
    """All entities in dependency order: parents must be in place before children are checked.
    Entities whose parents are in place are cleaned at the same time."""
    if mode == FULL:
        reset_rejects(settings.store)
    moved: dict[str, DataFrame] = {}
    found: dict[str, CleanResult] = {}
    with Staging(settings.store.spark) as kept:
        while len(found) < len(ENTITIES):
            ready = [s for s in ENTITIES if s.name not in found and all(ref.parent in found for ref in s.parents)]
            results = side_by_side(partial(clean_silver, settings, s, run, mode, moved, kept) for s in ready)
            found |= {r.entity: r for r in results}
    results = tuple(found[s.name] for s in ENTITIES)
    if mode == FULL:
        sync_marks(settings, run)
    elif any(r.reached is not None for r in results):
        _move_marks(settings, "silver", results, run, mode)
    return results


def run_all(
    settings: Settings,
    sources: Mapping[str, DataFrame],
    run: Run | None = None,
    mode: str = FULL,
    gold: bool = True,
    check: bool = True,
    fail_on: tuple[str, ...] = (q.CRIT,),
) -> RunResult:
    """Bronze, silver, checks, gold, checks. Critical silver failures stop gold from being built.

    Each stage is logged. A failed run can simply be run again: full loads replace, incremental
    ones merge by key, and marks move only after data is written.
    """
    _check_mode(mode)
    run, run_id = run or new_run(), str(uuid.uuid4())
    repeated = check and already_succeeded(settings.store, run.batch_id)
    content_before = silver_content(settings.store) if check else {}
    gold_rows: dict[str, int] = {}
    results: DataFrame | None = None
    stage = partial(logged_stage, settings, run, run_id)
    with stage("pipeline"):
        with stage("bronze") as note:
            loaded = run_bronze(settings, sources, run, mode)
            note.rows = _sums(loaded, "rows_read", "rows_bronze", "rows_quarantined")
        with stage("silver") as note:
            marks = {s.name: str(settings.marks.get("silver", s.name)) for s in ENTITIES}
            cleaned = run_silver(settings, run, mode)
            note.rows = _sums(cleaned, "rows_in", "rows_silver", "rows_rejected")
        if check:
            frames = bronze_results(settings) + silver_results(settings)
            if mode == FULL:
                frames += load_results(settings, sources, run)
            else:
                frames += mark_results(settings, marks)
            if repeated:
                frames += repeat_results(settings, content_before, "Q-O03", q.CRIT)
            elif mode == INCREMENTAL and not any(r.rows_in for r in cleaned):
                frames += repeat_results(settings, content_before, "Q-O04", q.INFO)
            gate = fail_on if not gold else tuple(s for s in fail_on if s == q.CRIT)
            results = _checked(settings, run, stage, frames, gate)
        if gold:
            with stage("gold") as note:
                gold_rows = build_gold(settings, run)
                total = sum(gold_rows.values())
                note.rows = (total, total, 0)
        if check and gold:
            results = results.unionByName(_checked(settings, run, stage, gold_results(settings), ()))
            q.require(results, fail_on)
    return RunResult(run.batch_id, mode, loaded, cleaned, gold_rows, results)


def _checked(settings: Settings, run: Run, stage, frames: list[DataFrame], gate: tuple[str, ...]) -> DataFrame:
    """Evaluate checks, log them, and stop the run if one of the gate's severities failed."""
    with stage("quality") as note:
        results = q.evaluated(q.all_results(frames))
        log_quality(settings, results, run)
        note.checks_failed = results.where(~F.col("passed")).count()
        q.require(results, gate)
    return results


def _sums(parts: Iterable, *names: str) -> tuple[int, ...]:
    return tuple(sum(getattr(p, name) for p in parts) for name in names)


def _now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def _check_mode(mode: str) -> None:
    if mode not in (FULL, INCREMENTAL):
        raise ValueError(f"load mode must be {FULL!r} or {INCREMENTAL!r}, not {mode!r}")
