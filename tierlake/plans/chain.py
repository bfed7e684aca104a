"""The layers over a folder of driver tables, each computed once and staged.

Queries ask for the layer they report on. A layer is written to the staging folder the first time
it is needed, the way gold tables stand between the jobs that build them and the reports that
read them, and every later query in the session scans it from there.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierlake.functions import clean_text
from tierlake.operators.entity import (
    Run,
    add_lineage,
    clean,
    latest,
    rejected_rows,
    split_missing_keys,
    tag,
    valid_rows,
)
from tierlake.operators.skew import heavy_keys, some_or_none
from tierlake.operators.star import FACTS, build_fact, calendar_of, dim_lookup, dim_patient
from tierlake.plans.entities import BY_NAME
from tierlake.plans.feed import raw_entity
from tierlake.session import pin_session
from tierlake.sources.staging import Relay, Staging

# Entities whose raw rows come from scans, without a join of large tables.
SCANNED = ("pacientes", "citas")

# A fixed run, so that results depend on the tables alone.
RUN = Run("20020101_000000_cafe0001", datetime(2002, 1, 1), date(2002, 1, 1))

_chains: dict[tuple[str, str], Chain] = {}


def chain(spark: SparkSession, tables_dir: str) -> Chain:
    pin_session(spark)
    key = (spark.sparkContext.applicationId, tables_dir)
    if key not in _chains:
        _chains[key] = Chain(spark, tables_dir)
    return _chains[key]


class Chain:
    def __init__(self, spark: SparkSession, tables_dir: str):
        self.spark = spark
        self.dir = tables_dir
        self.staging = Staging(spark)
        self._kept: dict[str, DataFrame] = {}
        self._lists: dict[str, DataFrame | None] = {}

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    def raw(self, entity: str) -> DataFrame:
        return raw_entity(self.spark, self.dir, entity)

    def _once(self, name: str, build) -> DataFrame:
        if name not in self._kept:
            self._kept[name] = self.staging.keep(build(), name)
        return self._kept[name]

    def arriving(self, entity: str) -> DataFrame:
        """Raw rows with lineage for a reader of a few columns: those alone are computed, unless the
        loaded rows are there already."""
        spec = BY_NAME[entity]
        known = self._kept.get(f"loaded-{entity}")
        return add_lineage(self.raw(entity), RUN, entity, spec.cursor) if known is None else known

    def loaded(self, entity: str) -> DataFrame:
        """Raw rows with lineage, quarantine included. They stay where they are read: a staged frame has
        no bucket folders to line rows up with, and the next step shuffles them by the cleaned key."""
        return self._once(f"loaded-{entity}", lambda: self.arriving(entity))

    def bronze(self, entity: str) -> DataFrame:
        """Rows with a usable key. Those that scans give are derived where they are read: that costs
        neither a shuffle nor disk, as staging them would."""
        rows = self.arriving(entity) if entity in SCANNED else self.loaded(entity)
        return split_missing_keys(rows, BY_NAME[entity].pk)[0]

    def quarantine(self, entity: str) -> DataFrame:
        return split_missing_keys(self.loaded(entity), BY_NAME[entity].pk)[1].withColumn(
            "_entity", F.lit(entity)
        )

    def cleaned(self, entity: str) -> DataFrame:
        return clean(BY_NAME[entity], self.bronze(entity), RUN)

    def latest(self, entity: str) -> DataFrame:
        return latest(BY_NAME[entity], self.cleaned(entity), keep_missing_keys=False)

    def heavy(self, entity: str, column: str) -> DataFrame | None:
        def build() -> DataFrame:
            return heavy_keys(self.bronze(entity).select(clean_text(column).alias(column)), column)

        name = f"heavy-{entity}-{column}"
        if name not in self._lists:
            self._lists[name] = some_or_none(self._once(name, build))
        return self._lists[name]

    def tagged(self, entity: str) -> DataFrame:
        spec, name = BY_NAME[entity], f"tagged-{entity}"
        if name not in self._kept:
            parents = {ref.parent: self.silver(ref.parent) for ref in spec.parents}
            with self._passing_by(entity), Relay(self.spark) as relay:
                heavy = {ref.column: self.heavy(entity, ref.column) for ref in spec.parents}
                self._once(name, lambda: tag(spec, self.latest(entity), parents, heavy, unique_parents=True, relay=relay))
        return self._kept[name]

    @contextmanager
    def _passing_by(self, entity: str) -> Iterator[None]:
        """Loaded rows that nobody has asked for are on disk only while the tagged ones are made."""
        name = f"loaded-{entity}"
        if entity in SCANNED or name in self._kept:
            yield
            return
        with Staging(self.spark) as passing:
            self._kept[name] = passing.keep(self.arriving(entity), name)
            try:
                yield
            finally:
                del self._kept[name]

    def silver(self, entity: str) -> DataFrame:
        return valid_rows(self.tagged(entity))

    def rejects(self, entity: str) -> DataFrame:
        return rejected_rows(self.tagged(entity), entity)

    @property
    def calendar(self) -> DataFrame:
        """The years of all dates in silver."""
        return self._once(
            "calendar",
            lambda: calendar_of(
                self.silver("citas").select("fecha_cita"),
                self.silver("facturacion").select("fecha_factura_date"),
                self.silver("eventos_clinicos").select(F.to_date("fecha_hora_evento")),
            ),
        )

    @property
    def patients(self) -> DataFrame:
        return self._once(
            "dim-patients", lambda: dim_patient(self.silver("pacientes"), RUN, self.staging)
        )

    def lookup(self, column: str) -> DataFrame:
        fact = next(f for f in FACTS if column in f.lookups)
        return self._once(
            f"dim-{column}",
            lambda: dim_lookup(self.silver(fact.entity), column, fact.lookups[column], self.staging),
        )

    def _built_fact(self, entity: str) -> DataFrame:
        spec = next(f for f in FACTS if f.entity == entity)
        lookups = {column: self.lookup(column) for column in spec.lookups}
        heavy = self.heavy(entity, "id_paciente")
        return build_fact(spec, self.silver(entity), self.patients, lookups, RUN, heavy)

    def fact(self, entity: str) -> DataFrame:
        return self._once(f"fact-{entity}", lambda: self._built_fact(entity))

    def fact_for_once(self, entity: str) -> DataFrame:
        """The fact for a query that scans it once: of its rows only the columns read there travel and
        nothing is written, unless the fact is there already."""
        known = self._kept.get(f"fact-{entity}")
        return self._built_fact(entity) if known is None else known
