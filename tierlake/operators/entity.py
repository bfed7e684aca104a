"""Declared entities: how raw text becomes typed rows, and what makes a row invalid."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierlake.functions import clean_text, null_like, parse_timestamp, row_hash
from tierlake.operators.dedupe import latest_per_key, newest_first
from tierlake.operators.skew import lookup, shuffles
from tierlake.sources.staging import Relay

LINEAGE = ("_ingested_at", "_source_file", "_batch_id", "_row_hash")


@dataclass(frozen=True)
class Run:
    """Identity and clock of one run; the only source of time in any plan."""

    batch_id: str
    at: datetime
    as_of: date

    def timestamp(self) -> Column:
        return F.lit(self.at.isoformat(sep=" ")).cast("timestamp")


@dataclass(frozen=True)
class ParentRef:
    """A foreign key: rows get ``marker`` (and any carried columns) when the parent exists."""

    column: str
    parent: str
    parent_key: str
    marker: str
    carries: Mapping[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class Rule:
    """A reason to reject a row. ``when_unknown`` decides rows whose predicate is NULL."""

    reason: str
    fails: Callable[[], Column]
    when_unknown: bool = True


@dataclass(frozen=True)
class EntitySpec:
    name: str
    pk: str
    cursor: str
    columns: tuple[str, ...]
    casts: Mapping[str, Callable[[str], Column]]
    from_raw: Mapping[str, Callable[[], Column]] = field(default_factory=dict)
    derived: tuple[Mapping[str, Callable[[Run], Column]], ...] = ()
    parents: tuple[ParentRef, ...] = ()
    after_parents: Mapping[str, Callable[[], Column]] = field(default_factory=dict)
    rules: tuple[Rule, ...] = ()
    scratch: tuple[str, ...] = ()

    def bronze_schema(self) -> T.StructType:
        text = [T.StructField(c, T.StringType()) for c in self.columns]
        return T.StructType(
            [
                *text,
                T.StructField("_ingested_at", T.TimestampType()),
                T.StructField("_source_file", T.StringType()),
                T.StructField("_batch_id", T.StringType()),
                T.StructField("_row_hash", T.StringType()),
                T.StructField("_cursor", T.TimestampType()),
            ]
        )


def add_lineage(df: DataFrame, run: Run, source_file: str, cursor: str | None = None) -> DataFrame:
    """Attach load time, origin, batch and content hash.

    ``_cursor`` is the change cursor parsed once at load, so incremental reads compare a typed
    column and the comparison reaches Parquet row groups.
    """
    business = [c for c in df.columns if not c.startswith("_")]
    added = {
        "_ingested_at": run.timestamp(),
        "_source_file": F.lit(source_file),
        "_batch_id": F.lit(run.batch_id),
        "_row_hash": row_hash(business),
    }
    if cursor is not None:
        added["_cursor"] = parse_timestamp(cursor)
    return df.withColumns(added)


def split_missing_keys(df: DataFrame, pk: str) -> tuple[DataFrame, DataFrame]:
    """(rows with a usable key, quarantined rows with a reason)."""
    missing = null_like(pk)
    quarantine = df.where(missing).withColumn("_reject_reason", F.lit(f"PK vacía o inválida: {pk}"))
    return df.where(~missing), quarantine


def clean(spec: EntitySpec, bronze: DataFrame, run: Run) -> DataFrame:
    """Typed columns, derived columns and lineage of an entity."""
    typed = [spec.casts.get(c, clean_text)(c).alias(c) for c in spec.columns]
    extra = [make().alias(name) for name, make in spec.from_raw.items()]
    df = bronze.select(*typed, *extra, *LINEAGE)
    for stage in spec.derived:
        df = df.withColumns({name: make(run) for name, make in stage.items()})
    return df.withColumn("_silver_processed_at", run.timestamp())


def latest(spec: EntitySpec, cleaned: DataFrame, keep_missing_keys: bool = True) -> DataFrame:
    return latest_per_key(cleaned, spec.pk, newest_first(spec.cursor), keep_missing_keys)


def attach_parents(
    spec: EntitySpec,
    df: DataFrame,
    parents: Mapping[str, DataFrame],
    heavy: Mapping[str, DataFrame] | None = None,
    unique_parents: bool = False,
    relay: Relay | None = None,
) -> DataFrame:
    """One left join per foreign key, on the parent's key and carried columns only.

    With a ``relay``, rows are staged before each join that shuffles them, so that the files of one
    shuffle at a time are on disk; the result is to be read before the relay ends.
    """
    for ref in spec.parents:
        keys = parents[ref.parent].select(
            F.col(ref.parent_key).alias(ref.column),
            *[F.col(source).alias(name) for source, name in ref.carries.items()],
        )
        if not unique_parents:
            keys = keys.groupBy(ref.column).agg(*[F.max(n).alias(n) for n in ref.carries.values()]) \
                if ref.carries else keys.distinct()
        keys = keys.where(F.col(ref.column).isNotNull()).withColumn(ref.marker, F.lit(True))
        if relay is not None and shuffles(keys):
            df = relay.keep(df, ref.column)
        df = lookup(df, keys, ref.column, (heavy or {}).get(ref.column), [spec.pk])
    return df.withColumns({name: make() for name, make in spec.after_parents.items()})


def tag(
    spec: EntitySpec,
    df: DataFrame,
    parents: Mapping[str, DataFrame] | None = None,
    heavy: Mapping[str, DataFrame] | None = None,
    unique_parents: bool = False,
    relay: Relay | None = None,
) -> DataFrame:
    """Add ``_reject_reason``: the first rule a row breaks, or NULL for valid rows.

    One pass that loses no row: every predicate has an explicit outcome for NULL.
    """
    attached = attach_parents(spec, df, parents or {}, heavy, unique_parents, relay)
    reasons = [
        F.when(F.coalesce(rule.fails(), F.lit(rule.when_unknown)), F.lit(rule.reason))
        for rule in spec.rules
    ]
    helpers = [ref.marker for ref in spec.parents]
    helpers += [name for ref in spec.parents for name in ref.carries.values()]
    return attached.withColumn("_reject_reason", F.coalesce(*reasons)).drop(*helpers, *spec.scratch)


def valid_rows(tagged: DataFrame) -> DataFrame:
    return tagged.where(F.col("_reject_reason").isNull()).drop("_reject_reason")


def rejected_rows(tagged: DataFrame, entity: str) -> DataFrame:
    return tagged.where(F.col("_reject_reason").isNotNull()).withColumn("_entity", F.lit(entity))


def union_rejects(frames: list[DataFrame]) -> DataFrame:
    """Rejects of several entities as one table; columns an entity lacks are NULL."""
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame, allowMissingColumns=True)
    return result


def reject_counts(rejects: DataFrame) -> DataFrame:
    return rejects.groupBy("_entity", "_reject_reason").agg(F.count(F.lit(1)).alias("rows"))
