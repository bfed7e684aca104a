"""Helpers shared by the text operators."""

from __future__ import annotations

import functools
import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.window import Window

BATCH_ROWS = 256
BATCH_BYTES = 16 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Hand the package's source to the Python workers, once per application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="tierlake-code-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def prepare(spark: SparkSession) -> SparkSession:
    """Ship the code, and keep Arrow batches small enough that long texts fit a Python worker."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def in_fold(doc_id: str, modulus: int, remainder: int) -> Column:
    """Whether crc32 of the id's text leaves this remainder; false for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % modulus == remainder, F.lit(False))


def bounded_sample(rows: DataFrame, stratum: str, key: str, most: int) -> DataFrame:
    """At most ``most`` rows of each stratum, the first by hash of ``key``.

    Counts per stratum (a label set, so few) give a hash bound that leaves about twice as many rows
    before any of them travels; the exact limit is taken among those.
    """
    counts = {r[0]: r[1] for r in rows.groupBy(stratum).count().collect()}
    scale = 1 << 30
    bounds = [v for k, n in counts.items() for v in (F.lit(k), F.lit(min(scale, scale * 2 * (most + 100) // n)))]
    if not bounds:
        return rows.limit(0)
    slot = F.pmod(F.xxhash64(F.lit("sample"), F.col(key)), F.lit(scale))
    near = rows.filter(slot < F.create_map(*bounds)[F.col(stratum)])
    rank = F.row_number().over(Window.partitionBy(stratum).orderBy(slot, key))
    return near.withColumn("_rank", rank).filter(F.col("_rank") <= most).drop("_rank")


def _annotated(
    compute: Callable[[pa.RecordBatch], dict[str, pa.Array]], kept: list[str], names: list[str], batches: Iterable
) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        made = compute(batch)
        columns = [batch.column(batch.schema.get_field_index(name)) for name in kept]
        yield pa.RecordBatch.from_arrays(columns + [made[name] for name in names], names=kept + names)


def annotate(
    rows: DataFrame,
    fields: list[T.StructField],
    compute: Callable[[pa.RecordBatch], dict[str, pa.Array]],
    drop: Iterable[str] = (),
) -> DataFrame:
    """Rows plus columns computed from Arrow batches, in one pass without a shuffle.

    A column of ``rows`` that has the name of a new one is replaced by it; ``drop`` names columns
    that are computed from but not returned.
    """
    names = [field.name for field in fields]
    rows = rows.select(*[F.col(f"`{c}`") for c in rows.columns if c not in names])
    kept = [c for c in rows.columns if c not in set(drop)]
    schema = T.StructType([rows.schema[c] for c in kept] + list(fields))
    return rows.mapInArrow(functools.partial(_annotated, compute, kept, names), schema)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str | None]:
    return batch.column(batch.schema.get_field_index(column)).to_pylist()


def bytes_of(batch: pa.RecordBatch, column: str = "text") -> list[bytes | None]:
    return batch.column(batch.schema.get_field_index(column)).cast(pa.binary()).to_pylist()


def masked(rows: DataFrame, used: Iterable[str]) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """Rows whose columns other than ``used`` have names no operator uses, and the way back.

    Lets a filter carry any extra columns through operators that add columns of their own.
    """
    names = rows.columns
    hidden = [c if c in set(used) else f"carried {i}" for i, c in enumerate(names)]
    back = [F.col(f"`{c}`") for c in hidden]
    return rows.toDF(*hidden), lambda result: result.select(*back).toDF(*names)
