"""Persisted high-water marks, one per consuming layer and entity."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tierlake.operators.entity import Run
from tierlake.sources.store import LayerStore

EPOCH = "1970-01-01 00:00:00"
TABLE = "ingestion_watermark"
SCHEMA = (
    "watermark_column STRING, last_watermark TIMESTAMP, last_batch_id STRING, "
    "updated_at TIMESTAMP, layer STRING, source_table STRING"
)


class Watermarks:
    """``ops.ingestion_watermark``: a partition per (layer, source), so each advances alone.

    Layers keep separate cursors. With a shared one, loading bronze would hide its new rows from
    silver.
    """

    def __init__(self, store: LayerStore, column: str):
        self.store = store
        self.column = column

    def table(self) -> DataFrame:
        return self.store.read("ops", TABLE, StructType.fromDDL(SCHEMA))

    def seed(self, layers: Iterable[str], sources: Iterable[str], run: Run) -> None:
        """Write EPOCH rows for pairs that have none yet."""
        wanted = [(layer, source) for layer in layers for source in sources]
        rows = self.store.spark.createDataFrame(wanted, "layer STRING, source_table STRING")
        if self.store.exists("ops", TABLE):
            rows = rows.join(self.table(), ["layer", "source_table"], "left_anti")
        self._write(self._row(rows, F.lit(EPOCH).cast("timestamp"), F.lit(None).cast("string"), run))

    def get(self, layer: str, source: str) -> datetime | str:
        """Last mark, EPOCH if there is none. Failures other than a missing table are raised."""
        if not self.store.exists("ops", TABLE):
            return EPOCH
        row = (
            self.table()
            .where((F.col("layer") == layer) & (F.col("source_table") == source))
            .select(F.date_format("last_watermark", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("at"))
            .first()
        )
        return row.at if row is not None and row.at is not None else EPOCH

    def restart(self, layer: str, source: str, reached: datetime | str | None, run: Run) -> None:
        """Set a mark to where a full load ended, also if that lies behind it."""
        keys = self.store.spark.createDataFrame([(layer, source)], "layer STRING, source_table STRING")
        self.restart_all(keys.withColumn("reached", _timestamp(EPOCH if reached is None else reached)), run)

    def restart_all(self, reached: DataFrame, run: Run) -> None:
        mark = F.coalesce("reached", _timestamp(EPOCH))
        self._write(self._row(reached, mark, F.lit(run.batch_id), run))

    def advance(self, layer: str, source: str, reached: datetime | str | None, run: Run) -> None:
        """Move a mark forward; an older or missing time leaves it where it is."""
        if reached is None:
            return
        keys = self.store.spark.createDataFrame([(layer, source)], "layer STRING, source_table STRING")
        self.advance_all(keys.withColumn("reached", _timestamp(reached)), run)

    def advance_all(self, reached: DataFrame, run: Run) -> None:
        """Move several marks (layer, source_table, reached) forward in one write."""
        reached = reached.where(F.col("reached").isNotNull())
        mark = F.col("reached")
        if self.store.exists("ops", TABLE):
            known = self.table().select("layer", "source_table", "last_watermark")
            reached = reached.join(known, ["layer", "source_table"], "left")
            mark = F.greatest("last_watermark", "reached")
        self._write(self._row(reached, mark, F.lit(run.batch_id), run))

    def _row(self, keys: DataFrame, mark: Column, batch_id: Column, run: Run) -> DataFrame:
        return keys.select(
            F.lit(self.column).alias("watermark_column"),
            mark.alias("last_watermark"),
            batch_id.alias("last_batch_id"),
            run.timestamp().alias("updated_at"),
            "layer",
            "source_table",
        )

    def _write(self, rows: DataFrame) -> None:
        self.store.replace_partitions(rows, "ops", TABLE, ["layer", "source_table"])


def _timestamp(value: datetime | str) -> Column:
    return F.lit(value if isinstance(value, str) else value.isoformat(sep=" ")).cast("timestamp")


def newer_than(df: DataFrame, cursor: str | Column, mark: datetime | str, lookback: str | None = None) -> DataFrame:
    """Rows strictly past the mark; rows without a cursor are left out.

    ``lookback`` (such as ``"2 days"``) also takes rows up to that far behind the mark, for
    late arrivals. Re-reading them is harmless when they are merged by key.
    """
    edge = _timestamp(mark)
    if lookback is not None:
        edge = edge - F.expr(f"INTERVAL {lookback}")
    return df.where((F.col(cursor) if isinstance(cursor, str) else cursor) > edge)


def highest(df: DataFrame, cursor: str) -> DataFrame:
    return df.agg(F.max(cursor).alias("last_watermark"))
