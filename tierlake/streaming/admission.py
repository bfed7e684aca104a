"""Arrivals in event time: late rows go to a table of their own, repeated ones are dropped by state.

Two streams in a row, each with its own checkpoint:

- ``admit_arrivals`` compares every micro-batch with the mark that the batches before it have reached
  (their latest time less a delay). Rows at or behind the mark, and rows without a time, are late; they
  are stored, not lost. Marks are kept by batch, so a batch that is run again is split the same way and
  replaces its own rows.
- ``distinct_arrivals`` reads what was admitted and keeps the first row of each key by Spark's state,
  which holds a key for the delay after its time and no longer. Its watermark never passes the mark, so
  it drops nothing but repetitions, also those that a repeated batch may bring.

Rows of one key should carry one time: repetitions further apart than the delay are not recognised.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tierlake.sources.store import LayerStore

BATCH = "_batch"
_MARK = "_batch STRING, number BIGINT, reached TIMESTAMP"


def with_source_file(arrivals: DataFrame, column: str = "_source_file") -> DataFrame:
    """Each row with the file it came from; for frames that read files directly."""
    return arrivals.select("*", F.col("_metadata.file_path").alias(column))


def admit_arrivals(arrivals: DataFrame, time: str, delay: str, store: LayerStore, name: str, checkpoint: str) -> StreamingQuery:
    """Split all that arrived since the last start into ``name__admitted`` and ``name__late``, then stop."""

    def split(batch: DataFrame, number: int) -> None:
        mark = f"{name}__marks"
        before = None
        if store.exists("ops", mark):
            marks = store.read("ops", mark, batch.sparkSession.createDataFrame([], _MARK).schema)
            before = marks.where(F.col("number") < number).agg(F.max("reached")).first()[0]
        edge = F.lit(before).cast("timestamp") - F.expr(f"INTERVAL {delay}")
        late = F.col(time).isNull() | F.coalesce(F.col(time) <= edge, F.lit(False))
        batch = batch.persist()
        try:
            folder = {BATCH: f"b{number:09d}"}
            store.replace_partition(batch.where(late), "bronze", f"{name}__late", folder, compact=True)
            store.replace_partition(batch.where(~late), "bronze", f"{name}__admitted", folder)
            reached = batch.where(~late).agg(F.lit(number).cast("bigint").alias("number"), F.max(time).alias("reached"))
            store.replace_partition(reached, "ops", mark, folder)
        finally:
            batch.unpersist()

    stream = arrivals.writeStream.foreachBatch(split).option("checkpointLocation", checkpoint)
    return stream.trigger(availableNow=True).start()


def distinct_arrivals(
    columns: DataFrame, keys: Sequence[str], time: str, delay: str, store: LayerStore, name: str, checkpoint: str
) -> StreamingQuery:
    """Append the first row of each key among the admitted ones to ``name``, then stop. ``columns`` is
    any frame with the columns of the arrivals; its rows are not read."""
    schema = columns.schema.add(BATCH, "string")
    admitted = store.spark.readStream.schema(schema).parquet(store.path("bronze", f"{name}__admitted"))
    fresh = admitted.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(keys))
    stream = fresh.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    return stream.option("path", store.path("bronze", name)).trigger(availableNow=True).start()
