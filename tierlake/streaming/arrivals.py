"""Files arriving over time, merged into a bronze table as they come."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tierlake.operators.dedupe import latest_per_key, newest_first
from tierlake.operators.entity import EntitySpec, Run, add_lineage, split_missing_keys
from tierlake.operators.upsert import DEFAULT_BUCKETS, upsert_table
from tierlake.sources.staging import Staging
from tierlake.sources.store import LayerStore


def upsert_arrivals(
    arrivals: DataFrame,
    spec: EntitySpec,
    store: LayerStore,
    run: Run,
    checkpoint: str,
    source_file: str,
    buckets: int = DEFAULT_BUCKETS,
    to_raw: Callable[[DataFrame], DataFrame] | None = None,
) -> StreamingQuery:
    """Merge every file that arrived since the last start, then stop.

    The stream's checkpoint remembers which files were read. Rows merge by key with the newest
    cursor winning, so late files and replayed micro-batches both end in the same table.
    ``to_raw`` shapes a micro-batch into the entity's text columns.
    """

    # Named by the stream, not the run: a micro-batch replayed by a later run replaces its rows.
    stream = "stream-" + hashlib.sha256(checkpoint.encode()).hexdigest()[:12]

    def merge(batch: DataFrame, batch_number: int) -> None:
        raw = to_raw(batch) if to_raw is not None else batch
        with Staging(store.spark) as staging:
            enriched = staging.keep(add_lineage(raw, run, source_file, spec.cursor), "arrivals")
            valid, quarantine = split_missing_keys(enriched, spec.pk)
            newest = staging.keep(
                latest_per_key(valid, spec.pk, newest_first("_cursor"), keep_missing_keys=False), "latest"
            )
            order = newest_first("_cursor")
            upsert_table(newest, store, "bronze", spec.name, spec.pk, buckets, order)
            partition = {"_entity": spec.name, "_batch_id": f"{stream}.{batch_number}"}
            stamped = quarantine.withColumn("_quarantined_at", run.timestamp())
            store.replace_partition(stamped, "bronze", "quarantine", partition, compact=True)

    return (
        arrivals.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
