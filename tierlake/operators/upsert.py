"""Merging rows into a keyed table: whole-frame rules, and their bucketed table form."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierlake.functions import content_hash
from tierlake.operators.dedupe import latest_per_key
from tierlake.sources.staging import Staging
from tierlake.sources.store import LayerStore

BUCKET = "_bucket"
DEFAULT_BUCKETS = 16
#: So many keys are broadcast to find their stored rows; more keys meet the stored rows in a shuffle.
FEW_KEYS = 100_000


def replace_matching(target: DataFrame, source: DataFrame, pk: str) -> DataFrame:
    """Source rows replace target rows of the same key; others are kept or added.

    The source must hold each key once.
    """
    kept = target.join(source.select(pk), pk, "left_anti")
    return kept.unionByName(source, allowMissingColumns=True)


def changed_rows(target: DataFrame, source: DataFrame, pk: str, by: str | Iterable[str]) -> DataFrame:
    """Source rows that are new or differ from the target: in a hash column, or in given columns."""
    content = F.col(by) if isinstance(by, str) else content_hash(by)
    same = (
        source.select(pk, content.alias("_new"))
        .join(target.select(pk, content.alias("_old")), pk)
        .where(F.col("_new").eqNullSafe(F.col("_old")))
        .select(pk)
    )
    return source.join(same, pk, "left_anti").select(*source.columns)


def keep_newest(
    target: DataFrame, source: DataFrame, pk: str, order: Iterable[Column]
) -> DataFrame:
    """Merge in which the newest version of a key wins, wherever it comes from: rows that arrive
    late never overwrite newer ones, and merging the same rows again changes nothing."""
    both = target.unionByName(source, allowMissingColumns=True)
    return latest_per_key(both, pk, order, keep_missing_keys=False)


def mark_missing(target: DataFrame, snapshot: DataFrame, pk: str) -> DataFrame:
    """Soft delete: ``_is_active`` is false for rows whose key left the full source snapshot."""
    seen = snapshot.select(pk).distinct().withColumn("_seen", F.lit(True))
    active = F.coalesce(F.col("_seen"), F.lit(False)).alias("_is_active")
    columns = [c for c in target.columns if c != "_is_active"]
    return target.join(seen, pk, "left").select(*columns, active)


def bucket_of(pk: str, buckets: int) -> Column:
    """Storage bucket of a key, labelled with the bucket count so that layouts never mix."""
    number = F.pmod(F.xxhash64(pk), F.lit(buckets)).cast("int")
    return F.format_string(f"of{buckets}-%05d", number)


def placed_by_bucket(df: DataFrame, pk: str, buckets: int = DEFAULT_BUCKETS) -> DataFrame:
    """Rows with their bucket, shuffled to line up with the bucket folders. Derive columns after
    this rather than before, so that they need not travel. Adaptive execution splits a bucket
    that many versions of one key have made too large."""
    return df.withColumn(BUCKET, bucket_of(pk, buckets)).hint("rebalance", BUCKET)


def overwrite_bucketed(
    df: DataFrame,
    store: LayerStore,
    layer: str,
    name: str,
    pk: str,
    buckets: int = DEFAULT_BUCKETS,
    shuffled: bool = True,
) -> None:
    """Replace a bucketed table. Rows that are not ``shuffled`` leave each task for all buckets at once:
    more and smaller files, but whole rows do not travel."""
    placed = placed_by_bucket(df, pk, buckets) if shuffled else df.withColumn(BUCKET, bucket_of(pk, buckets))
    store.overwrite(placed, layer, name, [BUCKET], placed=True)


def upsert_table(
    df: DataFrame,
    store: LayerStore,
    layer: str,
    name: str,
    pk: str,
    buckets: int = DEFAULT_BUCKETS,
    newest: Iterable[Column] | None = None,
    only_changed_by: str | Iterable[str] | None = None,
) -> None:
    """Upsert a frame into a bucketed table, rewriting only the buckets of rows that win.

    Winners are decided on the source and the target rows of its keys alone. A few keys are broadcast,
    so target rows are not shuffled; more of them meet the rows of their buckets in one shuffle. A
    source without winners writes nothing; an absent table is created. ``df`` is evaluated more than
    once: pass a staged frame. Running again after a failure gives the same table (see
    ``LayerStore.replace_logged``).
    """
    if not store.exists(layer, name):
        store.overwrite(df.withColumn(BUCKET, bucket_of(pk, buckets)), layer, name, [BUCKET])
        return
    store.redo(layer, name, [BUCKET])
    with Staging(store.spark) as staging:
        table = _in_layout(store, layer, name, buckets, df)
        source = df.withColumn(BUCKET, bucket_of(pk, buckets))
        arriving = _rows_by_bucket(source)
        target = table.where(F.col(BUCKET).isin(list(arriving)))
        if only_changed_by is not None:
            source = changed_rows(target, source, pk, only_changed_by)
        if newest is not None:
            if sum(arriving.values()) <= FEW_KEYS:
                target = target.join(F.broadcast(source.select(pk)), pk, "left_semi")
            source = winning_rows(target, source, pk, newest)
        winners = staging.keep(source, "winners")
        replace_keys(winners, winners.select(pk), store, layer, name, pk, buckets)


def winning_rows(target: DataFrame, source: DataFrame, pk: str, newest: Iterable[Column]) -> DataFrame:
    """Source rows that are the newest of their key and not already stored as they are.

    Both sides meet in one shuffle by key, after which each key is decided where it lies.
    """
    stored = target.withColumn("_incoming", F.lit(False))
    both = stored.unionByName(source.withColumn("_incoming", F.lit(True)), allowMissingColumns=True).repartition(pk)
    shared = [c for c in source.columns if c in target.columns and c not in (pk, BUCKET)]
    again = F.bool_or(~F.col("_incoming")).over(Window.partitionBy(pk, *shared))
    # A version that is already stored wins without changing anything.
    rivals = both.withColumn("_again", F.col("_incoming") & again).where("NOT _again")
    best = latest_per_key(rivals, pk, newest, keep_missing_keys=False)
    return best.where("_incoming").select(*source.columns)


def replace_keys(
    rows: DataFrame, keys: DataFrame, store: LayerStore, layer: str, name: str, pk: str, buckets: int = DEFAULT_BUCKETS
) -> None:
    """Give the keys exactly these rows: other rows of the keys go, keys without rows disappear.

    Kept rows stay in the order of the files they come from; only the new rows are shuffled. More than a
    few keys meet the stored rows in a shuffle, from which buckets that keep no row are left out.
    """
    store.redo(layer, name, [BUCKET])
    keys = keys.select(pk).withColumn(BUCKET, bucket_of(pk, buckets))
    named = _rows_by_bucket(keys)
    touched = set(named)
    if not touched:
        return
    table = _in_layout(store, layer, name, buckets, rows).where(F.col(BUCKET).isin(sorted(touched)))
    few = sum(named.values()) <= FEW_KEYS
    keeping = touched if few else touched - _emptied(table, keys, pk, named)
    kept = table.where(F.col(BUCKET).isin(sorted(keeping))).join(keys.select(pk), pk, "left_anti")
    placed = rows.drop(BUCKET).withColumn(BUCKET, bucket_of(pk, buckets))
    if few:
        merged = kept.unionByName(placed.hint("rebalance", BUCKET), allowMissingColumns=True)
    else:
        merged = kept.unionByName(placed, allowMissingColumns=True).hint("rebalance", BUCKET)
    # A bucket whose rows all go would not be replaced by an absent folder: it is emptied first.
    bare = touched - _touched(placed)
    if bare & keeping:
        bare -= _touched(kept.where(F.col(BUCKET).isin(sorted(bare & keeping))))
    if len(bare) < len(touched):
        store.replace_logged(merged, layer, name, [BUCKET])
    for bucket in sorted(bare):
        store.drop_partition(layer, name, {BUCKET: bucket})


def _emptied(table: DataFrame, keys: DataFrame, pk: str, named: dict[str, int]) -> set[str]:
    """Buckets with none but rows of the keys. Only keys are read, and only where as many are named as
    there are rows."""
    stored = _rows_by_bucket(table)
    candidates = {b for b, n in named.items() if n >= stored.get(b, 0)}
    if not candidates:
        return set()
    others = table.where(F.col(BUCKET).isin(sorted(candidates))).select(pk, BUCKET).join(keys.select(pk), pk, "left_anti")
    return candidates - _touched(others)


def _touched(rows: DataFrame) -> set[str]:
    """Buckets of the rows: at most ``buckets`` short strings, whatever the size of the data."""
    return {row[0] for row in rows.select(BUCKET).distinct().collect()}


def _rows_by_bucket(rows: DataFrame) -> dict[str, int]:
    """Row counts of the buckets that the rows fall in; at most ``buckets`` of them."""
    return {row[0]: row[1] for row in rows.groupBy(BUCKET).count().collect()}


def _in_layout(store: LayerStore, layer: str, name: str, buckets: int, like: DataFrame) -> DataFrame:
    """The stored table; one without rows has the columns of the frame to be merged."""
    labels = store.folders(layer, name, BUCKET)
    if not labels:
        schema = like.drop(BUCKET).withColumn(BUCKET, F.lit("")).schema
        return store.read(layer, name, schema)
    if not labels[0].startswith(f"of{buckets}-"):
        raise ValueError(f"{layer}.{name} is laid out as {labels[0]}, not in {buckets} buckets")
    return store.read(layer, name)
