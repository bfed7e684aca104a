"""Lookups against a keyed table that hold up when a few keys carry most of the rows."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Keys tracked at once, and entries of the sketch that finds them.
HEAVY_LIMIT = 256
SKETCH_ENTRIES = 16_384
#: Hash slots per shuffle partition that settled rows are scattered over: many, so that partitions
#: get about equally many of them.
SLOTS_PER_PARTITION = 64


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def heavy_keys(df: DataFrame, key: str, limit: int = HEAVY_LIMIT, least_share: float | None = None) -> DataFrame:
    """Keys that hold a large share of the rows: by default more than an eighth of a partition's.

    Found by a sketch of bounded size in one aggregation, without a shuffle of keys. Which keys
    make the list only steers the join strategy, never its result, and no more than a few thousand
    keys can have so large a share; rarer ones share partitions as usual.
    """
    share = 1 / (8 * _partitions(df)) if least_share is None else least_share
    found = df.where(F.col(key).isNotNull()).agg(
        F.count(F.lit(1)).alias("rows"), F.expr(f"approx_top_k(`{key}`, {limit}, {max(limit, SKETCH_ENTRIES)})").alias("top")
    )
    return (
        found.select("rows", F.explode("top").alias("t"))
        .where(F.col("t.count") >= F.col("rows") * share)
        .select(F.col("t.item").alias(key))
    )


def some_or_none(heavy: DataFrame) -> DataFrame | None:
    """A staged list of heavy keys, or None if it is empty: then a plain join does."""
    return None if heavy.isEmpty() else heavy


def shuffles(right: DataFrame) -> bool:
    """Whether a join with this frame moves the other side: its known size is beyond a broadcast."""
    most = right.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return right._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() > most


def lookup(
    left: DataFrame,
    right: DataFrame,
    key: str,
    heavy: DataFrame | None = None,
    spread_by: Iterable[str] = (),
) -> DataFrame:
    """Left join of ``right`` (unique on ``key``) that keeps every left row once.

    Without ``heavy`` this is a plain left join: Spark broadcasts the right side when its size
    allows and otherwise splits skewed partitions adaptively. With ``heavy`` (a bounded key
    list, see ``heavy_keys``) those keys are matched by a broadcast of at most that many rows,
    found or not, and their rows and the NULL keys are scattered over many hash slots per shuffle
    partition for the remaining join instead of meeting in one task.
    """
    if heavy is None:
        return left.join(right, key, "left").select(*left.columns, *_carried(right, key))

    carried = _carried(right, key)
    found = right.join(F.broadcast(heavy), key, "left_semi")
    settled_keys = heavy.join(F.broadcast(found), key, "left").select(
        F.col(key).alias("_heavy"), *[F.col(c).alias(f"_heavy_{c}") for c in carried]
    )
    first = left.join(F.broadcast(settled_keys), F.col(key) == F.col("_heavy"), "left")

    settled = F.col("_heavy").isNotNull() | F.col(key).isNull()
    slot = F.pmod(F.xxhash64(*(spread_by or left.columns)), F.lit(max(1024, SLOTS_PER_PARTITION * _partitions(left))))
    first = first.select(
        "*",
        F.when(~settled, F.col(key)).alias("_probe"),
        F.when(settled, slot).otherwise(F.lit(0)).alias("_slot"),
    )
    # The right side always sits in slot 0; hashing keeps the optimizer from folding the column
    # away, which would drop the slot from the join's partitioning.
    rest = right.select(
        F.col(key).alias("_probe"),
        F.pmod(F.xxhash64(key), F.lit(1)).alias("_slot"),
        *[F.col(c).alias(f"_rest_{c}") for c in carried],
    )
    return first.join(rest, ["_probe", "_slot"], "left").select(
        *[F.col(c) for c in left.columns],
        *[F.coalesce(f"_heavy_{c}", f"_rest_{c}").alias(c) for c in carried],
    )


def _carried(right: DataFrame, key: str) -> list[str]:
    return [c for c in right.columns if c != key]
