"""Dense integer keys in key order, without pulling the table into one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierlake.sources.staging import Staging

# Layout of monotonically_increasing_id: partition number above 33 bits, row position below.
_POSITION_BITS = 33
_POSITION_MASK = (1 << _POSITION_BITS) - 1


def dense_key(df: DataFrame, order_by: str, name: str, staging: Staging) -> DataFrame:
    """Number rows 1..n by ``order_by`` (NULL first), as a global ``row_number`` would.

    Rows are range-partitioned and sorted once, and each row's (range, position) is written with
    it. The number of a row is its position plus the size of all earlier ranges; there are as
    many ranges as write tasks, so that running sum is small whatever the table's size. The
    ranges come from a sample that a second evaluation could draw differently, hence the staging.
    """
    placed = (
        df.repartitionByRange(order_by)
        .sortWithinPartitions(order_by)
        .withColumn("_place", F.monotonically_increasing_id())
    )
    kept = staging.keep(placed, f"keyed-{name}").withColumns(
        {
            "_range": F.shiftright("_place", _POSITION_BITS),
            "_position": F.col("_place").bitwiseAND(F.lit(_POSITION_MASK)),
        }
    )
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        kept.groupBy("_range")
        .agg(F.count(F.lit(1)).alias("_size"))
        .select("_range", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_start"))
    )
    return kept.join(F.broadcast(starts), "_range").select(
        (F.col("_start") + F.col("_position") + 1).alias(name), *df.columns
    )


def stable_key(df: DataFrame, existing: DataFrame, key: str, name: str, staging: Staging) -> DataFrame:
    """Keep the numbers already assigned in ``existing`` (key, number); number new keys after them."""
    known = existing.select(key, name)
    top = known.agg(F.coalesce(F.max(name), F.lit(0))).scalar()
    kept = df.join(known, key, "inner").select(name, *df.columns)
    fresh = dense_key(df.join(known, key, "left_anti"), key, "_fresh", staging)
    numbered = fresh.select((F.col("_fresh") + top).alias(name), *df.columns)
    return kept.unionByName(numbered)
