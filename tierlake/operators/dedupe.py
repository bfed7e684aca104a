"""Keeping the latest row per key."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def newest_first(cursor: str) -> list[Column]:
    """Total order of row versions: cursor, then load time, then content and origin."""
    return [
        F.col(cursor).desc_nulls_last(),
        F.col("_ingested_at").desc_nulls_last(),
        F.col("_row_hash").asc_nulls_last(),
        F.col("_source_file").asc_nulls_last(),
    ]


def latest_per_key(
    df: DataFrame,
    keys: str | Iterable[str],
    order: Iterable[Column],
    keep_missing_keys: bool = True,
) -> DataFrame:
    """First row of each key in the given order.

    Spark limits each key to its best row before the shuffle (``WindowGroupLimit``), so a key with
    very many versions sends one row per map task. Rows whose key is NULL are not versions of one
    another and all stay, unless the input is known to have none.
    """
    names = [keys] if isinstance(keys, str) else list(keys)
    missing = F.lit(False)
    for name in names:
        missing = missing | F.col(name).isNull()
    window = Window.partitionBy(*names).orderBy(*order)
    keyed = df.where(~missing) if keep_missing_keys else df
    latest = keyed.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")
    return latest.unionByName(df.where(missing)) if keep_missing_keys else latest
