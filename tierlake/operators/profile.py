"""Profiling of source tables before they are loaded."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierlake.functions import null_like, parse_timestamp, value_shape


def null_counts(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Null-like values per column, in one pass."""
    names = list(columns) if columns is not None else df.columns
    return df.agg(*[F.count_if(null_like(c)).alias(c) for c in names])


def duplicate_count(df: DataFrame, key: str) -> DataFrame:
    """Rows, distinct keys (NULL counts as one) and surplus rows."""
    distinct = F.count_distinct(key) + F.max(F.col(key).isNull().cast("int"))
    return df.agg(
        F.count(F.lit(1)).alias("rows"), F.coalesce(distinct, F.lit(0)).alias("distinct_keys")
    ).withColumn("duplicates", F.col("rows") - F.col("distinct_keys"))


def cardinality(df: DataFrame, columns: Iterable[str], approximate: bool = False) -> DataFrame:
    """Distinct values per column as (column, distinct_values); NULL counts as one.

    Exact counts first reduce the table to its distinct (column, value) pairs, map-side before
    the shuffle, so columns of low cardinality cost next to nothing.
    """
    names = list(columns)
    pairs = df.select(
        F.explode(
            F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in names])
        ).alias("pair")
    ).select("pair.*")
    if approximate:
        counted = F.approx_count_distinct("value") + F.max(F.col("value").isNull().cast("int"))
        return pairs.groupBy("column").agg(counted.alias("distinct_values"))
    return pairs.distinct().groupBy("column").agg(F.count(F.lit(1)).alias("distinct_values"))


def top_values(df: DataFrame, column: str, n: int = 10) -> DataFrame:
    """Most frequent values; equal counts are ordered by value."""
    return (
        df.groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("rows"))
        .orderBy(F.desc("rows"), F.asc_nulls_first("value"))
        .limit(n)
    )


def time_range(df: DataFrame, column: str) -> DataFrame:
    stamp = parse_timestamp(column)
    return df.agg(F.min(stamp).alias("first"), F.max(stamp).alias("last"))


def coverage(parents: DataFrame, children: DataFrame, key: str) -> DataFrame:
    """Parents, parents with a child, children, and mean children per parent that has any."""
    rows = parents.select(F.lit(1).alias("p"), F.lit(None).alias("k"), F.lit(0).alias("c")).unionAll(
        children.select(F.lit(0), F.col(key), F.lit(1))
    )
    mean = F.round(F.col("children") / F.nullif(F.col("parents_with_children"), F.lit(0)), 2)
    return rows.agg(
        F.sum("p").alias("parents"),
        F.count_distinct("k").alias("parents_with_children"),
        F.sum("c").alias("children"),
    ).withColumn("mean_children", mean)


def value_shapes(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(value_shape(column).alias("shape")).agg(F.count(F.lit(1)).alias("rows"))


def orphans(children: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """Keys (and their row counts) that no parent has; NULL is one of them.

    Child rows are counted per key first, so a key that dominates the children is joined once.
    """
    counted = children.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    return counted.join(parents.select(key).distinct(), key, "left_anti")


def orphan_count(children: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """Child rows whose key no parent has."""
    return orphans(children, parents, key).agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("orphans"))


def mismatch_count(left: DataFrame, right: DataFrame, key: str, column: str) -> DataFrame:
    """How many pairs of rows with equal keys differ in a column (NULL on a side is no difference).

    The pairs are counted, not formed: all pairs of a key, less the pairs that agree.
    """

    def tally(df: DataFrame, name: str) -> DataFrame:
        return df.where(F.col(column).isNotNull()).groupBy(key, column).agg(F.count(F.lit(1)).alias(name))

    a, b = tally(left, "a"), tally(right, "b")
    pairs = a.groupBy(key).agg(F.sum("a").alias("a")).join(b.groupBy(key).agg(F.sum("b").alias("b")), key)
    agreeing = a.join(b, [key, column])
    signed = pairs.select((F.col("a") * F.col("b")).alias("n")).unionAll(
        agreeing.select(-(F.col("a") * F.col("b")))
    )
    return signed.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("mismatches"))


def unbalanced_rows(df: DataFrame, gross: str, discount: str, net: str) -> DataFrame:
    """Rows whose raw amounts, read as doubles, do not add up at two decimals."""
    amounts = [F.col(c).try_cast("double") for c in (gross, discount, net)]
    return df.where(F.round(amounts[0] - amounts[1], 2) != F.round(amounts[2], 2))


def unbalanced_count(df: DataFrame, gross: str, discount: str, net: str) -> DataFrame:
    return unbalanced_rows(df, gross, discount, net).agg(F.count(F.lit(1)).alias("unbalanced"))


def preview(df: DataFrame, key: str, n: int = 10) -> DataFrame:
    """A few rows to look at: those with the first digests of their keys, so the same every time."""
    return df.orderBy(F.md5(F.col(key).cast("string")), *df.columns).limit(n)


def batch_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count_distinct("_batch_id").alias("batches"))
