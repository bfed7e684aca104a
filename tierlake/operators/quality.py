"""Severity-ranked quality checks. Each table is aggregated once for all of its checks."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierlake.functions import null_like

# Severities here, check ids below.
CRIT, WARN, INFO = "CRIT", "WARN", "INFO"


@dataclass(frozen=True)
class Check:
    """An aggregate over a table and the bounds it must stay within."""

    check_id: str
    severity: str
    metric: Column
    most: float | None = None
    least: float | None = None
    detail: str = ""


RESULTS = (
    "check_id STRING, severity STRING, table_name STRING, metric_value DOUBLE, "
    "threshold DOUBLE, passed BOOLEAN, detail STRING"
)


class QualityError(RuntimeError):
    pass


def run_checks(df: DataFrame, table: str, checks: Iterable[Check]) -> DataFrame:
    """One row per check, from a single aggregation of the table."""
    listed = list(checks)
    measured = df.agg(*[c.metric.cast("double").alias(f"m{i}") for i, c in enumerate(listed)])
    rows = []
    for i, check in enumerate(listed):
        value = F.col(f"m{i}")
        verdict = F.lit(True)
        if check.most is not None:
            verdict = verdict & (value <= check.most)
        if check.least is not None:
            verdict = verdict & (value >= check.least)
        bound = check.most if check.most is not None else check.least
        rows.append(
            F.struct(
                F.lit(check.check_id).alias("check_id"),
                F.lit(check.severity).alias("severity"),
                F.lit(table).alias("table_name"),
                value.alias("metric_value"),
                F.lit(bound).cast("double").alias("threshold"),
                # A metric without a value (an empty table's ratio, say) has not been violated.
                F.coalesce(verdict, F.lit(True)).alias("passed"),
                F.lit(check.detail).alias("detail"),
            )
        )
    return measured.select(F.explode(F.array(*rows)).alias("row")).select("row.*")


def known_result(
    spark: SparkSession, table: str, check_id: str, severity: str, value: float, passed: bool, detail: str
) -> DataFrame:
    """A check decided from metadata rather than from rows."""
    return spark.createDataFrame([(check_id, severity, table, float(value), 0.0, passed, detail)], RESULTS)


def all_results(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def evaluated(results: DataFrame) -> DataFrame:
    """Results computed once. They have one row per check, so they fit the driver."""
    return results.sparkSession.createDataFrame(results.select(*_names()).collect(), RESULTS)


def _names() -> list[str]:
    return [field.split()[0] for field in RESULTS.split(", ")]


def by_severity(results: DataFrame) -> DataFrame:
    """Per severity: checks, how many of them failed, and which."""
    failed = F.when(~F.col("passed"), F.col("check_id"))
    return results.groupBy("severity").agg(
        F.count(F.lit(1)).alias("checks"),
        F.count(failed).alias("failed"),
        F.array_sort(F.collect_list(failed)).alias("failed_checks"),
    )


def require(results: DataFrame, severities: Iterable[str] = (CRIT,)) -> None:
    """Raise if a check of one of these severities failed."""
    broken = by_severity(results).where(F.col("severity").isin(*severities) & (F.col("failed") > 0))
    named = [f"{row.severity}: {', '.join(row.failed_checks)}" for row in broken.orderBy("severity").collect()]
    if named:
        raise QualityError("; ".join(named))


# --- check definitions -------------------------------------------------------------------------


def _count(condition: Column) -> Column:
    return F.count_if(F.coalesce(condition, F.lit(False)))


def _share(condition: Column) -> Column:
    return _count(condition) / F.nullif(F.count(F.lit(1)), F.lit(0))


def missing_key_check(table: str, pk: str) -> Check:
    return Check(f"Q-B03-{table}", CRIT, _count(null_like(pk)), most=0, detail="rows without a key")


def lineage_check(table: str) -> Check:
    missing = (
        F.col("_batch_id").isNull() | F.col("_source_file").isNull() | F.col("_ingested_at").isNull()
    )
    return Check(f"Q-B02-{table}", CRIT, _count(missing), most=0, detail="rows without lineage")


def band_check(table: str, low: int, high: int) -> Check:
    return Check(f"Q-COUNT-{table}", CRIT, F.count(F.lit(1)), most=high, least=low, detail="row count in band")


def duplicate_check(table: str, pk: str) -> Check:
    return Check(f"Q-S01-{table}", CRIT, F.count(pk) - F.count_distinct(pk), most=0, detail="repeated keys")


def cursor_order_check(table: str, created: str, updated: str) -> Check:
    return Check(
        f"Q-O02-{table}", WARN, _count(F.col(updated) < F.col(created)), most=0, detail="updated before created"
    )


def balance_check(gross: str, discount: str, net: str) -> Check:
    off = F.round(F.col(gross) - F.col(discount), 2) != F.round(F.col(net), 2)
    return Check("Q-S08", CRIT, _count(off), most=0, detail="gross - discount differs from net")


def non_negative_check(*amounts: str) -> Check:
    below = reduce(lambda a, b: a | b, [F.col(c) < 0 for c in amounts])
    return Check("Q-S09", CRIT, _count(below), most=0, detail="negative amounts")


def domain_check(check_id: str, column: str, domain: Iterable[str]) -> Check:
    outside = F.col(column).isNotNull() & ~F.col(column).isin(*domain)
    return Check(check_id, WARN, _count(outside), most=0, detail=f"{column} outside its domain")


def flag_check(check_id: str, flag: str, detail: str) -> Check:
    return Check(check_id, WARN, _count(F.col(flag)), most=0, detail=detail)


def completeness_check(check_id: str, present: Column, least: float, detail: str) -> Check:
    return Check(check_id, INFO, _share(present), least=least, detail=detail)


def null_check(check_id: str, column: str, detail: str) -> Check:
    return Check(check_id, CRIT, _count(F.col(column).isNull()), most=0, detail=detail)


def empty_check(check_id: str, severity: str, detail: str) -> Check:
    """For frames that list violations: there must be none."""
    return Check(check_id, severity, F.count(F.lit(1)), most=0, detail=detail)


def total_check(check_id: str, severity: str, detail: str) -> Check:
    """For frames that list violations with a ``rows`` count each."""
    return Check(check_id, severity, F.coalesce(F.sum("rows"), F.lit(0)), most=0, detail=detail)


def forbidden_columns(df: DataFrame, table: str, check_id: str, names: Iterable[str]) -> DataFrame:
    found = sorted(set(names) & set(df.columns))
    return known_result(
        df.sparkSession, table, check_id, CRIT, len(found), not found, "direct identifiers in the schema"
    )


def same_total(
    left: DataFrame, right: DataFrame, table: str, check_id: str, amount: str | None, tolerance: float
) -> DataFrame:
    """Row counts (or sums of an amount) of two tables agree within the tolerance."""
    value = F.lit(1).cast("decimal(18,2)") if amount is None else F.col(amount)
    signed = left.select(value.alias("v")).unionAll(right.select((-value).alias("v")))
    gap = F.abs(F.coalesce(F.sum("v"), F.lit(0)))
    check = Check(check_id, CRIT, gap, most=tolerance, detail="difference between layers")
    return run_checks(signed, table, [check])


def kept_share(kept: DataFrame, source: DataFrame, table: str, least: float) -> DataFrame:
    """Kept rows as a share of source rows."""
    sides = kept.select(F.lit(1).alias("k"), F.lit(0).alias("s")).unionAll(
        source.select(F.lit(0), F.lit(1))
    )
    share = F.sum("k") / F.nullif(F.sum("s"), F.lit(0))
    check = Check(f"Q-SLA-{table}", WARN, share, least=least, detail="cleaned rows over loaded keys")
    return run_checks(sides, table, [check])


# --- reconciliation by content -----------------------------------------------------------------


def row_digests(columns: Iterable[str]) -> tuple[Column, Column]:
    """Two 64-bit hashes of a row's values, the first to be summed, the second to be xor-ed. Which
    values are NULL is hashed too, so values that change places differ."""
    names = list(columns)
    values = [*[F.col(c) for c in names], *[F.col(c).isNull() for c in names]]
    return F.xxhash64(F.lit(1), *values).cast("decimal(38,0)"), F.xxhash64(F.lit(2), *values)


def table_digest(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """One row that tells whether two tables hold the same rows, repeats included, in any order."""
    to_sum, to_xor = row_digests(columns)
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(to_sum), F.lit(0)).cast("string").alias("total"),
        F.coalesce(F.bit_xor(to_xor), F.lit(0)).alias("mixed"),
    )


def differing_groups(
    left: DataFrame, right: DataFrame, key: str, columns: Iterable[str], digits: int = 2
) -> DataFrame:
    """Groups of keys whose rows are not the same on both sides, with the rows of either.

    Keys are grouped by the first ``digits`` hex digits of their MD5 (NULL keys are a group of
    their own). Both tables are reduced to one digest a group before anything is shuffled, and no
    row is joined. Columns of the right side are taken in the left side's types.
    """
    names = list(dict.fromkeys([key, *columns]))
    both = None
    for frame, sign in ((left, 1), (right, -1)):
        typed = frame.select(*[F.col(c).cast(left.schema[c].dataType).alias(c) for c in names])
        to_sum, to_xor = row_digests(names)
        group = F.substring(F.md5(F.col(key).cast("string")), 1, digits)
        part = typed.select(
            group.alias("key_group"), (to_sum * sign).alias("_sum"), to_xor.alias("_xor"), F.lit(sign).alias("_side")
        )
        both = part if both is None else both.unionAll(part)
    grouped = both.groupBy("key_group").agg(
        F.sum("_sum").alias("_sum"),
        F.bit_xor("_xor").alias("_xor"),
        F.count_if(F.col("_side") == 1).alias("left_rows"),
        F.count_if(F.col("_side") == -1).alias("right_rows"),
    )
    same = (F.col("_sum") == 0) & (F.col("_xor") == 0) & (F.col("left_rows") == F.col("right_rows"))
    return grouped.where(~same).select("key_group", "left_rows", "right_rows")
