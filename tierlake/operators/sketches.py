"""Stored sketches of distinct values by day and group, merged to any period without reading rows again.

Exact counts stay the default of the KPIs; these are for periods and groups nobody has counted yet.
Registers take maxima, so a delivery that is added again changes none of them (only the formula by which
the very first merge of a sketch estimates may differ, within the stated error).
Sketches only grow: rows that are taken out of a table need its days to be built anew.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierlake.operators.rollups import MONTH_FOLDER, month_folder
from tierlake.sources.store import LayerStore

SKETCH, ESTIMATE = "_sketch", "estimate"
#: log2 of the registers of a sketch: a few kilobytes each.
LG_K = 12


def standard_error(lg_k: int = LG_K) -> float:
    """Relative standard error of merged sketches."""
    return 1.04 / 2 ** (lg_k / 2)


def sketched(rows: DataFrame, by: Iterable[str], value: str, month: Column, lg_k: int = LG_K) -> DataFrame:
    """A sketch of the distinct values of each group; NULL values count as none."""
    return rows.groupBy(*by, month_folder(month).alias(MONTH_FOLDER)).agg(F.hll_sketch_agg(value, lg_k).alias(SKETCH))


def rebuild_sketches(
    rows: DataFrame, store: LayerStore, name: str, by: Sequence[str], value: str, month: Column, lg_k: int = LG_K
) -> None:
    store.overwrite(sketched(rows, by, value, month, lg_k), "gold", name, [MONTH_FOLDER])


def add_to_sketches(
    rows: DataFrame, store: LayerStore, name: str, by: Sequence[str], value: str, month: Column, lg_k: int = LG_K
) -> list[str]:
    """Merge new rows into the stored sketches; only the months they touch are written."""
    store.redo("gold", name, [MONTH_FOLDER])
    fresh = sketched(rows, by, value, month, lg_k)
    touched = sorted(r[0] for r in rows.select(month_folder(month)).distinct().collect())
    if touched:
        stored = store.read("gold", name).select(*fresh.columns).where(F.col(MONTH_FOLDER).isin(touched))
        both = stored.unionByName(fresh).groupBy(*by, MONTH_FOLDER).agg(F.hll_union_agg(SKETCH).alias(SKETCH))
        store.replace_logged(both.hint("rebalance", MONTH_FOLDER), "gold", name, [MONTH_FOLDER])
    return touched


def merged_distincts(sketches: DataFrame, by: Iterable[Column | str]) -> DataFrame:
    """Estimated distinct values by any coarser grouping of the stored one."""
    return sketches.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg(SKETCH)).alias(ESTIMATE))


def within_error(exact: Column, estimate: Column, errors: float = 4, lg_k: int = LG_K) -> Column:
    """Whether an estimate lies within so many standard errors of the exact number, or within one."""
    return F.abs(exact - estimate) <= F.greatest(F.lit(1.0), exact * errors * standard_error(lg_k))
