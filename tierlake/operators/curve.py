"""Positions on a space-filling curve, so that a table can be clustered on several columns at once."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a column's rank. Two columns of 10 bits tell a million cells apart.
RANK_BITS = 10


def rank_bounds(df: DataFrame, columns: Iterable[str], bits: int = RANK_BITS) -> dict[str, list]:
    """The values that cut each numeric column into ``2 ** bits`` about equally full ranges.

    One aggregation with sketches of bounded size; ``2 ** bits - 1`` values a column reach the
    driver, whatever the table's size. A value that fills several ranges is listed once for each.
    A column without a value has no bounds. Bounds only place rows, they never decide results.
    """
    names = list(columns)
    steps = 2**bits
    cuts = [i / steps for i in range(1, steps)]
    found = df.agg(*[F.percentile_approx(c, cuts, 10 * steps).alias(c) for c in names]).first()
    return {c: list(found[c] or []) for c in names}


def rank(column: str, bounds: Sequence, bits: int = RANK_BITS) -> Column:
    """How many bounds lie below the value, by halving: ``bits`` comparisons a row. NULL ranks 0."""
    if not bounds:
        return F.lit(0)
    values, steps = F.lit(list(bounds)), F.lit([2**b for b in reversed(range(bits))])

    def halve(position: Column, step: Column) -> Column:
        below = F.get(values, position + step - 1) < F.col(column)
        return position + F.when(below, step).otherwise(F.lit(0))

    return F.aggregate(steps, F.lit(0), halve)


def interleaved(ranks: Sequence[str], bits: int = RANK_BITS) -> Column:
    """The Z-order position: the bits of all rank columns in turn, highest first.

    Rows close to each other in every column mostly get positions close to each other, so any
    range of positions spans a small box of the columns' values.
    """
    if len(ranks) * bits > 62:
        raise ValueError(f"{len(ranks)} ranks of {bits} bits do not fit a long")
    position = F.lit(0).cast("long")
    for bit in range(bits):
        for place, name in enumerate(reversed(ranks)):
            taken = F.shiftright(name, bit).bitwiseAND(F.lit(1)).cast("long")
            position = position.bitwiseOR(F.shiftleft(taken, bit * len(ranks) + place))
    return position


def with_position(df: DataFrame, columns: Sequence[str], name: str, bits: int = RANK_BITS) -> DataFrame:
    """The frame with its rows' positions on the curve through ``columns``."""
    bounds = rank_bounds(df, columns, bits)
    ranks = [f"_rank_{i}" for i in range(len(columns))]
    ranked = df.select("*", *[rank(c, bounds[c], bits).alias(r) for c, r in zip(columns, ranks)])
    return ranked.select(*df.columns, interleaved(ranks, bits).alias(name))
