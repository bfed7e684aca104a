"""Sets of hashes in a bitmap of fixed size, which tasks look up without false negatives."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

#: A bitmap has 2^26 bits, whatever the data.
BITMAP_BITS = 26


class Bitmap:
    """Two bits per hash in a fixed number of bits; built on Spark, looked up in tasks."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    @staticmethod
    def of(hashes: DataFrame) -> Bitmap:
        """From a frame of one long column; at most 2^20 rows, whatever the frame, reach the driver."""
        high, low = Bitmap._places(F.col(hashes.columns[0]))
        at = hashes.select(F.explode(F.array(high, low)).alias("at"))
        bit = F.expr("shiftleft(1L, cast(at & 63 as int))")
        rows = at.groupBy(F.expr("cast(shiftright(at, 6) as int)").alias("slot")).agg(F.bit_or(bit).alias("word")).toPandas()
        bits = np.zeros(1 << (BITMAP_BITS - 6), dtype=np.uint64)
        bits[rows["slot"].to_numpy(np.int64)] = rows["word"].to_numpy(np.int64).view(np.uint64)
        return Bitmap(bits)

    @staticmethod
    def _places(h: Column) -> tuple[Column, Column]:
        top = 64 - BITMAP_BITS
        low = F.shiftrightunsigned(h, top - BITMAP_BITS).bitwiseAND(F.lit((1 << BITMAP_BITS) - 1))
        return F.shiftrightunsigned(h, top), low

    def holds(self, h: np.ndarray) -> np.ndarray:
        top = 64 - BITMAP_BITS
        high = h >> np.uint64(top)
        low = (h >> np.uint64(top - BITMAP_BITS)) & np.uint64((1 << BITMAP_BITS) - 1)
        six, rest = np.uint64(6), np.uint64(63)
        return ((self.bits[high >> six] >> (high & rest)) & (self.bits[low >> six] >> (low & rest)) & np.uint64(1)).astype(bool)
