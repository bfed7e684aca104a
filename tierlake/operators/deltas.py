"""Keyed tables of one base and small deltas: an upsert writes what arrived, reads merge, compaction folds.

A table is a folder of parts, each a Parquet folder named after the range of upserts it holds. A part
counts once its write has ended, and no longer counts when another whole part covers its range. So a
write that was interrupted is as if it had not begun, and a fold that was interrupted, at whatever step,
leaves the same rows. Folded parts stay until the next fold: readers that began before it can end.
One writer at a time, as for the other tables.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierlake.operators.dedupe import latest_per_key
from tierlake.operators.upsert import FEW_KEYS
from tierlake.sources.staging import Staging
from tierlake.sources.store import LayerStore

PART, GONE = "_part", "_gone"
_RANGE = re.compile(r"^part-(\d{9})-(\d{9})$")


@dataclass(frozen=True, order=True)
class Part:
    """Upserts number ``first`` to ``last``; the base begins with number 0."""

    first: int
    last: int

    @property
    def folder(self) -> str:
        return f"part-{self.first:09d}-{self.last:09d}"

    def covers(self, other: Part) -> bool:
        return self != other and self.first <= other.first and other.last <= self.last


class DeltaTable:
    """``newest`` orders the versions of a key, wherever they come from; without it the last upsert
    wins. Rows without a key are left out."""

    def __init__(self, store: LayerStore, layer: str, name: str, pk: str, newest: Iterable[Column] = ()):
        self.store, self.layer, self.name, self.pk = store, layer, name, pk
        self.newest = list(newest)

    def upsert(self, rows: DataFrame) -> None:
        """Write the best version of each key beside what is there; nothing stored is read."""
        if GONE in rows.columns or PART in rows.columns:
            raise ValueError(f"{GONE} and {PART} are names of the table's own columns")
        order = self.newest or [F.hash(*rows.columns)]
        best = latest_per_key(rows.where(F.col(self.pk).isNotNull()), self.pk, order, keep_missing_keys=False)
        self._append(best.withColumn(GONE, F.lit(False)))

    def delete(self, keys: DataFrame) -> None:
        """Take the keys out; what is upserted later counts again."""
        if self.newest:
            raise ValueError("a table ordered by its own columns has no moment at which a key goes")
        known = self.read()
        gone = keys.select(self.pk).distinct().where(F.col(self.pk).isNotNull())
        others = [F.lit(None).cast(f.dataType).alias(f.name) for f in known.schema if f.name != self.pk]
        self._append(gone.select(self.pk, *others, F.lit(True).alias(GONE)))

    def read(self) -> DataFrame:
        """One row per key. Base rows whose key no delta holds pass by unshuffled when the deltas have few
        rows and Spark broadcasts their keys; otherwise all rows meet in one shuffle by key."""
        live = self.live()
        if not live:
            raise ValueError(f"{self.layer}.{self.name} has no rows yet")
        return self._merged(live).where(f"NOT {GONE}").drop(GONE)

    def parts(self) -> list[Part]:
        """All parts whose write has ended, oldest first."""
        if not self.store.exists(self.layer, self.name):
            return []
        found = [_RANGE.match(n) for n in self.store.subfolders(self.layer, self.name)]
        parts = [Part(int(m[1]), int(m[2])) for m in found if m]
        return sorted(p for p in parts if self.store.complete(self.layer, self._at(p)))

    def live(self) -> list[Part]:
        """The parts that no other covers: a gapless row of ranges, oldest first."""
        parts = self.parts()
        return [p for p in parts if not any(o.covers(p) for o in parts)]

    def compact(self, ratio: float = 2.0) -> Part | None:
        """Fold the newest parts, taking in an older one as long as it is at most ``ratio`` times what
        follows it. So parts grow by size, their number with the logarithm of the table's size, and a
        row is written again that many times. Parts of earlier folds are deleted first."""
        live = self.live()
        for part in set(self.parts()) - set(live):
            self.store.drop(self.layer, self._at(part))
        taken, size = live[-1:], self._bytes(live[-1]) if live else 0
        for part in reversed(live[:-1]):
            own = self._bytes(part)
            if own > ratio * size:
                break
            taken, size = [part, *taken], size + own
        if len(taken) < 2:
            return None
        whole = Part(taken[0].first, taken[-1].last)
        rows = self._merged(taken)
        # With nothing older left, keys that are gone need not be remembered.
        self._write(rows.where(f"NOT {GONE}") if whole.first == 0 else rows, whole)
        return whole

    def _append(self, rows: DataFrame) -> None:
        last = max((p.last for p in self.parts()), default=-1)
        with Staging(self.store.spark) as staging:
            # Staged, as finding the ranges of keys evaluates the rows a second time.
            self._write(staging.keep(rows, "delta"), Part(last + 1, last + 1))

    def _write(self, rows: DataFrame, part: Part) -> None:
        """Keys in ranges, so that looking up a key skips files of every part."""
        self.store.clustered(rows, self.layer, self._at(part), (), self.pk)

    def _merged(self, parts: Sequence[Part]) -> DataFrame:
        oldest = self._scan(parts[0])
        if len(parts) == 1:
            return oldest.drop(PART)
        union = self._scan(parts[1])
        for part in parts[2:]:
            union = union.unionByName(self._scan(part), allowMissingColumns=True)
        order = [*self.newest, F.col(PART).desc()]
        if union.count() > FEW_KEYS:
            both = oldest.unionByName(union, allowMissingColumns=True)
            return latest_per_key(both, self.pk, order, keep_missing_keys=False).drop(PART)
        touched = union.select(self.pk)
        rivals = union
        if self.newest:
            rivals = union.unionByName(oldest.join(touched, self.pk, "left_semi"), allowMissingColumns=True)
        best = latest_per_key(rivals, self.pk, order, keep_missing_keys=False)
        return oldest.join(touched, self.pk, "left_anti").unionByName(best, allowMissingColumns=True).drop(PART)

    def _scan(self, part: Part) -> DataFrame:
        return self.store.read(self.layer, self._at(part)).withColumn(PART, F.lit(part.last))

    def _at(self, part: Part) -> str:
        return f"{self.name}/{part.folder}"

    def _bytes(self, part: Part) -> int:
        return self.store.size(self.layer, self._at(part))
