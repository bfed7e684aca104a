"""Layered tables as Parquet folders: ``<root>/<layer>/<name>``."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tierlake.operators.curve import RANK_BITS, with_position

LAYERS = ("raw", "bronze", "silver", "gold", "ops")

_PLAIN_VALUE = re.compile(r"^[A-Za-z0-9_.-]+$")


class LayerStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, layer: str, name: str) -> str:
        if layer not in LAYERS:
            raise ValueError(f"unknown layer: {layer}")
        return f"{self.root}/{layer}/{name}"

    def read(self, layer: str, name: str, schema: T.StructType | None = None) -> DataFrame:
        """Scan a table. With a schema there is no footer inference, and columns that older
        files lack come back as NULL (schema evolution without merging footers)."""
        reader = self.spark.read
        if schema is not None:
            reader = reader.schema(schema)
        return reader.parquet(self.path(layer, name))

    def exists(self, layer: str, name: str) -> bool:
        """Whether the table's folder is there; one look-up, however many files it has."""
        return self._has(self.path(layer, name))

    def _folder(self, path: str):
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return folder.getFileSystem(self.spark._jsc.hadoopConfiguration()), folder

    def _has(self, path: str) -> bool:
        files, folder = self._folder(path)
        return files.exists(folder)

    def overwrite(
        self,
        df: DataFrame,
        layer: str,
        name: str,
        partition_by: Iterable[str] = (),
        placed: bool = False,
    ) -> None:
        """Replace the whole table and its schema. ``placed`` rows are already shuffled to suit
        the partition folders. A swap of the former table that was left open must not be repeated
        over the new one, so its rows go first."""
        keys = list(partition_by)
        self.drop(layer, f"{name}__pending")
        writer = (df if placed else self._spread(df, keys)).write.mode("overwrite")
        writer = writer.option("partitionOverwriteMode", "static")
        (writer.partitionBy(*keys) if keys else writer).parquet(self.path(layer, name))

    def drop(self, layer: str, name: str) -> None:
        files, folder = self._folder(self.path(layer, name))
        files.delete(folder, True)

    def complete(self, layer: str, name: str) -> bool:
        """Whether the last write of the whole table ended."""
        return self._has(f"{self.path(layer, name)}/_SUCCESS")

    def append(self, df: DataFrame, layer: str, name: str) -> None:
        df.write.mode("append").parquet(self.path(layer, name))

    def replace_partitions(
        self, df: DataFrame, layer: str, name: str, partition_by: Iterable[str]
    ) -> None:
        """Replace only the partitions present in the frame; the others stay.

        Spark writes the new files aside and swaps them in when the job commits, so the frame may
        be computed from the very table it replaces.
        """
        keys = list(partition_by)
        (
            self._spread(df, keys)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*keys)
            .parquet(self.path(layer, name))
        )

    def replace_logged(self, df: DataFrame, layer: str, name: str, partition_by: Iterable[str]) -> None:
        """Replace the partitions present in the frame so that a lost driver loses no row.

        The rows are written aside in full first. Only then are the partitions swapped, folder by
        folder; ``redo`` goes on with a swap that was interrupted. The frame keeps its own layout.
        """
        self.redo(layer, name, partition_by)
        self.overwrite(df, layer, f"{name}__pending", partition_by, placed=True)
        self.redo(layer, name, partition_by)

    def redo(self, layer: str, name: str, partition_by: Iterable[str]) -> None:
        """Finish a replacement whose rows were written aside completely: folders not yet moved are still
        there, and each takes the place of its former one. No row is written a second time."""
        pending = f"{name}__pending"
        if self.complete(layer, pending):
            target = self.path(layer, name)
            files, aside = self._folder(self.path(layer, pending))
            for steps in self._partition_folders(files, aside, len(list(partition_by))):
                _, place = self._folder(f"{target}/{steps}")
                files.delete(place, True)
                files.mkdirs(place.getParent())
                if not files.rename(self._folder(f"{aside}/{steps}")[1], place):
                    raise OSError(f"could not move {steps} of {layer}.{pending} into its place")
            self.spark.catalog.refreshByPath(target)
        self.drop(layer, pending)

    @classmethod
    def _partition_folders(cls, files, folder, depth: int, above: str = "") -> list[str]:
        """Paths of partition folders ``depth`` steps below a folder; at most one per partition."""
        if depth == 0:
            return [above.rstrip("/")]
        inner = [s.getPath() for s in files.listStatus(folder) if s.isDirectory() and "=" in s.getPath().getName()]
        return [steps for p in inner for steps in cls._partition_folders(files, p, depth - 1, f"{above}{p.getName()}/")]

    def replace_partition(
        self, df: DataFrame, layer: str, name: str, values: Mapping[str, str], compact: bool = False
    ) -> None:
        """Replace exactly one partition, also when the frame is empty: writing a batch again
        leaves that batch's rows only, however few there are now.

        ``compact`` is for the few rows that a filter leaves of a big frame: they are gathered
        into files of a sensible size instead of one tiny file per task.
        """
        for value in values.values():
            if not _PLAIN_VALUE.match(value):
                raise ValueError(f"not usable as a partition folder: {value!r}")
        folder = "/".join(f"{column}={value}" for column, value in values.items())
        (
            (df.hint("rebalance") if compact else df)
            .drop(*values)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "static")
            .parquet(f"{self.path(layer, name)}/{folder}")
        )

    def folders(self, layer: str, name: str, column: str) -> list[str]:
        """Values of the first partition column, from folder names."""
        files, folder = self._folder(self.path(layer, name))
        prefix = f"{column}="
        names = [status.getPath().getName() for status in files.listStatus(folder)]
        return sorted(n.removeprefix(prefix) for n in names if n.startswith(prefix))

    def subfolders(self, layer: str, name: str) -> list[str]:
        files, folder = self._folder(self.path(layer, name))
        return sorted(status.getPath().getName() for status in files.listStatus(folder) if status.isDirectory())

    def size(self, layer: str, name: str) -> int:
        """Bytes of a table's files."""
        files, folder = self._folder(self.path(layer, name))
        return files.getContentSummary(folder).getLength()

    def drop_partition(self, layer: str, name: str, values: Mapping[str, str]) -> None:
        steps = "/".join(f"{column}={value}" for column, value in values.items())
        files, folder = self._folder(f"{self.path(layer, name)}/{steps}")
        files.delete(folder, True)

    def clustered(self, df: DataFrame, layer: str, name: str, by: Iterable[str], unique: str) -> None:
        """Replace a table, range-clustered on columns so that Parquet min/max ranges skip files.

        The unique column ends the ordering: a heavily repeated value of ``by`` is then spread
        over several ranges instead of landing in one task.
        """
        order = [*by, unique]
        self.drop(layer, f"{name}__pending")
        (
            df.repartitionByRange(*order)
            .sortWithinPartitions(*order)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "static")
            .parquet(self.path(layer, name))
        )

    def clustered_on_curve(
        self, df: DataFrame, layer: str, name: str, by: Sequence[str], unique: str, bits: int = RANK_BITS
    ) -> None:
        """Replace a table, clustered on all of the numeric columns ``by`` alike.

        Rows are range-partitioned by their position on a space-filling curve, so a filter on any
        one of the columns skips most files (with two columns all but about the square root of
        them), where a linear order helps its first column only. The unique column ends the
        ordering: rows of one crowded position are spread over several ranges. The frame is
        evaluated more than once, so it should be a stored or staged one.
        """
        self.drop(layer, f"{name}__pending")
        order = ["_position", *by, unique]
        (
            with_position(df, by, "_position", bits)
            .repartitionByRange(*order)
            .sortWithinPartitions(*order)
            .drop("_position")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "static")
            .parquet(self.path(layer, name))
        )

    def publish(self, tables: Mapping[str, Mapping[str, tuple[T.StructType, Iterable[str]]]]) -> None:
        """Register stored tables as ``layer.name`` in the catalog, over the same files.

        Each name comes with its declared schema and partition columns, so that tables without
        rows, and files that lack each other's columns, are read as one table.
        """
        for layer, named in tables.items():
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")
            for name, (schema, partition_by) in named.items():
                if not self.exists(layer, name):
                    continue
                columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
                keys = ", ".join(f"`{c}`" for c in partition_by)
                self.spark.sql(f"DROP TABLE IF EXISTS {layer}.{name}")
                self.spark.sql(
                    f"CREATE TABLE {layer}.{name} ({columns}) USING parquet "
                    + (f"PARTITIONED BY ({keys}) " if keys else "")
                    + f"LOCATION '{self.path(layer, name)}'"
                )
                if keys:
                    self.spark.sql(f"MSCK REPAIR TABLE {layer}.{name}")

    @staticmethod
    def _spread(df: DataFrame, keys: list[str]) -> DataFrame:
        """One shuffle that lines rows up with output folders; adaptive execution splits folders
        that got too large and merges small ones."""
        return df.hint("rebalance", *keys) if keys else df
