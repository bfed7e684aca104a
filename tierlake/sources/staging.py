"""Intermediate results written once to the cluster's shared folder and read back.

A staged frame is a plain Parquet scan: it survives lost executors, cuts lineage, keeps column
pruning, and gives the planner real sizes to choose join strategies by.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Input splits hold whole row groups. Staged rows are small on disk and large in memory: with groups of
#: the usual size, tasks that sort what they scan would spill.
ROW_GROUP_BYTES = 16 << 20

_local_roots: dict[str, str] = {}


def staging_root(spark: SparkSession) -> str:
    """Shared folder from ``spark.checkpoint.dir``; a temporary one only for a local master."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="tierlake-")
    return _local_roots[app]


class Staging:
    """One run's folder of staged frames. As a context manager it deletes the folder at the end."""

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.path = f"{root or staging_root(spark)}/staged-{uuid.uuid4().hex}"

    def keep(self, df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
        """Write the frame, compressed as the session says or by ``codec``; return a scan of what was written."""
        target = f"{self.path}/{name}-{uuid.uuid4().hex[:8]}"
        writer = df.write.option("parquet.block.size", ROW_GROUP_BYTES)
        (writer.option("compression", codec) if codec else writer).parquet(target)
        return self.spark.read.schema(df.schema).parquet(target)

    def release(self) -> None:
        jvm = self.spark._jvm
        folder = jvm.org.apache.hadoop.fs.Path(self.path)
        folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)

    def __enter__(self) -> Staging:
        return self

    def __exit__(self, *_exc) -> None:
        self.release()


class Relay:
    """A frame on its way through steps that shuffle it: each step reads what the last one wrote, whose
    shuffle files are gone by then, and what was written before is deleted. As a context manager it
    deletes the last one, too, at the end."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._last: Staging | None = None

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        step = Staging(self.spark)
        kept = step.keep(df, name)
        self.release()
        self._last = step
        return kept

    def release(self) -> None:
        if self._last is not None:
            self._last.release()
            self._last = None

    def __enter__(self) -> Relay:
        return self

    def __exit__(self, *_exc) -> None:
        self.release()
