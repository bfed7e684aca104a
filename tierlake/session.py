"""Session settings the operators rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# UTC keeps naive timestamps naive, ANSI keeps overflow loud, and the adaptive settings let Spark
# split skewed join and write partitions and coalesce small ones at run time. A join whose build side
# turns out small in every partition is hashed instead of sorted, so the wide side is not spilled.
# Shuffle files go when the write they served ends, not when the driver next collects garbage: a run
# of many writes would otherwise keep all of theirs. Row hashes are hex, which zstd halves. A task that
# writes to up to so many partition folders keeps their files open instead of sorting its rows by folder.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.maxConcurrentOutputFileWriters": "16",
}

# Rows of a few bytes on disk take hundreds in memory: with larger input splits the sorts of a scan's
# tasks spill. A session's smaller limit stays.
INPUT_SPLIT_BYTES = 32 << 20
_SPLITS = "spark.sql.files.maxPartitionBytes"


def pin_session(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings to a session somebody else built."""
    for key, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    if spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes() > INPUT_SPLIT_BYTES:
        spark.conf.set(_SPLITS, INPUT_SPLIT_BYTES)
    return spark


def local_session(cores: int | str = "*", app_name: str = "tierlake", **settings: str) -> SparkSession:
    """A small local session for tests and benchmarks; on a cluster use its own session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        # No Python stack capture per column expression.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in settings.items():
        builder = builder.config(key, value)
    return pin_session(builder.getOrCreate())
