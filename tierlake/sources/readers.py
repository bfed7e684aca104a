"""Reading untyped source files: every column arrives as nullable text."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def text_schema(columns: Iterable[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def text_columns(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Cast columns to text; contract columns the frame lacks come back as NULL."""
    names = list(columns) if columns is not None else df.columns
    return df.select(
        *[
            (F.col(c).cast("string") if c in df.columns else F.lit(None).cast("string")).alias(c)
            for c in names
        ]
    )


def read_as_text(
    spark: SparkSession,
    path: str | list[str],
    fmt: str = "csv",
    columns: Iterable[str] | None = None,
    **options: str,
) -> DataFrame:
    """Read CSV, JSON, Parquet or ORC files on the executors with every column as text.

    Giving ``columns`` avoids any inference pass, and tells JSON apart from schema drift. Typed
    formats are cast after the scan, so column pruning still reaches the files.
    """
    reader = spark.read.options(**options)
    names = list(columns) if columns is not None else None
    if fmt == "csv":
        reader = reader.option("header", options.get("header", "true"))
        if names is not None:
            # Match by header name rather than by position.
            reader = reader.option("enforceSchema", "false").schema(text_schema(names))
        return reader.csv(path)
    if fmt == "json":
        if names is not None:
            return reader.schema(text_schema(names)).json(path)
        return text_columns(reader.option("primitivesAsString", "true").json(path))
    if fmt in ("parquet", "orc"):
        return text_columns(reader.format(fmt).load(path), names)
    raise ValueError(f"unsupported source format: {fmt}")
