import pytest
from pyspark.sql import functions as F

from tierlake.sources import Staging, read_as_text, text_columns
from tierlake.sources.staging import staging_root


def types(df):
    return {t for _, t in df.dtypes}


@pytest.mark.parametrize("fmt", ["csv", "json", "parquet", "orc"])
@pytest.mark.parametrize("declared", [None, ("id", "name", "extra")])
def test_everything_is_text(spark, tmp_path, fmt, declared):
    path = str(tmp_path / fmt)
    df = spark.createDataFrame([(1, "x", 1.5), (2, None, None)], "id INT, name STRING, extra DOUBLE")
    writer = df.write.option("header", "true") if fmt == "csv" else df.write
    writer.format(fmt).save(path)
    read = read_as_text(spark, path, fmt, declared)
    assert types(read) == {"string"}
    assert sorted(r["id"] for r in read.collect()) == ["1", "2"]
    assert [r["name"] for r in read.where("id = '2'").collect()] == [None]


def test_columns_the_file_lacks_are_null(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.range(2).write.parquet(path)
    read = read_as_text(spark, path, "parquet", ("id", "later"))
    assert read.columns == ["id", "later"] and read.where("later IS NULL").count() == 2


def test_unknown_format(spark):
    with pytest.raises(ValueError):
        read_as_text(spark, "x", "xlsx")


def test_pruning_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.range(2).select("id", F.lit(1).alias("b")).write.parquet(path)
    plan = text_columns(spark.read.parquet(path)).select("id")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<id:bigint>" in plan


def test_partition_replacement(spark, store):
    part = lambda n: spark.range(n).withColumns({"_entity": F.lit("e"), "_batch_id": F.lit("1")})
    store.replace_partition(part(5), "silver", "rejects", {"_entity": "e", "_batch_id": "1"})
    store.replace_partition(part(3), "silver", "rejects", {"_entity": "e", "_batch_id": "2"})
    store.replace_partition(part(0), "silver", "rejects", {"_entity": "e", "_batch_id": "1"})
    assert store.read("silver", "rejects").groupBy("_batch_id").count().collect() == [(2, 3)]
    with pytest.raises(ValueError):
        store.replace_partition(part(1), "silver", "rejects", {"_entity": "../x"})


def test_overwrite_replaces_the_schema(spark, store):
    store.overwrite(spark.range(3), "gold", "t")
    store.overwrite(spark.range(2).select(F.col("id").cast("string").alias("name")), "gold", "t")
    assert store.read("gold", "t").columns == ["name"] and store.exists("gold", "t")
    assert not store.exists("gold", "missing")
    with pytest.raises(ValueError):
        store.path("platinum", "t")


def test_clustered_files_have_disjoint_ranges(spark, store):
    df = spark.range(20000).select((F.col("id") % 50).cast("int").alias("d"), F.col("id"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        store.clustered(df, "gold", "t", ["d"], "id")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spans = [
        (r.lo, r.hi)
        for r in store.read("gold", "t").groupBy(F.input_file_name()).agg(F.min("d").alias("lo"), F.max("d").alias("hi")).collect()
    ]
    spans.sort()
    assert len(spans) > 1 and all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))


def test_staging_uses_the_shared_folder_and_cleans_up(spark):
    with Staging(spark) as staging:
        kept = staging.keep(spark.range(5), "x")
        assert kept.count() == 5 and staging.path.startswith(staging_root(spark))
        path = staging.path
    with pytest.raises(Exception):
        spark.read.parquet(path)
