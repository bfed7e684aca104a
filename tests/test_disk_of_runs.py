"""What runs leave on local disks and write, and what they must not do twice."""

import os

import pytest
from pyspark.sql import functions as F

from tierlake.operators.entity import attach_parents
from tierlake.plans import feed, jobs, queries
from tierlake.plans.chain import Chain
from tierlake.plans.entities import BY_NAME
from tierlake.session import pin_session
from tierlake.sources.staging import Relay, Staging


def shuffle_files(spark):
    root = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for top in root for _, _, files in os.walk(top) for f in files if f.startswith("shuffle_")}


def test_shuffle_files_go_when_a_write_ends(spark, staging):
    before = shuffle_files(spark)
    staging.keep(spark.range(1000).repartition(4, "id").groupBy(F.col("id") % 7).count().toDF("k", "n"), "sums")
    assert shuffle_files(spark) <= before


def test_a_frame_can_be_read_again_after_its_shuffle_files_went(spark):
    sums = spark.range(1000).repartition(4, "id").groupBy((F.col("id") % 7).alias("k")).count()
    assert sums.collect() == sums.collect()
    assert sums.join(sums.withColumnRenamed("count", "n"), "k").count() == 7


@pytest.fixture
def rows(spark, tmp_path):
    """A chain over raw rows of its own, one key missing and one in two versions."""
    made = Chain(spark, str(tmp_path))
    text = "id_paciente STRING, actualizado_en STRING"
    raw = spark.createDataFrame([(" p1", "2026-01-01 00:00:00"), ("p1", None), ("p2", None), ("nan", None)], text)
    made.raw = lambda entity: raw.select(
        *[F.col("id_paciente").alias(k) for k in ("id_cita", "id_evento", "id_factura")], "id_paciente", "actualizado_en"
    )
    return made


def test_loaded_rows_are_written_without_a_shuffle(rows, monkeypatch):
    plans, keep = [], rows.staging.keep
    monkeypatch.setattr(rows.staging, "keep", lambda df, name: (plans.append(df._jdf.queryExecution().toString()), keep(df, name))[1])
    loaded = rows.loaded("pacientes")
    assert loaded.count() == 4 and loaded.where("_row_hash IS NULL").count() == 0
    assert len(plans) == 1 and "Exchange" not in plans[0] and "Rebalance" not in plans[0]


def test_scanned_bronze_and_facts_read_once_are_not_staged(rows):
    assert rows.bronze("citas").count() == 3 and rows.bronze("pacientes").count() == 3
    assert rows._kept == {}
    rows._built_fact = lambda entity: rows.bronze("citas").select("id_cita")
    assert rows.fact_for_once("citas").count() == 3 and rows._kept == {}
    assert rows.fact("citas").count() == 3 and rows.fact_for_once("citas") is rows._kept["fact-citas"]


def test_whole_tables_go_to_their_buckets_without_a_shuffle(spark, store, run, monkeypatch):
    spec = BY_NAME["pacientes"]
    text = ", ".join(f"{c} STRING" for c in spec.columns)
    row = dict.fromkeys(spec.columns, "1995-01-01 00:00:00")
    raw = spark.createDataFrame([{**row, spec.pk: key} for key in ("p1", " p1", "p2", "nan", None)], text)
    plans, overwrite = {}, store.overwrite

    def seen(df, layer, name, partition_by=(), placed=False):
        spread = df if placed else store._spread(df, list(partition_by))
        plans[layer] = spread._jdf.queryExecution().toString()
        overwrite(df, layer, name, partition_by, placed)

    monkeypatch.setattr(store, "overwrite", seen)
    settings = jobs.Settings(store, 4)
    loaded = jobs.load_bronze(settings, spec, raw, run, jobs.FULL, "pacientes")
    assert (loaded.rows_bronze, loaded.rows_quarantined) == (3, 2)
    with Staging(spark) as kept:
        cleaned = jobs.clean_silver(settings, spec, run, jobs.FULL, {}, kept)
    assert (cleaned.rows_silver + cleaned.rows_rejected, cleaned.rows_superseded) == (2, 1)
    for layer in ("bronze", "silver"):
        assert "Rebalance" not in plans[layer] and "Exchange" not in plans[layer]


def test_bands_count_keys_without_loading_the_source(rows):
    assert queries._bands(rows) == {e.name: (1, 2) for e in queries.ENTITIES}
    assert rows._kept == {}


def test_staged_rows_are_read_in_splits_that_can_be_sorted_in_memory(spark, staging):
    key = "spark.sql.files.maxPartitionBytes"
    assert spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes() <= 32 << 20
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "1m")
        assert pin_session(spark).conf.get(key) == "1m"  # a smaller limit stays
        kept = staging.keep(spark.range(1_500_000).select(F.sha2(F.col("id").cast("string"), 256).alias("h")).coalesce(1), "hashes")
        spark.conf.set(key, str(16 << 20))
        assert len(kept.inputFiles()) == 1
        sizes = kept.groupBy(F.spark_partition_id()).count().collect()
        assert len(sizes) > 1 and max(r["count"] for r in sizes) < 1_000_000
    finally:
        spark.conf.set(key, before)


def folders(staging):
    return sorted(os.listdir(staging.path)) if os.path.isdir(staging.path) else []


def test_loaded_rows_are_on_disk_only_while_tagged_ones_are_made(spark, rows, monkeypatch):
    spec = BY_NAME["eventos_clinicos"]
    raw = spark.createDataFrame([dict.fromkeys(spec.columns, k) for k in ("e1", "e2", "nan")], ", ".join(f"{c} STRING" for c in spec.columns))
    rows.raw = lambda entity: raw.select(*[F.col(c) if c in raw.columns else F.lit("x").alias(c) for c in BY_NAME[entity].columns])
    tagged = rows.tagged(spec.name)
    assert "loaded-eventos_clinicos" not in rows._kept
    assert not [f for f in folders(rows.staging) if f.startswith("loaded")]
    assert tagged.count() == 2 and tagged is rows.tagged(spec.name)
    loaded = rows.loaded(spec.name)  # rows somebody asked for stay
    del rows._kept[f"tagged-{spec.name}"]
    assert rows.tagged(spec.name).count() == 2 and loaded.count() == 3


def test_rows_are_staged_between_joins_that_shuffle_them(spark):
    """One join's shuffle files are gone before the next one writes its own; nothing stays behind."""
    spec = BY_NAME["eventos_clinicos"]
    text = "id_evento STRING, id_cita STRING, id_paciente STRING"
    events = spark.createDataFrame([("e1", "c1", "p1"), ("e2", "c9", "p2"), ("e3", None, "p1"), ("e3", "c1", None)], text)
    parents = {
        "citas": spark.sql("SELECT * FROM VALUES ('c1', 'p1'), ('c2', 'p2') AS v(id_cita, id_paciente)"),
        "pacientes": spark.sql("SELECT * FROM VALUES ('p1'), ('p2') AS v(id_paciente)"),
    }
    key, markers = "spark.sql.autoBroadcastJoinThreshold", [ref.marker for ref in spec.parents]
    plain = sorted(map(str, attach_parents(spec, events, parents, unique_parents=True).select(*events.columns, *markers).collect()))
    before = spark.conf.get(key)
    try:
        with Relay(spark) as relay:
            attach_parents(spec, events, parents, unique_parents=True, relay=relay)
            assert relay._last is None  # small parents are broadcast: nothing is staged
            spark.conf.set(key, "-1")
            found = attach_parents(spec, events, parents, unique_parents=True, relay=relay)
            plan = found._jdf.queryExecution().optimizedPlan().toString()
            assert plan.count("Join LeftOuter") == 1
            assert sorted(map(str, found.select(*events.columns, *markers).collect())) == plain
            path = relay._last.path
        assert not os.path.exists(path)
    finally:
        spark.conf.set(key, before)


def test_tables_of_few_row_groups_are_dealt(spark, tmp_path, monkeypatch):
    """One task read all rows of a table that one row group holds; its rows are the same when dealt."""
    rows = spark.range(2000).selectExpr("id AS k", "CASE WHEN id % 7 = 0 THEN NULL ELSE 'v' END AS v")
    rows.coalesce(1).write.parquet(str(tmp_path / "lineitem.parquet"))
    plain = feed._table(spark, str(tmp_path), "lineitem")
    assert "Repartition" not in plain._jdf.queryExecution().optimizedPlan().toString()
    monkeypatch.setattr(feed, "DEALT_FROM_BYTES", 1)
    dealt = feed._table(spark, str(tmp_path), "lineitem")
    assert dealt.select(F.spark_partition_id()).distinct().count() > 1
    assert dealt.exceptAll(plain).isEmpty() and dealt.count() == plain.count()
