"""Merges of many keys: the same rows as merges of few, with fewer shuffles and writes."""

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierlake.operators import deltas, upsert
from tierlake.operators.deltas import DeltaTable
from tierlake.operators.upsert import overwrite_bucketed, replace_keys, upsert_table
from tierlake.plans import queries
from tierlake.plans.chain import Chain
from tierlake.sources.staging import Staging


def order():
    return [F.col("at").desc_nulls_last(), F.col("v").asc_nulls_last()]


def rows(spark, *values):
    return spark.createDataFrame(values, "k STRING, v STRING, at INT")


def held(df):
    return sorted((r.k, r.v, r["at"]) for r in df.select("k", "v", "at").collect())


@pytest.fixture(params=[0, 100_000])
def few(request, monkeypatch):
    monkeypatch.setattr(upsert, "FEW_KEYS", request.param, raising=False)
    monkeypatch.setattr(deltas, "FEW_KEYS", request.param, raising=False)


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_upserts_of_few_and_many_keys_agree(spark, store, few):
    old = rows(spark, ("a", "1", 5), ("b", "1", 5), ("c", None, None), ("d", "1", 5), ("e", "1", 5))
    upsert_table(old, store, "silver", "t", "k", 4, order())
    new = rows(spark, ("a", "2", 9), ("b", "2", 1), ("c", None, None), ("f", "1", 1), ("g", "2", 3), ("g", "1", 3))
    upsert_table(new, store, "silver", "t", "k", 4, order())
    expected = [("a", "2", 9), ("b", "1", 5), ("d", "1", 5), ("e", "1", 5), ("f", "1", 1), ("g", "1", 3)]
    assert [r for r in held(store.read("silver", "t").where("k <> 'c'"))] == expected
    assert held(store.read("silver", "t").where("k = 'c'")) == [("c", None, None)]
    before = set(store.read("silver", "t").inputFiles())
    upsert_table(new, store, "silver", "t", "k", 4, order())
    assert set(store.read("silver", "t").inputFiles()) == before


def test_replaced_keys_of_few_and_many_agree(spark, store, few):
    overwrite_bucketed(spark.range(100).selectExpr("CAST(id AS STRING) k", "'1' v", "1 at"), store, "silver", "t", "k", 4)
    keys = spark.range(10, 120).selectExpr("CAST(id AS STRING) k")
    replace_keys(keys.where("k <> '50'").selectExpr("k", "'2' v", "2 at"), keys, store, "silver", "t", "k", 4)
    found = {r[0]: r[1] for r in store.read("silver", "t").groupBy("v").count().collect()}
    assert found == {"1": 10, "2": 109} and store.read("silver", "t").where("k = '50'").count() == 0
    every = store.read("silver", "t").select("k")
    replace_keys(every.limit(0).selectExpr("k", "'3' v", "3 at"), Staging(spark).keep(every, "keys"), store, "silver", "t", "k", 4)
    assert store.folders("silver", "t", "_bucket") == []


def test_stored_and_many_new_rows_meet_in_one_shuffle(spark, store, monkeypatch, no_broadcast):
    monkeypatch.setattr(upsert, "FEW_KEYS", 0, raising=False)
    upsert_table(rows(spark, ("a", "1", 5), ("b", "1", 5)), store, "silver", "t", "k", 2, order())
    new = Staging(spark).keep(rows(spark, ("a", "2", 9), ("b", "2", 9)), "new")
    plans, keep = [], Staging.keep

    def spied(self, df, name, *args):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return keep(self, df, name, *args)

    monkeypatch.setattr(Staging, "keep", spied)
    upsert_table(new, store, "silver", "t", "k", 2, order())
    assert plans[0].count("Exchange hashpartitioning") == 1
    assert held(store.read("silver", "t")) == [("a", "2", 9), ("b", "2", 9)]


def test_a_swap_moves_files_and_goes_on_after_an_interruption(spark, store):
    overwrite_bucketed(rows(spark, ("a", "1", 1), ("b", "1", 1), ("c", "1", 1)), store, "silver", "t", "k", 8)
    new = rows(spark, ("a", "2", 2), ("b", "2", 2), ("c", "2", 2))
    overwrite_bucketed(new, store, "silver", "t__pending", "k", 8)
    written = {f.rsplit("/", 1)[1] for f in store.read("silver", "t__pending").inputFiles()}
    # As if the driver was lost between two folders: one is in its place already.
    moved = store.folders("silver", "t__pending", "_bucket")[0]
    store.drop("silver", f"t/_bucket={moved}")
    files, place = store._folder(store.path("silver", f"t/_bucket={moved}"))
    assert files.rename(store._folder(store.path("silver", f"t__pending/_bucket={moved}"))[1], place)
    store.redo("silver", "t", ["_bucket"])
    table = store.read("silver", "t")
    assert held(table) == [("a", "2", 2), ("b", "2", 2), ("c", "2", 2)] and not store.exists("silver", "t__pending")
    assert {f.rsplit("/", 1)[1] for f in table.inputFiles()} == written


def test_a_swap_of_nested_partitions_replaces_only_its_own(spark, store):
    table = lambda *values: spark.createDataFrame(values, "p STRING, q STRING, v INT")
    store.overwrite(table(("1", "a", 1), ("1", "b", 1), ("2", None, 1)), "gold", "t", ["p", "q"])
    store.replace_logged(table(("1", "b", 2), ("2", None, 2), ("3", "c", 2)), "gold", "t", ["p", "q"])
    found = {(str(r.p), r.q, r.v) for r in store.read("gold", "t").collect()}
    assert found == {("1", "a", 1), ("1", "b", 2), ("2", None, 2), ("3", "c", 2)}


def test_many_delta_rows_meet_the_base_once(spark, store, few, no_broadcast):
    for newest in (order(), []):
        table = DeltaTable(store, "silver", f"t{len(newest)}", "k", newest)
        table.upsert(rows(spark, ("a", "1", 5), ("b", "1", 5), ("c", "1", 5)))
        table.upsert(rows(spark, ("a", "2", 9), ("b", "2", 1), ("d", "1", 1)))
        kept = "1" if newest else "2"
        expected = [("a", "2"), ("b", kept), ("c", "1"), ("d", "1")]
        assert [r[:2] for r in held(table.read())] == expected
        if deltas.FEW_KEYS == 0:
            assert table.read()._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
        table.compact(ratio=float("inf"))
        assert [r[:2] for r in held(table.read())] == expected


def test_time_ranges_compute_no_column_that_is_not_profiled(spark, tmp_path, monkeypatch):
    made = Chain(spark, str(tmp_path))
    columns = ("fecha_nacimiento", "fecha_hora_cita", "fecha_hora_evento", "fecha_factura", "actualizado_en")
    made.raw = lambda entity: spark.createDataFrame([("2026-01-02",) * 5, (None,) * 5, ("2026-03-04",) * 5], columns_schema(columns))
    monkeypatch.setattr(queries, "chain", lambda spark, tables: made)
    found: DataFrame = queries.QUERIES["profile_time_ranges"](spark, "")
    assert {(r["first"][:10], r["last"][:10]) for r in found.collect()} == {("2026-01-02", "2026-03-04")}
    assert made._kept == {} and "sha2" not in found._jdf.queryExecution().optimizedPlan().toString()


def columns_schema(names):
    return ", ".join(f"{n} STRING" for n in names)
