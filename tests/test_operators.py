from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from clinic import MID, NEW, OLD
from tierlake.operators import profile
from tierlake.operators.dedupe import latest_per_key
from tierlake.operators.history import first_versions, next_versions
from tierlake.operators.skew import heavy_keys, lookup
from tierlake.operators.star import calendar, calendar_of, dim_lookup
from tierlake.operators.surrogate import dense_key, stable_key
from tierlake.operators.upsert import changed_rows, mark_missing, overwrite_bucketed, replace_keys, upsert_table
from tierlake.sources.store import LayerStore
from tierlake.operators.watermark import EPOCH, Watermarks, newer_than


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


# --- dedupe and lookups ------------------------------------------------------------------------


def test_dedupe_reduces_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    best = latest_per_key(df, "k", [F.col("id").desc()])
    assert {r.id for r in best.collect()} == {997, 998, 999}
    text = plan_of(latest_per_key(df, "k", [F.col("id").desc()], keep_missing_keys=False))
    assert text.index("Final") < text.index("Exchange") < text.rindex("WindowGroupLimit")


@pytest.mark.parametrize("threshold", ["10485760", "-1"])
def test_lookup_with_dominant_null_and_orphan_keys(spark, threshold):
    """A third of the rows share a matched key, a third an unmatched one, the rest vary or are NULL."""
    key = (
        F.when(F.col("id") % 3 == 0, "hot")
        .when(F.col("id") % 3 == 1, "hot-orphan")
        .when(F.col("id") % 5 == 0, None)
        .otherwise(F.concat(F.lit("k"), F.col("id") % 40))
    )
    left = spark.range(6000).select("id", key.alias("k"))
    right = spark.range(20).select(F.concat(F.lit("k"), "id").alias("k"), F.col("id").alias("v")).union(
        spark.createDataFrame([("hot", -1)], "k STRING, v BIGINT")
    )
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        spread = lookup(left, right, "k", heavy_keys(left, "k", 4), ["id"])
        plain = lookup(left, right, "k")
        assert rows_of(spread.na.fill("-", ["k"]).na.fill(-9, ["v"])) == rows_of(
            plain.na.fill("-", ["k"]).na.fill(-9, ["v"])
        )
        if threshold == "-1":
            text = plan_of(spread)
            assert text.count("hashpartitioning(_probe") == 2 and "_slot" in text
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_lookup_balances_its_partitions(spark):
    """With a matched key and a missing key on a third of the rows each, no task gets many more
    rows than another."""
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, None).otherwise(F.col("id").cast("string"))
    left = spark.range(30000).select("id", key.alias("k"))
    right = spark.range(30000).select(F.col("id").cast("string").alias("k")).union(spark.createDataFrame([("hot",)], "k STRING"))
    right = right.withColumn("found", F.lit(True))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        joined = lookup(left, right, "k", heavy_keys(left, "k", 8), ["id"])
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 30000 and len(sizes) == 16 and max(sizes) < 2 * min(sizes)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_heavy_keys_are_bounded(spark):
    df = spark.range(1000).select((F.col("id") % 500).cast("string").alias("k"))
    assert heavy_keys(df, "k", 7, least_share=0).count() == 7


# --- keys --------------------------------------------------------------------------------------


def test_dense_key_is_the_global_rank(spark, staging):
    df = spark.range(5000).select(F.sha2(F.col("id").cast("string"), 256).alias("k")).repartition(7)
    keyed = dense_key(df, "k", "sk", staging)
    expected = {k: i + 1 for i, k in enumerate(sorted(r.k for r in df.collect()))}
    assert {r.k: r.sk for r in keyed.collect()} == expected


def test_dense_key_ranks_without_gathering_rows(spark, staging):
    df = spark.range(1000).select(F.col("id").cast("string").alias("k"))
    text = plan_of(dense_key(df, "k", "sk", staging))
    # The only single-partition step sums one row per range.
    assert text.count("SinglePartition") == 1
    assert "k#" not in text[text.index("SinglePartition") :]


def test_stable_key_keeps_old_numbers(spark, staging):
    old = spark.createDataFrame([("m", 1), ("z", 2)], "k STRING, sk BIGINT")
    rows = spark.createDataFrame([("a",), ("m",), ("z",), ("b",)], "k STRING")
    keyed = {r.k: r.sk for r in stable_key(rows, old, "k", "sk", staging).collect()}
    assert keyed == {"m": 1, "z": 2, "a": 3, "b": 4}


def test_lookup_dimension_skips_null(spark, staging):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("b",)], "v STRING")
    assert {r.nombre: r.sk_v for r in dim_lookup(df, "v", "sk_v", staging).collect()} == {"a": 1, "b": 2}


def test_calendar(spark):
    days = calendar(spark, date(2025, 1, 1), date(2027, 12, 31))
    assert days.count() == 1095
    saturday = days.where("fecha = '2026-02-28'").first()
    assert (saturday.sk_fecha, saturday.trimestre, saturday.nombre_mes, saturday.es_fin_semana) == (
        20260228, 1, "February", True,
    )
    with pytest.raises(ValueError):
        calendar(spark, date(2026, 1, 2), date(2026, 1, 1))
    dates = spark.createDataFrame([(date(2026, 1, 3),), (date(2026, 5, 6),), (None,)], "d DATE")
    stray = spark.createDataFrame([(date(1, 1, 1),), (date(9000, 1, 1),)], "d DATE")
    assert calendar_of(dates).count() == 365
    assert calendar_of(dates, stray).count() == 3 * 365
    assert calendar_of(dates.limit(0)).count() == 0


# --- upsert, marks, history --------------------------------------------------------------------


def versions(spark, *rows):
    schema = "k STRING, v STRING, at TIMESTAMP, _row_hash STRING"
    return spark.createDataFrame([(k, v, datetime.fromisoformat(a), v) for k, v, a in rows], schema)


def current(store):
    return {r.k: r.v for r in store.read("silver", "t").collect()}


def test_upsert_replaces_inserts_and_ignores_empty(spark, store):
    upsert_table(versions(spark, ("a", "1", OLD), ("b", "1", OLD)), store, "silver", "t", "k", 4)
    upsert_table(versions(spark, ("b", "2", MID), ("c", "1", MID)), store, "silver", "t", "k", 4)
    assert current(store) == {"a": "1", "b": "2", "c": "1"}
    upsert_table(versions(spark).limit(0), store, "silver", "t", "k", 4)
    assert store.read("silver", "t").count() == 3


def test_upsert_rewrites_only_touched_buckets(spark, store):
    upsert_table(spark.range(400).select(F.col("id").cast("string").alias("k"), F.lit("1").alias("v")), store, "silver", "t", "k", 8)
    before = set(store.read("silver", "t").inputFiles())
    upsert_table(spark.createDataFrame([("7", "2")], "k STRING, v STRING"), store, "silver", "t", "k", 8)
    kept = before & set(store.read("silver", "t").inputFiles())
    assert len(kept) == len(before) - 1 and store.read("silver", "t").where("v = '2'").count() == 1


def test_newest_wins_over_late_rows(spark, store):
    order = [F.col("at").desc_nulls_last()]
    for rows in ([("a", "new", NEW)], [("a", "late", OLD), ("b", "late", OLD)], [("a", "new", NEW)]):
        upsert_table(versions(spark, *rows), store, "silver", "t", "k", 4, order)
    assert current(store) == {"a": "new", "b": "late"}


def test_unchanged_hash_is_not_rewritten(spark, store):
    first = versions(spark, ("a", "1", OLD), ("b", "1", OLD))
    upsert_table(first, store, "silver", "t", "k", 4)
    again = versions(spark, ("a", "1", NEW), ("b", "2", NEW))
    upsert_table(again, store, "silver", "t", "k", 4, only_changed_by="_row_hash")
    stamps = {r.k: str(r["at"]) for r in store.read("silver", "t").collect()}
    assert stamps == {"a": OLD, "b": NEW}


def test_identical_delivery_writes_no_file(spark, store):
    rows = versions(spark, *[(str(i), "1", OLD) for i in range(50)])
    upsert_table(rows, store, "silver", "t", "k", 4)
    before = set(store.read("silver", "t").inputFiles())
    upsert_table(rows, store, "silver", "t", "k", 4, only_changed_by="_row_hash")
    upsert_table(rows, store, "silver", "t", "k", 4, only_changed_by=["v", "at"])
    upsert_table(rows, store, "silver", "t", "k", 4, [F.col("at").desc_nulls_last()])
    assert set(store.read("silver", "t").inputFiles()) == before


def test_changes_to_null_and_across_separators_are_seen(spark, store):
    schema = "k STRING, a STRING, b STRING"
    old = spark.createDataFrame([("1", None, "x"), ("2", "p|q", ""), ("3", "same", None)], schema)
    new = spark.createDataFrame([("1", "", "x"), ("2", "p", "q|"), ("3", "same", None)], schema)
    assert {r.k for r in changed_rows(old, new, "k", ["a", "b"]).collect()} == {"1", "2"}
    at = lambda day: F.lit(f"2026-01-0{day} 00:00:00").cast("timestamp")
    history = next_versions(first_versions(old, "k", ["a", "b"], at(1)), new, "k", ["a", "b"], at(2))
    assert rows_of(history.where("NOT _is_current").select("k")) == [("1",), ("2",)]


def test_interrupted_swap_is_repeated(spark, store, monkeypatch):
    upsert_table(versions(spark, ("a", "1", OLD), ("b", "1", OLD)), store, "silver", "t", "k", 2)
    real = LayerStore.redo
    calls = []

    def fails_once(self, *args):
        calls.append(args)
        if len(calls) == 4:  # after the rows were written aside
            raise RuntimeError("driver lost")
        return real(self, *args)

    monkeypatch.setattr(LayerStore, "redo", fails_once)
    with pytest.raises(RuntimeError, match="driver lost"):
        upsert_table(versions(spark, ("a", "2", MID)), store, "silver", "t", "k", 2)
    assert current(store) == {"a": "1", "b": "1"}
    monkeypatch.undo()
    store.redo("silver", "t", ["_bucket"])
    assert current(store) == {"a": "2", "b": "1"} and not store.exists("silver", "t__pending")


def test_keys_without_rows_disappear(spark, store):
    upsert_table(versions(spark, ("a", "1", OLD), ("b", "1", OLD), ("c", "1", OLD)), store, "silver", "t", "k", 8)
    keys = spark.createDataFrame([("a",), ("b",)], "k STRING")
    replace_keys(versions(spark, ("b", "2", MID)), keys, store, "silver", "t", "k", 8)
    assert current(store) == {"b": "2", "c": "1"}


def test_bucket_layouts_do_not_mix(spark, store):
    overwrite_bucketed(versions(spark, ("a", "1", OLD)), store, "silver", "t", "k", 4)
    with pytest.raises(ValueError, match="not in 8 buckets"):
        upsert_table(versions(spark, ("a", "2", MID)), store, "silver", "t", "k", 8)


def test_soft_delete(spark):
    target = spark.createDataFrame([("a", True), ("b", False), ("c", True)], "k STRING, _is_active BOOLEAN")
    snapshot = spark.createDataFrame([("a",), ("b",), ("b",)], "k STRING")
    assert rows_of(mark_missing(target, snapshot, "k")) == [("a", True), ("b", True), ("c", False)]


def test_marks_are_separate_and_never_move_back(spark, store, run):
    marks = Watermarks(store, "actualizado_en")
    assert marks.get("bronze", "citas") == EPOCH
    marks.seed(("bronze", "silver"), ("citas",), run)
    marks.advance("bronze", "citas", MID, run)
    marks.advance("bronze", "citas", OLD, run)
    marks.advance("bronze", "citas", None, run)
    marks.seed(("bronze", "silver"), ("citas",), run)
    assert marks.get("bronze", "citas").startswith(MID) and marks.get("silver", "citas").startswith("1970")
    assert marks.table().count() == 2


def test_a_broken_mark_table_is_an_error(spark, store, run):
    marks = Watermarks(store, "actualizado_en")
    marks.seed(("bronze",), ("citas",), run)
    for file in Path(store.path("ops", "ingestion_watermark")).rglob("*.parquet"):
        file.write_text("not parquet")
    with pytest.raises(Exception):
        marks.get("bronze", "citas")


def test_incremental_filter_is_strict_and_reaches_the_scan(spark, store):
    store.overwrite(versions(spark, ("a", "1", OLD), ("b", "1", MID), ("c", "1", NEW)), "bronze", "t")
    table = store.read("bronze", "t")
    assert [r.k for r in newer_than(table, "at", MID).collect()] == ["c"]
    assert {r.k for r in newer_than(table, "at", MID, "1 day").collect()} == {"b", "c"}
    assert "GreaterThan(at" in plan_of(newer_than(table, "at", MID))
    nulls = table.withColumn("at", F.lit(None).cast("timestamp"))
    assert newer_than(nulls, "at", OLD).count() == 0


def test_type_2_history(spark):
    at = lambda day: F.lit(f"2026-01-0{day} 00:00:00").cast("timestamp")
    frame = lambda *rows: spark.createDataFrame(list(rows), "k STRING, city STRING")
    history = first_versions(frame(("a", "X"), ("b", "X")), "k", ["city"], at(1))
    history = next_versions(history, frame(("a", "Y"), ("b", "X"), ("c", "Z")), "k", ["city"], at(2))
    history = next_versions(history, frame(("a", "Y"), ("b", None)), "k", ["city"], at(3), close_missing=True)
    found = sorted(
        (r.k, r.city or "-", r._valid_from.day, r._valid_to.day if r._valid_to else 0, r._is_current)
        for r in history.collect()
    )
    assert found == [
        ("a", "X", 1, 2, False), ("a", "Y", 2, 0, True),
        ("b", "-", 3, 0, True), ("b", "X", 1, 3, False),
        ("c", "Z", 2, 3, False),
    ]


# --- profiling ---------------------------------------------------------------------------------


def test_profiles(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "nan"), (None, "y"), (None, "y"), ("b", "")], "k STRING, v STRING")
    assert tuple(profile.null_counts(df).first()) == (2, 2)
    assert tuple(profile.duplicate_count(df, "k").first()) == (5, 3, 2)
    assert rows_of(profile.cardinality(df, ["k", "v"])) == [("k", 3), ("v", 4)]
    assert rows_of(profile.cardinality(df, ["k", "v"], approximate=True)) == [("k", 3), ("v", 4)]
    assert [tuple(r) for r in profile.top_values(df, "k", 2).collect()] == [(None, 2), ("a", 2)]
    parents = spark.createDataFrame([("a",), ("z",)], "k STRING")
    assert tuple(profile.coverage(parents, df, "k").first()) == (2, 2, 5, 2.5)
    assert profile.orphan_count(df, parents, "k").first()[0] == 3


def test_mismatches_equal_the_pairs_of_a_join(spark):
    left = spark.range(60).select((F.col("id") % 4).alias("k"), F.when(F.col("id") % 7 > 0, F.col("id") % 3).alias("v"))
    right = spark.range(50).select((F.col("id") % 5).alias("k"), F.when(F.col("id") % 6 > 0, F.col("id") % 2).alias("v"))
    a, b = left.collect(), right.collect()
    brute = sum(x.k == y.k and None not in (x.v, y.v) and x.v != y.v for x in a for y in b)
    assert profile.mismatch_count(left, right, "k", "v").first()[0] == brute
