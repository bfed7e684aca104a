"""Event-time arrivals, stored sketches of distinct values, and rejects of any entity."""

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tierlake.operators import sketches
from tierlake.operators.open_rejects import field, open_rejects, write_open_rejects
from tierlake.streaming import admit_arrivals, distinct_arrivals, with_source_file

ROW = "k STRING, at TIMESTAMP"


def day(number):
    return datetime(2020, 1, number)


def deliver(spark, store, number, items, restart=True):
    spark.createDataFrame(items, ROW).coalesce(1).write.mode("append").parquet(f"{store.root}/landing/d={number}")
    if not restart:
        return
    arrivals = with_source_file(
        spark.readStream.schema(spark.createDataFrame([], ROW).schema).option("maxFilesPerTrigger", 1).parquet(f"{store.root}/landing/d=*")
    )
    admit_arrivals(arrivals, "at", "5 days", store, "t", f"{store.root}/cp-a").awaitTermination()
    distinct_arrivals(arrivals, ("k", "at"), "at", "5 days", store, "t", f"{store.root}/cp-b").awaitTermination()


def stored(store, name):
    return sorted((r.k, r.at and r.at.day) for r in store.read("bronze", name).collect())


def test_late_repeated_and_undated_rows(spark, store):
    deliver(spark, store, 1, [("a", day(10)), ("a", day(10)), ("b", day(1)), ("u", None)])
    # The mark is day 5 now: day 5 itself is late, day 6 is not.
    deliver(spark, store, 2, [("c", day(5)), ("d", day(6)), ("a", day(10)), ("e", day(20))])
    deliver(spark, store, 3, [("f", day(15)), ("g", day(16)), ("e", day(20)), ("a", day(10))])
    assert stored(store, "t") == [("a", 10), ("b", 1), ("d", 6), ("e", 20), ("g", 16)]
    assert sorted(stored(store, "t__late"), key=repr) == sorted([("u", None), ("c", 5), ("f", 15), ("a", 10)], key=repr)
    files = {r.k: r._source_file for r in store.read("bronze", "t").collect()}
    assert "/d=1/" in files["a"] and "/d=2/" in files["e"] and "/d=3/" in files["g"]
    # Starting again without new files changes nothing.
    deliver(spark, store, 3, [])
    assert len(stored(store, "t")) == 5 and len(stored(store, "t__late")) == 4


def test_several_files_are_split_trigger_by_trigger(spark, store):
    deliver(spark, store, 1, [("a", day(10))], restart=False)
    deliver(spark, store, 2, [("b", day(20))], restart=False)
    deliver(spark, store, 3, [("c", day(12)), ("a", day(10)), ("d", day(18))])
    batches = sorted(tuple(r) for r in store.read("ops", "t__marks").select("number", F.dayofmonth("reached")).collect())
    assert batches == [(0, 10), (1, 20), (2, 18)]
    assert stored(store, "t") == [("a", 10), ("b", 20), ("d", 18)]
    assert stored(store, "t__late") == [("a", 10), ("c", 12)]


def test_a_batch_that_runs_again_replaces_its_rows(spark, store):
    deliver(spark, store, 1, [("a", day(10)), ("b", day(9))])
    first = stored(store, "t__admitted")
    arrivals = with_source_file(spark.readStream.schema(spark.createDataFrame([], ROW).schema).parquet(f"{store.root}/landing/d=*"))
    # A lost checkpoint: the batch of that number comes again, and repetitions stop at the state.
    admit_arrivals(arrivals, "at", "5 days", store, "t", f"{store.root}/cp-other").awaitTermination()
    assert stored(store, "t__admitted") == first
    distinct_arrivals(arrivals, ("k", "at"), "at", "5 days", store, "t", f"{store.root}/cp-b").awaitTermination()
    assert stored(store, "t") == [("a", 10), ("b", 9)]


def test_sketches_merge_and_adding_again_changes_nothing(spark, store):
    rows = spark.range(30_000).select(
        (F.col("id") % 60 + 1).cast("int").alias("day"), F.when(F.col("id") % 7 > 0, F.col("id") % 9_000).alias("who")
    )
    month = F.floor(F.col("day") / 30).cast("int")
    sketches.rebuild_sketches(rows.where("day < 20"), store, "s", ["day"], "who", month)
    for _ in range(2):
        touched = sketches.add_to_sketches(rows.where("day >= 20"), store, "s", ["day"], "who", month)
    assert touched == ["m000000", "m000001", "m000002"]
    assert store.read("gold", "s").count() == 60
    got = sketches.merged_distincts(store.read("gold", "s"), [month.alias("m")]).collect()
    exact = {r.m: r.n for r in rows.groupBy(month.alias("m")).agg(F.count_distinct("who").alias("n")).collect()}
    assert {r.m for r in got} == set(exact)
    for r in got:
        assert abs(r.estimate - exact[r.m]) <= max(1, 4 * sketches.standard_error() * exact[r.m])
    days = sketches.merged_distincts(store.read("gold", "s"), ["day"]).where("day >= 20").collect()
    sizes = {r.day: r.n for r in rows.groupBy("day").agg(F.count_distinct("who").alias("n")).collect()}
    assert all(abs(r.estimate - sizes[r.day]) <= 4 * sketches.standard_error() * sizes[r.day] for r in days)


def test_months_that_nothing_touches_are_not_written(spark, store):
    month = F.col("m")
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "m INT, who STRING")
    sketches.rebuild_sketches(rows, store, "s", ["m"], "who", month)
    files = lambda m: sorted(f for f in store.read("gold", "s").inputFiles() if f"={m}/" in f)
    before = files("m000001"), files("m000002")
    assert sketches.add_to_sketches(spark.createDataFrame([(2, "c")], rows.schema), store, "s", ["m"], "who", month) == ["m000002"]
    assert sketches.add_to_sketches(rows.limit(0), store, "s", ["m"], "who", month) == []
    spark.catalog.refreshByPath(store.path("gold", "s"))
    assert files("m000001") == before[0] and files("m000002") != before[1]
    assert sketches.merged_distincts(store.read("gold", "s"), ["m"]).where("m = 2").first().estimate == 2


def test_open_rejects_keep_entities_apart_and_types_alive(spark, store):
    money = spark.createDataFrame([("x", Decimal("1.50"), day(3)), (None, None, None)], "id STRING, v DECIMAL(18,2), at TIMESTAMP")
    other = spark.createDataFrame([(7, [1, 2])], "`a.b` INT, list ARRAY<INT>").withColumn("_reject_reason", F.lit("odd"))
    write_open_rejects(money, store, "money", "b1", F.lit("bad"))
    write_open_rejects(other, store, "other", "b1")
    write_open_rejects(money.where("id = 'x'"), store, "money", "b1", F.lit("worse"))
    got = open_rejects(store).select(
        "_entity", "_reject_reason", field("id").alias("id"), field("v", "decimal(18,2)").alias("v"),
        field("at", "timestamp").alias("at"), field("a.b", "int").alias("ab"), field("list", "array<int>").alias("list"),
        field("id", "int").alias("wrong"),
    )
    assert sorted(tuple(r) for r in got.collect()) == [
        ("money", "worse", "x", Decimal("1.50"), day(3), None, None, None),
        ("other", "odd", None, None, None, 7, [1, 2], None),
    ]
    write_open_rejects(money.limit(0), store, "money", "b1", F.lit("none"))
    assert [r._entity for r in open_rejects(store).collect()] == ["other"]
    with pytest.raises(ValueError):
        field("it's")
