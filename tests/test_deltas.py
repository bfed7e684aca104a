"""Tables of a base and deltas: merged reads, folding by size, and interruptions at every step."""

from random import Random

import pytest
from pyspark.sql import functions as F

from tierlake.operators.deltas import DeltaTable, Part

ROW = "k STRING, v INT, at INT"


def rows(spark, items):
    return spark.createDataFrame(items, ROW)


def content(table):
    return sorted(tuple(r) for r in table.read().select("k", "v", "at").collect())


def test_last_upsert_wins_and_deleted_keys_return(spark, store):
    table = DeltaTable(store, "silver", "t", "k")
    with pytest.raises(ValueError):
        table.read()
    table.upsert(rows(spark, [("a", 1, 1), ("b", 1, 1), (None, 9, 9)]))
    table.upsert(rows(spark, [("b", 2, 0), ("c", 2, 0)]))
    table.delete(rows(spark, [("a", 0, 0), ("c", 0, 0), ("z", 0, 0)]))
    assert content(table) == [("b", 2, 0)]
    table.upsert(rows(spark, [("c", 3, 0)]).withColumn("more", F.lit("x")))
    assert content(table) == [("b", 2, 0), ("c", 3, 0)]
    assert {r.k: r.more for r in table.read().collect()} == {"b": None, "c": "x"}
    assert table.compact(ratio=1e9) == Part(0, 3)
    assert content(table) == [("b", 2, 0), ("c", 3, 0)]
    assert store.read("silver", f"t/{Part(0, 3).folder}").count() == 2
    with pytest.raises(ValueError):
        table.upsert(rows(spark, []).withColumn("_gone", F.lit(True)))


@pytest.mark.parametrize("ordered", [False, True])
def test_any_sequence_equals_a_dictionary(spark, store, ordered):
    draw = Random(5)
    newest = [F.col("at").desc(), F.col("v").desc()] if ordered else []
    table = DeltaTable(store, "silver", "t", "k", newest)
    best = {}
    for step in range(6):
        items = {k: (k, draw.randrange(9), draw.randrange(5)) for k in draw.sample("abcdefgh", 4)}
        table.upsert(rows(spark, list(items.values())))
        for k, (_, v, at) in items.items():
            if not ordered or k not in best or (at, v) > best[k][::-1]:
                best[k] = (v, at)
        if step % 2:
            table.compact()
        assert content(table) == sorted((k, *r) for k, r in best.items())


def test_interrupted_writes_and_folds_change_nothing(spark, store):
    table = DeltaTable(store, "silver", "t", "k")
    table.upsert(rows(spark, [("a", 1, 1), ("b", 1, 1)]))
    table.upsert(rows(spark, [("b", 2, 2)]))
    before = content(table)

    def unfinished(part):
        files, mark = store._folder(f"{store.path('silver', 't')}/{part.folder}/_SUCCESS")
        files.delete(mark, False)

    # An upsert whose write did not end.
    store.overwrite(rows(spark, [("a", 7, 7)]).withColumn("_gone", F.lit(False)), "silver", "t/" + Part(2, 2).folder)
    unfinished(Part(2, 2))
    assert content(table) == before and table.live() == [Part(0, 0), Part(1, 1)]
    # A fold whose write did not end, then one that ended without deleting what it folded.
    assert table.compact(ratio=1e9) == Part(0, 1)
    unfinished(Part(0, 1))
    assert content(table) == before and table.live() == [Part(0, 0), Part(1, 1)]
    assert table.compact(ratio=1e9) == Part(0, 1)
    assert table.parts() == [Part(0, 0), Part(0, 1), Part(1, 1)] and table.live() == [Part(0, 1)]
    reader = table.read()
    table.upsert(rows(spark, [("c", 3, 3)]))
    assert content(table) == [*before, ("c", 3, 3)]
    assert sorted(tuple(r)[:3] for r in reader.collect()) == before
    # The next fold deletes them.
    table.compact(ratio=0)
    assert table.parts() == [Part(0, 1), Part(2, 2)]


def test_a_small_increment_writes_little_and_leaves_the_base_alone(spark, store):
    table = DeltaTable(store, "silver", "t", "k")
    table.upsert(spark.range(200_000).select(F.md5(F.col("id").cast("string")).alias("k"), F.lit(1).alias("v"), F.lit(1).alias("at")))
    base = store.size("silver", "t/" + Part(0, 0).folder)
    for i in range(3):
        table.upsert(spark.range(50).select(F.md5((F.col("id") * 1000 + i).cast("string")).alias("k"), F.lit(2).alias("v"), F.lit(2).alias("at")))
    written = store.size("silver", "t") - base
    assert written < base / 100
    assert table.compact() == Part(1, 3)
    assert table.live() == [Part(0, 0), Part(1, 3)]
    assert store.size("silver", "t/" + Part(0, 0).folder) == base
    assert table.read().where("v = 2").count() == 150
    # One key is looked up in the files of its range.
    assert "k,aa" in table.read().where("k = 'aa'")._jdf.queryExecution().executedPlan().toString().replace("EqualTo(", "")


def test_base_rows_are_not_shuffled_by_a_read(spark, store):
    table = DeltaTable(store, "silver", "t", "k", [F.col("at").desc()])
    table.upsert(spark.range(1000).select(F.col("id").cast("string").alias("k"), F.lit(1).alias("v"), F.lit(1).alias("at")))
    table.upsert(rows(spark, [("7", 2, 2)]))
    plan = table.read()._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
