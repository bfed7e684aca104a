"""Clustering on two columns, histories of late versions, and point-in-time keys."""

from datetime import datetime, timedelta
from math import sqrt
from pathlib import Path
from random import Random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tierlake.operators.curve import interleaved, rank, rank_bounds, with_position
from tierlake.operators.history import observed, version_at, versions_of

START = datetime(2020, 1, 1)
SEEN = "k STRING, city STRING, at TIMESTAMP, id STRING"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- curve -------------------------------------------------------------------------------------


def test_ranks_count_bounds_below_and_bits_take_turns(spark):
    df = spark.range(1000).select(F.col("id").alias("a"), (F.col("id") % 7).alias("b"), F.lit(None).cast("int").alias("c"))
    bounds = rank_bounds(df, ["a", "b", "c"], 4)
    assert len(bounds["a"]) == 15 and bounds["c"] == []
    ranked = df.select("a", rank("a", bounds["a"], 4).alias("ra"), rank("b", bounds["b"], 4).alias("rb"), "b", rank("c", [], 4).alias("rc"))
    rows = ranked.withColumn("z", interleaved(["ra", "rb"], 4)).collect()
    for r in rows:
        assert r.ra == sum(x < r.a for x in bounds["a"]) and r.rb == sum(x < r.b for x in bounds["b"]) and r.rc == 0
        assert r.z == int("".join(x + y for x, y in zip(f"{r.ra:04b}", f"{r.rb:04b}")), 2)
    with pytest.raises(ValueError):
        interleaved(["x"] * 7)


def test_empty_tables_and_missing_values_have_a_place(spark):
    empty = spark.createDataFrame([], "id BIGINT, a INT, b INT")
    assert with_position(empty, ["a", "b"], "z").columns == ["id", "a", "b", "z"]
    assert with_position(empty, ["a", "b"], "z").count() == 0
    some = spark.createDataFrame([(1, None, 5), (2, 3, None), (3, 3, 5)], "id BIGINT, a INT, b INT")
    assert {r.id: r.z is None for r in with_position(some, ["a", "b"], "z").collect()} == {1: False, 2: False, 3: False}


@pytest.mark.parametrize("hot", [False, True])
def test_either_filter_leaves_the_square_root_of_the_files(spark, store, hot):
    files = 64
    patient = (F.col("id") * 7919) % 3001
    patient = F.when(F.col("id") % 3 == 0, 1500).otherwise(patient) if hot else patient
    df = spark.range(60000).select("id", ((F.col("id") * 104729) % 2003).alias("day"), patient.alias("patient"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", str(files))
    try:
        store.clustered_on_curve(df, "gold", "t", ["day", "patient"], "id")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert store.read("gold", "t").columns == ["id", "day", "patient"] and store.read("gold", "t").count() == 60000
    spans = []
    for file in Path(store.path("gold", "t")).glob("*.parquet"):
        meta = pq.read_metadata(file)
        groups = [meta.row_group(g) for g in range(meta.num_row_groups)]
        if groups:
            spans.append(
                [(min(g.column(c).statistics.min for g in groups), max(g.column(c).statistics.max for g in groups)) for c in (1, 2)]
            )
    assert len(spans) >= files * 0.9
    for side, values in ((0, range(0, 2003, 50)), (1, range(0, 3001, 77))):
        left = [sum(s[side][0] <= v <= s[side][1] for s in spans) for v in values]
        assert sum(left) / len(left) <= 2 * sqrt(len(spans)), (side, left)
    found = store.read("gold", "t").where("patient = 1501")
    assert "EqualTo(patient,1501)" in plan_of(found)
    assert found.count() == df.where("patient = 1501").count()


# --- histories ---------------------------------------------------------------------------------


def brute_history(rows):
    """Key by key: one row a moment (least id), then each row that differs from the one before."""
    found = []
    for key in {r[0] for r in rows if r[0] is not None}:
        moments = {}
        for _, city, at, tie in sorted((r for r in rows if r[0] == key and r[2] is not None), key=lambda r: r[3], reverse=True):
            moments[at] = city
        opened = []
        for at in sorted(moments):
            if not opened or opened[-1][1] != moments[at]:
                opened.append((at, moments[at]))
        for i, (at, city) in enumerate(opened):
            until = opened[i + 1][0] if i + 1 < len(opened) else None
            found.append((key, city, at, until, until is None))
    return sorted(found, key=repr)


def sightings(seed, count=400):
    draw = Random(seed)
    rows = []
    for i in range(count):
        key = "hot" if i % 3 == 0 else draw.choice(["a", "b", "c", "d", None])
        at = draw.choice([START + timedelta(days=draw.randrange(400), hours=draw.randrange(3)), START, None])
        rows.append((key, draw.choice(["X", "Y", None, ""]), at, f"{i:05d}"))
    return rows + rows[:20]


def history_rows(df):
    return sorted(((r.k, r.city, r._valid_from, r._valid_to, r._is_current) for r in df.collect()), key=repr)


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 0, 1), (1, 2, 0)])
@pytest.mark.parametrize("split", [False, True])
def test_versions_in_any_order_give_one_history(spark, order, split):
    rows = sightings(5)
    third = len(rows) // 3
    parts = [rows[:third], rows[third : 2 * third], rows[2 * third :]]
    kept = None
    for number in order:
        seen = observed(spark.createDataFrame(parts[number], SEEN), "k", ["city"], "at", "id")
        kept = seen if kept is None else kept.unionByName(seen)
    heavy = spark.createDataFrame([("hot",), ("a",), ("nobody",)], "k STRING") if split else None
    assert history_rows(versions_of(kept, "k", ["city"], heavy)) == brute_history(rows)


def test_a_late_version_between_equal_ones_splits_them(spark):
    day = lambda n: START + timedelta(days=n)
    early = observed(spark.createDataFrame([("a", "X", day(1), "1"), ("a", "X", day(9), "2")], SEEN), "k", ["city"], "at", "id")
    assert history_rows(versions_of(early, "k", ["city"])) == [("a", "X", day(1), None, True)]
    late = observed(spark.createDataFrame([("a", "Y", day(5), "3")], SEEN), "k", ["city"], "at", "id")
    assert history_rows(versions_of(early.unionByName(late), "k", ["city"])) == sorted(
        [("a", "X", day(1), day(5), False), ("a", "Y", day(5), day(9), False), ("a", "X", day(9), None, True)], key=repr
    )
    assert versions_of(early.where("false"), "k", ["city"]).count() == 0


def test_a_history_takes_one_shuffle(spark):
    seen = observed(spark.createDataFrame(sightings(1), SEEN), "k", ["city"], "at", "id")
    plan = plan_of(versions_of(seen, "k", ["city"]))
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Sort [") == 1


@pytest.mark.parametrize("bin_days", [7, 366])
def test_facts_meet_the_version_of_their_time(spark, bin_days):
    rows = sightings(8)
    history = versions_of(observed(spark.createDataFrame(rows, SEEN), "k", ["city"], "at", "id"), "k", ["city"])
    draw = Random(3)
    facts = [
        (i, draw.choice(["hot", "a", "b", "zz", None]), draw.choice([START + timedelta(days=draw.randrange(-30, 900), hours=draw.randrange(3)), None]))
        for i in range(300)
    ]
    facts += [(1000 + i, r[0], r[2]) for i, r in enumerate(rows)]
    frame = spark.createDataFrame(facts, "id BIGINT, k STRING, at TIMESTAMP")
    dated = version_at(frame, history, "k", "at", ("_valid_from", "city"), bin_days)
    found = {r.id: (r._valid_from, r.city) for r in dated.collect()}
    intervals = brute_history(rows)
    for i, key, at in facts:
        valid = [(v[2], v[1]) for v in intervals if None not in (key, at) and v[0] == key and v[2] <= at and (v[3] is None or at < v[3])]
        assert found[i] == (valid[0] if valid else (None, None))
    assert dated.count() == len(facts)
    assert "NestedLoop" not in plan_of(dated) and "Cartesian" not in plan_of(dated)
    none = version_at(frame.where("false"), history, "k", "at", ("city",))
    assert none.count() == 0 and none.columns == ["id", "k", "at", "city"]
