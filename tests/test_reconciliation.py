"""Tables compared by content, and rollups of several grains from one scan."""

from random import Random

from pyspark.sql import functions as F

from clinic import extracts
from tierlake.operators import quality
from tierlake.plans import jobs, kpis
from tierlake.plans.entities import ENTITIES

ROW = "k STRING, a STRING, b STRING, n INT"


def groups(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def table(spark, rows):
    return spark.createDataFrame(rows, ROW)


def test_equal_tables_in_any_order_have_no_differing_groups(spark):
    draw = Random(4)
    rows = [(draw.choice(["x", "y", "z", "", None]), draw.choice(["p", None]), draw.choice(["q", None]), i % 5) for i in range(200)]
    shuffled = draw.sample(rows, len(rows))
    assert groups(quality.differing_groups(table(spark, rows), table(spark, shuffled), "k", ["a", "b", "n"])) == []
    wide = table(spark, shuffled).withColumn("n", F.col("n").cast("bigint")).withColumn("more", F.lit(1))
    assert groups(quality.differing_groups(table(spark, rows), wide, "k", ["a", "b", "n"])) == []
    digests = [quality.table_digest(table(spark, r), ["k", "a", "b", "n"]).first() for r in (rows, shuffled, [])]
    assert digests[0] == digests[1] and tuple(digests[2]) == (0, "0", 0)


def test_rows_replaced_under_equal_counts_and_sums_are_found(spark):
    rows = [("u", "p", None, 1), ("v", "p", "q", 2), ("w", "p", "q", 3), (None, "p", "q", 4)]
    group = {r.k: r.g for r in table(spark, rows).select("k", F.substring(F.md5("k"), 1, 2).alias("g")).collect()}

    def found(other):
        return groups(quality.differing_groups(table(spark, rows), table(spark, other), "k", ["a", "b", "n"]))

    assert found([("u", None, "p", 1), *rows[1:]]) == [(group["u"], 1, 1)]
    assert found([rows[0], ("v", "p", "q", 3), ("w", "p", "q", 2), rows[3]]) == sorted([(group["v"], 1, 1), (group["w"], 1, 1)])
    assert found([*rows[:3], (None, "p", "q", 5)]) == [(None, 1, 1)]
    assert found([*rows, *rows[2:3], *rows[2:3]]) == [(group["w"], 1, 3)]
    assert found([]) == sorted([(g, 1, 0) for g in group.values()], key=repr)


def test_a_repeated_delivery_that_replaces_rows_fails(spark, store, run):
    settings = jobs.Settings(store, buckets=2)
    jobs.run_all(settings, extracts(spark), run, gold=False, check=False)
    before = jobs.silver_content(store)
    same = quality.all_results(jobs.repeat_results(settings, before, "Q-O03", quality.CRIT)).collect()
    assert [r.passed for r in same] == [True] * len(ENTITIES)
    silver = jobs.silver_table(store, ENTITIES[1])
    other = spark.createDataFrame(silver.collect(), silver.schema).withColumn("sede", F.lit("Otra"))
    store.overwrite(other, "silver", ENTITIES[1].name, ["_bucket"])
    found = {r.check_id: (r.metric_value, r.passed) for r in quality.all_results(jobs.repeat_results(settings, before, "Q-O03", quality.CRIT)).collect()}
    assert found.pop(f"Q-O03-{ENTITIES[1].name}") == (1.0, False)
    assert set(found.values()) == {(0.0, True)}


def test_all_grains_equal_one_query_each_from_one_scan(spark, tmp_path):
    draw = Random(6)
    rows = [
        (draw.choice([2020, 2021, None]), draw.randrange(1, 3), draw.choice(["N", "S", None]), draw.choice(["m", None]), draw.choice("abc"), draw.choice("tu"),
         draw.randrange(2), draw.randrange(2), draw.randrange(2))
        for _ in range(300)
    ]
    names = "anio INT, mes INT, sede STRING, especialidad STRING, estado_cita STRING, tipo_cita STRING, es_atendida INT, es_cancelada INT, es_no_asistencia INT"
    spark.createDataFrame(rows, names).write.parquet(str(tmp_path / "visits"))
    visits = spark.read.parquet(str(tmp_path / "visits"))
    found = kpis.appointment_rates_by_grain(visits)
    assert found._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    kept, by = found.collect(), ["anio", "mes", "sede", "especialidad", "estado_cita", "tipo_cita"]
    measures = ["total_citas", "tasa_asistencia", "tasa_cancelacion", "tasa_no_asistencia"]
    for grain in kpis.APPOINTMENT_GRAINS:
        number = int("".join("0" if c in grain else "1" for c in by), 2)
        expected = [tuple(r[c] for c in (*grain, *measures)) for r in kpis.appointment_rates(visits, grain).collect()]
        assert sorted([tuple(r[c] for c in (*grain, *measures)) for r in kept if r.grain == number], key=repr) == sorted(expected, key=repr)
    assert len({r.grain for r in kept}) == len(kpis.APPOINTMENT_GRAINS)
    empty = kpis.appointment_rates_by_grain(visits.where("false"), [("sede",)])
    assert empty.count() == 0
