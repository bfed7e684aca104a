"""Gold that follows increments equals gold that is rebuilt, however often a step is repeated."""

import shutil
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from clinic import extract, extracts
from tierlake.operators import rollups
from tierlake.operators.entity import Run
from tierlake.operators.rollups import Rollup, apply_changes, rebuild_rollup, rollup_rows, signed_changes
from tierlake.operators.upsert import overwrite_bucketed, upsert_table
from tierlake.plans import incremental_gold as gold
from tierlake.plans import jobs
from tierlake.sources.store import LayerStore

RUN = Run("20020101_000000_cafe0001", datetime(2002, 1, 1), date(2002, 1, 1))
CHANGES = {
    # A late parent, a patient that turns invalid and takes its visits along, and new versions.
    "pacientes": [
        {"id_paciente": "zz", "actualizado_en": "2026-06-01 00:00:00"},
        {"id_paciente": "p2", "sexo": "X", "actualizado_en": "2026-06-01 00:00:00"},
    ],
    "citas": [
        {"id_cita": "c1", "especialidad": "Nueva", "fecha_hora_cita": "2026-03-05 08:00:00", "actualizado_en": "2026-06-01 00:00:00"},
        {"id_cita": "c99", "actualizado_en": "2026-06-02 00:00:00"},
    ],
    "facturacion": [
        {"id_factura": "f1", "valor_bruto": "70", "valor_descuento": "0", "valor_neto": "70", "actualizado_en": "2026-06-01 00:00:00"},
        {"id_factura": "f8", "valor_neto": "1", "actualizado_en": "2026-06-01 00:00:00"},
    ],
    "eventos_clinicos": [{"id_evento": "e1", "tipo_evento": "Otro tipo", "actualizado_en": "2026-06-01 00:00:00"}],
}


def run_after(days):
    at = RUN.at + timedelta(days=days)
    return Run(f"{at:%Y%m%d}_000000_cafe000{days}", at, RUN.as_of)


def settings_at(spark, path):
    return jobs.Settings(LayerStore(spark, str(path)), buckets=2, record_changes=True)


@pytest.fixture(scope="module")
def lakes(spark, tmp_path_factory):
    """A lake whose gold was started, the same after an increment of silver, and that one rebuilt."""
    root = tmp_path_factory.mktemp("lakes")
    settings = settings_at(spark, root / "started")
    jobs.run_all(settings, extracts(spark), RUN, gold=False, check=False)
    gold.start_gold(settings, RUN)
    shutil.copytree(root / "started", root / "moved")
    settings = settings_at(spark, root / "moved")
    sources = {entity: extract(spark, entity, rows) for entity, rows in CHANGES.items()}
    jobs.run_all(settings, sources, run_after(1), jobs.INCREMENTAL, gold=False, check=False)
    shutil.copytree(root / "moved", root / "rebuilt")
    gold.start_gold(settings_at(spark, root / "rebuilt"), run_after(3))
    return root


def rows_of(df):
    return sorted(map(str, (r.asDict() for r in df.select(*sorted(df.columns)).collect())))


def state(store):
    facts = {f.name: store.read("gold", f.name).drop("_bucket", "_gold_loaded_at") for f in gold.FACTS}
    people = store.read("gold", "dim_paciente").select("sk_paciente", F.col("id_paciente").alias("patient"))
    facts = {n: rows_of(f.join(people, "sk_paciente").select("patient", *[c for c in f.columns if not c.startswith("sk_")])) for n, f in facts.items()}
    return facts | {
        "operations": rows_of(gold.stored_operations(store)),
        "billing": rows_of(gold.stored_billing(store)),
        "summary": rows_of(gold.stored_summary(store)),
    }


def test_following_equals_rebuilding(spark, lakes, tmp_path):
    before = state(LayerStore(spark, str(lakes / "started")))
    people = {r.id_paciente: r.sk_paciente for r in LayerStore(spark, str(lakes / "started")).read("gold", "dim_paciente").collect()}
    shutil.copytree(lakes / "moved", tmp_path / "lake")
    settings = settings_at(spark, tmp_path / "lake")
    touched = gold.update_gold(settings, run_after(1))
    followed = state(settings.store)
    assert followed != before and "m202603" in touched["fact_citas"]
    assert followed == state(LayerStore(spark, str(lakes / "rebuilt")))
    now = {r.id_paciente: r.sk_paciente for r in settings.store.read("gold", "dim_paciente").collect()}
    assert "p2" not in now and now["zz"] > max(people.values())
    assert all(now[p] == people[p] for p in set(now) & set(people))
    assert gold.update_gold(settings, run_after(2)) == {f.name: [] for f in gold.FACTS}


@pytest.mark.parametrize("step", ["replace_keys", "_refresh_summary"])
def test_an_update_that_was_cut_off_is_finished(spark, lakes, tmp_path, monkeypatch, step):
    """Wherever the driver is lost, the next update counts every change once."""
    shutil.copytree(lakes / "moved", tmp_path / "lake")
    settings = settings_at(spark, tmp_path / "lake")
    real = getattr(gold, step)

    def lost(*args):
        # Patients are replaced by the same function as facts; the loss is to hit a fact.
        if step != "replace_keys" or args[4].startswith("fact"):
            raise RuntimeError("driver lost")
        return real(*args)

    monkeypatch.setattr(gold, step, lost)
    with pytest.raises(RuntimeError, match="driver lost"):
        gold.update_gold(settings, run_after(1))
    monkeypatch.undo()
    gold.update_gold(settings, run_after(2))
    assert state(settings.store) == state(LayerStore(spark, str(lakes / "rebuilt")))


def test_an_update_writes_all_differences_and_then_refreshes_the_summary_once(spark, lakes, tmp_path, monkeypatch):
    """Facts do not wait for each other; the months of both sums are summed up together."""
    shutil.copytree(lakes / "moved", tmp_path / "lake")
    settings = settings_at(spark, tmp_path / "lake")
    seen, refresh = [], gold._refresh_summary

    def once(store, months):
        seen.append((months, [f.name for f in gold.FACTS if store.complete("ops", f"difference_{f.name}")]))
        refresh(store, months)

    monkeypatch.setattr(gold, "_refresh_summary", once)
    touched = gold.update_gold(settings, run_after(1))
    assert len(seen) == 1
    assert seen[0][0] == sorted({m for months in touched.values() for m in months})
    assert seen[0][1] == [f.name for f in gold.FACTS]
    assert not [f for f in gold.FACTS if settings.store.exists("ops", f"difference_{f.name}")]


SUMS = Rollup(
    "sums", ("g",), {"total": (lambda: F.col("v"), "bigint")}, lambda: F.col("month")
)


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), "k INT, g STRING, v INT, month INT")


def test_only_months_with_changes_are_rewritten(spark, store):
    old = frame(spark, (1, "a", 5, 202601), (2, None, 7, 202602), (3, "b", 1, 202603), (4, "a", 2, None))
    rebuild_rollup(SUMS, old, store, "b0")
    files = {f for f in store.read("gold", "sums").inputFiles()}
    new = frame(spark, (1, "a", 6, 202601), (2, None, 7, 202602), (3, "b", 1, 202602), (4, "a", 2, None))
    changes = signed_changes(old, new)
    assert changes.count() == 4
    assert apply_changes(SUMS, changes, store, "b1") == ["m202601", "m202602", "m202603"]
    assert apply_changes(SUMS, changes, store, "b1") == ["m202601", "m202602", "m202603"]
    found = {(r.g, r["_month"]): r.total for r in rollup_rows(SUMS, store).collect()}
    assert found == {("a", "m202601"): 6, (None, "m202602"): 7, ("b", "m202602"): 1, ("a", "none"): 2}
    kept = {f for f in store.read("gold", "sums").inputFiles()} & files
    assert [f for f in files if "_month=none" in f] == sorted(kept)
    assert apply_changes(SUMS, signed_changes(new, new), store, "b2") == []


def test_moving_rows_between_groups_keeps_sums(spark, store):
    rows = [(i, "abc"[i % 3], i, 202601 + i % 4) for i in range(40)]
    rebuild_rollup(SUMS, frame(spark, *rows), store, "b0")
    for number in range(1, 3):
        moved = [(k, "abcd"[(k + number) % 4], v * number, m if k % 2 else 202609) for k, _, v, m in rows if k % 5]
        apply_changes(SUMS, signed_changes(frame(spark, *rows), frame(spark, *moved)), store, f"b{number}")
        rows = moved
        assert rows_of(rollup_rows(SUMS, store)) == rows_of(
            rollups.summed(SUMS, frame(spark, *rows)).select("g", "total", "_month")
        )


def test_a_stale_swap_never_overwrites_a_rebuilt_table(spark, store):
    def table(*rows):
        return spark.createDataFrame(list(rows), "k STRING, v STRING")

    overwrite_bucketed(table(("a", "1"), ("b", "1"), ("c", "1")), store, "silver", "t", "k", 2)
    # An upsert that was lost after its rows had been written aside in full.
    from tierlake.operators.upsert import BUCKET, bucket_of

    aside = table(("a", "stale"), ("b", "stale"), ("c", "stale")).withColumn(BUCKET, bucket_of("k", 2))
    store.overwrite(aside, "silver", "t__pending", [BUCKET], placed=True)
    overwrite_bucketed(table(*[(k, "rebuilt") for k in "abcd"]), store, "silver", "t", "k", 2)
    assert not store.exists("silver", "t__pending")
    upsert_table(table(("e", "new")), store, "silver", "t", "k", 2)
    found = {r.k: r.v for r in store.read("silver", "t").collect()}
    assert found == {**{k: "rebuilt" for k in "abcd"}, "e": "new"}
