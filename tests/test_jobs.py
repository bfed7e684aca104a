from datetime import date, datetime, timedelta

import pytest

from clinic import MID, NEW, REASONS, extract, extracts
from tierlake.operators import quality as q
from tierlake.operators.entity import Run
from tierlake.plans import jobs, kpis
from tierlake.plans.entities import ENTITIES


def later(run, days):
    at = run.at + timedelta(days=days)
    return Run(f"{at:%Y%m%d}_000000_cafe000{days}", at, run.as_of)


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    """One full load of the dirty extracts, shared by the tests below."""
    from tierlake.sources.store import LayerStore

    run = Run("20020101_000000_cafe0001", datetime(2002, 1, 1), date(2002, 1, 1))
    settings = jobs.Settings(LayerStore(spark, str(tmp_path_factory.mktemp("lake"))), buckets=2)
    result = jobs.run_all(settings, extracts(spark), run)
    return settings, result, run


def test_full_run_conserves_rows(lake):
    settings, result, _ = lake
    for loaded, cleaned in zip(result.loaded, result.cleaned):
        assert loaded.rows_read == loaded.rows_bronze + loaded.rows_quarantined
        assert cleaned.rows_in == loaded.rows_bronze
        assert cleaned.rows_rejected == len(REASONS[cleaned.entity])
        assert cleaned.rows_in == cleaned.rows_superseded + cleaned.rows_silver + cleaned.rows_rejected
    assert jobs.quarantine_table(settings.store).count() == 8
    assert jobs.rejects_table(settings.store).count() == sum(len(r) for r in REASONS.values())


def test_full_run_passes_critical_checks_and_logs(lake):
    settings, result, run = lake
    rollup = {r.severity: r for r in q.by_severity(result.quality).collect()}
    assert rollup[q.CRIT].failed == 0 and rollup[q.CRIT].checks > 20
    assert {"Q-S13", "Q-S14"} & {c for r in rollup.values() for c in r.failed_checks}
    assert result.quality.where("check_id = 'Q-S08' AND passed").count() == 1
    logged = settings.store.read("ops", "data_quality_results")
    assert logged.count() == result.quality.count() and logged.where("evaluated_at IS NULL").count() == 0
    stages = {r.stage: r.status for r in settings.store.read("ops", "pipeline_runs").collect()}
    assert stages == {s: "success" for s in ("bronze", "silver", "quality", "gold", "pipeline")}


def test_gold_resolves_keys_and_hides_identifiers(lake):
    settings, _, _ = lake
    store = settings.store
    visits = store.read("gold", "fact_citas")
    assert visits.where("sk_paciente IS NULL").count() == 0
    assert visits.where("id_cita = 'c9'").first()["sk_especialidad"] is None
    assert not {"nombres", "apellidos", "numero_documento"} & set(store.read("gold", "dim_paciente").columns)


def test_summary_view_through_the_catalog(lake, spark):
    settings, _, _ = lake
    jobs.publish(settings)
    kpis.create_kpi_views(spark)
    row = spark.newSession().sql("SELECT * FROM gold.v_kpi_resumen WHERE anio = 2026 AND mes = 1").first()
    assert (row.total_citas, row.citas_atendidas, row.citas_canceladas, row.citas_no_asistencia) == (5, 2, 2, 1)
    assert row.tasa_asistencia == 0.4 and float(row.ingreso_neto) == 180 and float(row.ticket_promedio) == 60
    assert spark.sql("SELECT count(*) FROM silver.citas").first()[0] == 5
    assert "nombres" not in spark.table("gold.dim_paciente_bi").columns


def test_load_mode_is_checked(lake, spark):
    settings, _, run = lake
    with pytest.raises(ValueError):
        jobs.run_all(settings, extracts(spark), run, "partial")


def test_incremental_scenario(spark, store, run):
    settings = jobs.Settings(store, buckets=2)
    jobs.run_all(settings, extracts(spark), run, gold=False, check=False)
    silver = lambda: {r.id_cita: r.estado_cita for r in store.read("silver", "citas").collect()}
    before = silver()

    def again(days, **changed):
        sources = {**extracts(spark), **changed}
        result = jobs.run_all(settings, sources, later(run, days), jobs.INCREMENTAL, gold=False, check=False)
        return {r.entity: r for r in result.cleaned}

    # Nothing changed: nothing is read, nothing changes.
    assert {r.rows_in for r in again(1).values()} == {0}
    assert silver() == before

    # One update, one new row, two versions of another new row.
    updates = extract(
        spark,
        "citas",
        [
            {"id_cita": "c1", "estado_cita": "Cancelada", "actualizado_en": MID},
            {"id_cita": "n1", "actualizado_en": MID},
            {"id_cita": "n2", "estado_cita": "Programada", "actualizado_en": MID},
            {"id_cita": "n2", "estado_cita": "Atendida", "actualizado_en": NEW},
            {"id_cita": "n3", "id_paciente": "zz", "actualizado_en": NEW},
        ],
    )
    changed = again(2, citas=updates)
    assert (changed["citas"].rows_silver, changed["citas"].rows_rejected) == (3, 1)
    expected = {**before, "c1": "Cancelada", "n1": "Atendida", "n2": "Atendida"}
    assert silver() == expected

    # The same delivery again: idempotent.
    assert again(3, citas=updates)["citas"].rows_in == 0
    assert silver() == expected

    # A late row behind the mark is taken with a lookback, and never undoes news.
    late = extract(
        spark,
        "citas",
        [
            {"id_cita": "n4", "actualizado_en": MID},
            {"id_cita": "n2", "estado_cita": "Programada", "actualizado_en": MID},
        ],
    )
    again(4, citas=late)
    assert silver() == expected
    settings = jobs.Settings(store, buckets=2, lookback="60 days")
    again(5, citas=late)
    assert silver() == {**expected, "n4": "Atendida"}


def test_rerunning_a_batch_does_not_duplicate(spark, store, run):
    settings = jobs.Settings(store, buckets=2)
    jobs.run_all(settings, extracts(spark), run, gold=False, check=False)
    again = jobs.run_all(settings, extracts(spark), run, gold=False)
    assert {c.check_id: c.passed for c in again.quality.collect() if c.check_id.startswith(("Q-O03", "Q-B01"))} == {
        f"{check}-{s.name}": True for check in ("Q-O03", "Q-B01") for s in ENTITIES
    }
    unchanged = jobs.run_all(settings, extracts(spark), later(run, 1), jobs.INCREMENTAL, gold=False)
    assert unchanged.rows_in == 0
    assert sum(c.check_id.startswith("Q-O04") and c.passed for c in unchanged.quality.collect()) == 4
    assert jobs.quarantine_table(store).count() == 8
    assert jobs.rejects_table(store).count() == sum(len(r) for r in REASONS.values())
    assert store.read("silver", "citas").count() == 5


def test_critical_failure_stops_before_gold_and_is_logged(spark, store, run):
    settings = jobs.Settings(store, buckets=2, row_bands={"citas": (1000, 2000)})
    with pytest.raises(q.QualityError, match="Q-COUNT-citas"):
        jobs.run_all(settings, extracts(spark), run)
    assert not store.exists("gold", "fact_citas")
    last = store.read("ops", "pipeline_runs").where("stage = 'quality'").first()
    assert last.status == "failed" and "Q-COUNT-citas" in last.error_message


def test_reject_reset_does_not_depend_on_the_overwrite_mode(lake, spark, store, run):
    schema = jobs.rejects_table(lake[0].store)
    batch = {"_entity": "citas", "_batch_id": run.batch_id}
    store.replace_partition(schema.limit(2), "silver", "rejects", batch)
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        jobs.reset_rejects(store)
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert jobs.rejects_table(store).count() == 0


def test_late_parent_and_newly_invalid_version(spark, store, run):
    """An orphan is taken in when its parent arrives; a key whose newest version is invalid goes."""
    settings = jobs.Settings(store, buckets=2)
    jobs.run_all(settings, extracts(spark), run, gold=False, check=False)
    child = extract(spark, "citas", [{"id_cita": "x1", "id_paciente": "late", "actualizado_en": MID}])
    jobs.run_all(settings, {**extracts(spark), "citas": child}, later(run, 1), jobs.INCREMENTAL, gold=False, check=False)
    keys = lambda: {r.id_cita for r in store.read("silver", "citas").select("id_cita").collect()}
    assert "x1" not in keys() and "c1" in keys()
    parent = extract(spark, "pacientes", [{"id_paciente": "late", "actualizado_en": NEW}])
    broken = extract(spark, "citas", [{"id_cita": "c1", "id_paciente": "zz", "actualizado_en": NEW}])
    sources = {**extracts(spark), "pacientes": parent, "citas": broken}
    jobs.run_all(settings, sources, later(run, 2), jobs.INCREMENTAL, gold=False, check=False)
    assert "x1" in keys() and "c1" not in keys()


def test_missing_bronze_table_is_reported(spark, store, run):
    found = q.by_severity(q.all_results(jobs.bronze_results(jobs.Settings(store)))).collect()
    assert [r.failed_checks for r in found] == [[f"Q-B00-{n}" for n in sorted(s.name for s in ENTITIES)]]


def test_new_run_ids():
    run = jobs.new_run(datetime.fromisoformat("2026-01-01T01:00:00+02:00"))
    assert run.batch_id.startswith("20251231_230000_") and len(run.batch_id) == 24 and run.at.tzinfo is None


def test_stream_equals_batch(spark, store, run, tmp_path):
    from tierlake.plans.entities import BY_NAME
    from tierlake.sources.readers import text_schema
    from tierlake.streaming import upsert_arrivals

    spec, inbox = BY_NAME["citas"], str(tmp_path / "inbox")
    deliveries = [
        [{"id_cita": "a", "estado_cita": "Atendida", "actualizado_en": NEW}, {"id_cita": None}],
        [{"id_cita": "a", "estado_cita": "Programada", "actualizado_en": MID}, {"id_cita": "b"}],
    ]
    for rows in deliveries:
        extract(spark, "citas", rows).coalesce(1).write.mode("append").parquet(inbox)
        stream = spark.readStream.schema(text_schema(spec.columns)).parquet(inbox)
        upsert_arrivals(stream, spec, store, run, str(tmp_path / "ck"), "inbox", 2).awaitTermination()
    found = {r.id_cita: r.estado_cita for r in store.read("bronze", "citas").collect()}
    assert found == {"a": "Atendida", "b": "Atendida"}
    assert jobs.quarantine_table(store).count() == 1
