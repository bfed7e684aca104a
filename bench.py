"""Times headline queries; prints one JSON line.

Whole runs (a full load, increments, a stream, the quality report) are timed once, cold.

``BENCH_SF_DIR`` is the folder of driver tables and ``BENCH_CPUS`` the local core count. Each
query is computed in full (to Spark's no-op sink), once to warm up and then three times; the
median counts. The layers that reports read are built first and timed once, cold, on their own.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from tierlake.plans.chain import chain
from tierlake.plans.queries import QUERIES
from tierlake.session import local_session

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = 3

HEADLINES = (
    "lineage_and_row_hash",
    "clean_facturacion",
    "latest_facturacion",
    "rejects_by_reason",
    "orphan_appointments",
    "incremental_rows",
    "dim_document_numbers",
    "patient_history",
    "upsert_appointments",
    "kpi_monthly_summary",
    "kpi_appointment_operations",
    "kpi_billing_monthly",
    "kpi_rates_by_month_and_site",
    "kpi_appointment_reach",
    "kpi_documented_appointments",
    "kpi_billing_per_attended_appointment",
    "kpi_mean_age_by_specialty",
    "profile_cardinality",
    "profile_duplicates",
    "profile_integrity",
)


WHOLE_RUNS = ("job_full_load_rows", "job_quality_report", "job_incremental_runs", "streamed_appointments")


def seconds(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def main() -> None:
    spark = local_session(CPUS, "tierlake-bench")
    spark.sparkContext.setLogLevel("ERROR")
    layers = chain(spark, FOLDER)
    timings: dict[str, float] = {}
    entities = ("pacientes", "citas", "eventos_clinicos", "facturacion")
    timings["build_bronze"] = seconds(lambda: [layers.loaded(e) for e in entities])
    timings["build_silver"] = seconds(lambda: [layers.tagged(e) for e in entities])
    timings["build_gold"] = seconds(lambda: [layers.fact(e) for e in entities[1:]])
    for name in HEADLINES:
        run = lambda: QUERIES[name](spark, FOLDER).write.format("noop").mode("overwrite").save()  # noqa: B023,E731
        run()
        timings[name] = statistics.median(seconds(run) for _ in range(RUNS))
    for name in WHOLE_RUNS:
        timings[name] = seconds(
            lambda: QUERIES[name](spark, FOLDER).write.format("noop").mode("overwrite").save()  # noqa: B023
        )
    rounded = {name: round(value, 3) for name, value in timings.items()}
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": rounded,
                "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
                "cpus": CPUS,
                "spark": spark.version,
            }
        )
    )
    layers.staging.release()
    spark.stop()


if __name__ == "__main__":
    main()
