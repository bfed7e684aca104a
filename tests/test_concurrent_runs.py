"""Jobs that run at once: order, errors, and the writes that a run makes."""

import threading

import pytest

from clinic import extracts
from tierlake.operators.watermark import Watermarks
from tierlake.plans import jobs
from tierlake.plans.entities import ENTITIES
from tierlake.sources.concurrent import side_by_side


def test_actions_run_at_once_and_results_keep_their_order(spark):
    together = threading.Barrier(3, timeout=60)

    def action(n):
        def act():
            together.wait()
            return spark.range(n).count()

        return act

    assert side_by_side(action(n) for n in (3, 1, 2)) == [3, 1, 2]


def test_an_error_is_raised_after_all_actions_ended(spark):
    ended = []

    def fails():
        raise ValueError("first")

    with pytest.raises(ValueError, match="first"):
        side_by_side([fails, lambda: ended.append(spark.range(5).count())])
    assert ended == [5]


def test_marks_of_a_layer_move_in_one_write(spark, store, run, monkeypatch):
    written = []
    write = Watermarks._write
    monkeypatch.setattr(Watermarks, "_write", lambda self, rows: (written.append(1), write(self, rows)))
    settings = jobs.Settings(store, buckets=2)
    results = jobs.run_bronze(settings, extracts(spark), run)
    assert [r.entity for r in results] == [s.name for s in ENTITIES]
    assert len(written) == 2  # the seed, and all marks of bronze
    assert all(settings.marks.get("bronze", r.entity) == r.reached.ljust(20, ".").ljust(26, "0") for r in results)
