import sys
from datetime import date, datetime
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tierlake.operators.entity import Run
from tierlake.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        4,
        "tierlake-tests",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def run():
    return Run("20020101_000000_cafe0001", datetime(2002, 1, 1), date(2002, 1, 1))


@pytest.fixture
def store(spark, tmp_path):
    from tierlake.sources.store import LayerStore

    return LayerStore(spark, str(tmp_path / "lake"))


@pytest.fixture
def staging(spark):
    from tierlake.sources.staging import Staging

    with Staging(spark) as kept:
        yield kept
