from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tallyroll.session import local_session  # noqa: E402
from tallyroll.sources.layer_store import LayerStore  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    session = local_session(
        "tests",
        "4",
        **{
            "spark.sql.warehouse.dir": str(folder / "warehouse"),
            "spark.sql.shuffle.partitions": "2",
            "spark.default.parallelism": "2",
            "spark.checkpoint.dir": str(folder / "shared"),
        },
    )
    yield session
    session.stop()


@pytest.fixture
def store(spark, tmp_path) -> LayerStore:
    return LayerStore(spark, str(tmp_path / "layers"))
