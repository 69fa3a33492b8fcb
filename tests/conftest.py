import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from leadflow.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "local[8]", 4, **{
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoint")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        })
    yield session
    session.stop()
