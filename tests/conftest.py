from __future__ import annotations

import os
import shutil
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from waymark.session import build_session  # noqa: E402

TESTDATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark():
    folder = tempfile.mkdtemp(prefix="waymark-tests-")
    session = build_session(
        "waymark-tests", master="local[*]",
        **{"spark.checkpoint.dir": folder, "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "4g", "spark.ui.showConsoleProgress": "false"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
    shutil.rmtree(folder, ignore_errors=True)


@pytest.fixture(scope="session")
def sf():
    return f"{TESTDATA}/sf0.001"


@pytest.fixture
def nothing_fits(monkeypatch):
    """Every dimension too large to broadcast, and every key with more than two rows hot."""
    from waymark.operators import joins

    monkeypatch.setattr(joins, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(joins, "ROWS_PER_TASK", 2)
