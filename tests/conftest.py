from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from riskweave.session import build_session  # noqa: E402

TABLES = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", cores=8, **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "6g"})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tables():
    return TABLES
