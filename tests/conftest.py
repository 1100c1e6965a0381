"""One local session for all tests."""

from __future__ import annotations

import os

import pytest

from gaugeline.operators.stage import clear_stages
from gaugeline.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "gaugeline-tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
            # Plans are asserted on, so nothing in them may be abbreviated.
            "spark.sql.maxMetadataStringLength": "10000",
            "spark.sql.debug.maxToStringFields": "1000",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    clear_stages(session)
    session.stop()


@pytest.fixture(scope="session")
def sf_dir() -> str:
    return os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def tiny_dir() -> str:
    return "/root/testdata/sf0.001"
