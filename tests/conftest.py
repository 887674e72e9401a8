from __future__ import annotations

import os

import pytest
from pyspark.sql import SparkSession

from hitwatch.session import build_session

SMALL = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def spark(tmp_path_factory) -> SparkSession:
    session = build_session(
        "tests",
        "local[4]",
        spark__driver__memory="4g",
        spark__sql__shuffle__partitions=4,
        spark__ui__showConsoleProgress="false",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small() -> str:
    return SMALL


@pytest.fixture
def lines(spark):
    """A one-column table of log lines."""

    def make(values):
        return spark.createDataFrame([(value,) for value in values], "value string")

    return make


@pytest.fixture(autouse=True)
def told(request):
    """Listeners hear all that a test's queries report before the next test adds its own."""
    session = request.getfixturevalue("spark") if "spark" in request.fixturenames else None
    yield
    if session:
        session.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(60_000)
