from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from farewind.scratch import release  # noqa: E402
from farewind.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "farewind-tests",
        master="local[8]",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__driver__memory="8g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    release(session)
    session.stop()


@pytest.fixture
def no_broadcast(spark):
    """A function after which Spark shuffles every join, until the test ends."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    yield lambda: spark.conf.set(name, "-1")
    spark.conf.set(name, before)
