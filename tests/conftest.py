from __future__ import annotations

import datetime as dt
import os

import pytest

from tests.oracle import connect
from tidemark.session import build_session
from tidemark.sinks.store import Store

SF_DIR = os.environ.get("TIDEMARK_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.default.parallelism": "2",
            "spark.ui.enabled": "false",
            # tiny inputs: compiling a plan would take longer than running it
            "spark.sql.codegen.wholeStage": "false",
            "spark.sql.codegen.factoryMode": "NO_CODEGEN",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoint")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sql():
    return connect(SF_DIR)


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "store"))


@pytest.fixture
def at():
    """A clock that moves one hour per load."""

    def moment(n: int) -> dt.datetime:
        return dt.datetime(2024, 1, 1) + dt.timedelta(hours=n)

    return moment


def rows(df, *columns):
    """Rows as a sorted list of tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
