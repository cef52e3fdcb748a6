"""One local session for all tests."""

from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tidemark.session import build_session

    session = build_session(
        "tidemark-tests", "local[8]", spark__sql__shuffle__partitions=8, spark__ui__enabled="false",
        spark__driver__memory="8g", spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tables(spark):
    from tidemark.catalog.base import Tables

    return Tables(spark, SF)


@pytest.fixture
def rows(spark):
    """Rows of a frame as sorted tuples."""
    def read(df, *columns):
        df = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((v is None, str(v)) for v in r))

    return read
