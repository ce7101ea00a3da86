from __future__ import annotations

import tempfile

import pytest

from compare import session


@pytest.fixture(scope="session")
def spark():
    spark = session()
    yield spark
    spark.stop()


@pytest.fixture
def folder():
    """A new folder for each test."""
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


@pytest.fixture
def rows(spark):
    """rows("a int, b string", (1, "x"), ...) -> DataFrame"""
    return lambda schema, *data: spark.createDataFrame(list(data), schema)
