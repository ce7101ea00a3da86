"""Every registered query against its SQL, on the smallest scale factor."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_point
from compare import DATA, database, difference

SF = f"{DATA}/sf0.001"
QUERIES, ORACLE = entry_point.queries(), entry_point.oracle_sql()


@pytest.fixture(scope="module")
def tables():
    return database(SF)


def test_no_sql_without_its_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_agrees_with_sql(spark, tables, name):
    found = QUERIES[name](spark, SF).toPandas()
    assert len(found) > 0
    assert difference(found, tables.execute(ORACLE[name]).df()) is None


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0
