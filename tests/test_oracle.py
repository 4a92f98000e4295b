"""Every query with SQL against DuckDB, the others for rows and schema."""

import os

import pytest
from compare import compare, duck

from panelloom.catalog import load

FOLDER = os.environ.get("ORACLE_DIR", "/root/testdata/sf0.01")
REGISTRY = load()
ORDERED = sorted(REGISTRY.ORACLE)


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", ORDERED)
def test_query_matches_sql(spark, con, name):
    assert compare(spark, con, name, REGISTRY.QUERIES, REGISTRY.ORACLE, FOLDER) == []


def test_entry_runs(spark):
    import __spark_entry__ as entry
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
