"""Every registered query against its SQL counterpart on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from compare import connect, difference
from __spark_entry__ import QUERIES

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def database():
    connection = connect(FOLDER)
    yield connection
    connection.close()


def test_registry_is_complete(spark):
    assert set(entry.oracle_sql()) <= set(entry.queries())
    # The corpus queries, where present, have tests of their own.
    assert set(QUERIES) <= set(entry.queries())
    assert set(QUERIES) - set(entry.oracle_sql()) == {"file_manifest"}
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, database, name):
    found = entry.queries()[name](spark, FOLDER).toPandas()
    if name in entry.oracle_sql():
        assert difference(found, database.execute(entry.oracle_sql()[name]).df()) is None
    else:
        assert len(found) > 0
