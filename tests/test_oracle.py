"""Every registered query against its SQL twin."""

import pytest
from oracle_check import database, difference

from __spark_entry__ import oracle_sql

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return database(FOLDER)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_agrees_with_sql(spark, connection, name):
    assert difference(spark, connection, name, FOLDER) is None
