"""Every query against its SQL on the smallest tables."""

import pytest
from compare import connect, difference, spark_rows, sql_rows

from tidemark import queries as registered

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(registered.queries()))
def test_query(spark, connection, name):
    sql = registered.oracle_sql().get(name)
    result = spark_rows(registered.queries()[name](spark, SF_DIR))
    if sql is None:
        assert result[2]
    else:
        assert difference(result, sql_rows(connection, sql)) is None


def test_every_sql_belongs_to_a_query():
    assert set(registered.oracle_sql()) <= set(registered.queries())
