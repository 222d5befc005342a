"""Every query against its SQL twin, value by value."""

import os

import pytest

from compare import connect, differences, duck_rows, spark_rows
from oracle import statements
from packhouse.plans.registry import queries

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SQL = statements()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_statement_has_a_query():
    assert set(SQL) <= set(queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, con, name):
    assert differences(spark_rows(queries()[name](spark, SF)), duck_rows(con, SQL[name])) == []
