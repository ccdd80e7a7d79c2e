"""Every registered query against its SQL."""

import os

import pytest

import __spark_entry__
from compare import connect, differences

DIRECTORY = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = __spark_entry__.queries(), __spark_entry__.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(DIRECTORY)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    result = QUERIES[name](spark, DIRECTORY)
    if name in ORACLES:
        assert differences(result, con, ORACLES[name]) == ""
    else:
        assert result.count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() == 1
