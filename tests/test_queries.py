import os

import pytest

import __spark_entry__ as registered
from workload.queries import QUERIES
from compare import oracle_connection, oracle_rows, spark_rows

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def oracle():
    return oracle_connection(SF_DIR)


def test_every_query_has_an_oracle():
    assert QUERIES.keys() <= registered.queries().keys()
    assert QUERIES.keys() <= registered.oracle_sql().keys()


@pytest.mark.parametrize("query", QUERIES)
def test_query_matches_its_oracle(spark, oracle, query):
    got = spark_rows(registered.queries()[query](spark, SF_DIR))
    expected = oracle_rows(oracle, registered.oracle_sql()[query])
    assert got == expected
    assert got[1], "an empty result checks nothing"


def test_entry(spark):
    df = registered.entry(spark)
    assert df.columns[-2:] == ["retention_added_at", "retention_expires_at"]
    assert df.count() > 0
