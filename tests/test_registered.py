import pytest

import check_oracle
from __spark_entry__ import entry, oracle_sql, queries

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return check_oracle.connect(FOLDER)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_equals_its_sql(spark, connection, name):
    verdict = check_oracle.compare(spark, connection, name, FOLDER)
    assert not verdict.startswith("FAIL"), verdict


def test_contract(spark):
    assert set(oracle_sql()) <= set(queries())
    assert entry(spark).count() == 1
