"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as contract
from check import compare, database

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return database(FOLDER)


def test_contract_shape(spark):
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert "post_deposit_txn" in contract.queries()
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query(spark, con, name):
    got = contract.queries()[name](spark, FOLDER).toPandas()
    sql = contract.oracle_sql().get(name)
    if sql is not None:
        assert compare(name, got, con.execute(sql).df()) == []
