import os

import pytest

import __spark_entry__ as contract
from oracle import difference, oracle
from siltbed.plans import bindings

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def duck():
    return oracle(SF)


def test_every_query_has_sql():
    assert bindings.QUERIES.keys() == bindings.ORACLE.keys()
    assert contract.queries().keys() >= bindings.QUERIES.keys()
    assert contract.queries().keys() >= contract.oracle_sql().keys()


def test_entry(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(bindings.QUERIES))
def test_equals_sql(spark, duck, name):
    assert difference(bindings.QUERIES[name](spark, SF), duck, bindings.ORACLE[name]) == ""
