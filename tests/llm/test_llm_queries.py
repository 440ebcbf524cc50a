"""Queries that SQL can express, against their SQL on the given tables."""

import os

import pytest

from oracle import difference, oracle
from siltbed.llm import queries

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    return oracle(SF)


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_equals_sql(spark, duck, name):
    assert difference(queries.QUERIES[name](spark, SF), duck, queries.ORACLE[name]) == ""
