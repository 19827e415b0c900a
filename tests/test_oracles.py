"""Every registered query against its SQL statement on the smallest tables."""

import pytest

import __spark_entry__ as contract
import compare
import oracles
import workload

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return compare.connect(SF)


def test_every_query_has_an_oracle():
    assert set(workload.QUERIES) == set(oracles.ORACLES)


@pytest.mark.parametrize("name", sorted(workload.QUERIES))
def test_query_matches_oracle(spark, duck, name):
    assert compare.difference(contract.queries()[name](spark, SF), duck, contract.oracle_sql()[name]) is None
