"""Every registered query against its oracle on the smallest supplied tables."""

from pathlib import Path

import pytest

import __spark_entry__ as contract
from catalogue.registry import ORACLES, QUERIES
from tests.oracle import connect, difference

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).is_dir(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_its_oracle(spark, duck, name):
    assert difference(spark, duck, SF_DIR, QUERIES[name], ORACLES[name]) is None


def test_entry(spark):
    assert not contract.entry(spark).isEmpty()
