"""Every registered query against its SQL, over whole tables of the smallest scale."""

import os

import pytest

import __spark_entry__ as contract
from tests.oracle import TESTDATA, compare, connect
from weblens.catalogue.oracles import DAY as ORACLE_DAY
from weblens.catalogue.queries import DAY, QUERIES

SF_DIR = os.path.join(TESTDATA, os.environ.get("TEST_SF", "sf0.001"))

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables here")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    rows, problem = compare(spark, duck, SF_DIR, contract.queries()[name],
                            contract.oracle_sql()[name])
    assert not problem
    assert rows > 0


def test_registry():
    assert set(QUERIES) <= set(contract.queries())
    assert set(QUERIES) <= set(contract.oracle_sql()) <= set(contract.queries())
    assert ORACLE_DAY == DAY


def test_entry(spark):
    result = contract.entry(spark)
    assert result.columns == ["day", "city", "cmsId", "times", "times_rank"]
    assert result.count() > 0
