"""Every query against its SQL on the smallest tables."""

import pytest
from oracle import connect, differences

from ridgeline.workloads import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_agrees(spark, con, name):
    assert differences(QUERIES[name](spark, SF), con, ORACLES[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() == 1
    assert set(e.oracle_sql()) <= set(e.queries())
