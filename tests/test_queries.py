"""Every catalogued query against its SQL twin on the same files, or for rows where it has none."""

import pytest

import __spark_entry__ as entry
from sonde.catalog import QUERIES
from tests.compare import connect, differences

FOLDER = "/root/testdata/sf0.001"
ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    frame = entry.queries()[name](spark, FOLDER)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    if name in ORACLES:
        assert differences(frame, ORACLES[name], con) == []
    else:
        assert frame.count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() == 1000
