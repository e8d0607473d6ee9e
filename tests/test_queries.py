"""Every bound query against its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as entry
from cabstand import catalog
from check_queries import compare, connect
from tests.support import plan_of

# No Python per row, no pairing of everything with everything, no window in one task.
BANNED = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas")
SQL = catalog.oracle_sql()


@pytest.fixture(scope="module")
def connection(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(spark, sf, connection, name):
    frame = catalog.queries()[name](spark, sf)
    plan = plan_of(frame)
    assert [node for node in BANNED if node in plan] == []
    if name not in SQL:
        assert frame.count() > 0
        return
    _, differences = compare(frame, connection, SQL[name])
    assert differences == []


def test_every_sql_has_its_query():
    assert set(SQL) <= set(catalog.queries())


def test_entry_runs(spark):
    frame = entry.entry(spark)
    assert frame.columns and frame.limit(1).count() >= 0
