"""Every registered query against its SQL counterpart in DuckDB."""

import pytest
from compare import differences, duckdb_over, plan_of
from conftest import SF_DIR

import __spark_entry__ as entry_module
from fixtures.queries import registered

# Monitor queries: no Python in the data path, no join of everything with everything.
UNWANTED = (
    "BatchEvalPython",
    "ArrowEvalPython",
    "MapInPandas",
    "FlatMapGroupsInPandas",
    "CartesianProduct",
    "NestedLoopJoin",
)
ORACLE = entry_module.oracle_sql()
MONITOR = set(registered())


@pytest.fixture(scope="module")
def con():
    return duckdb_over(SF_DIR)


@pytest.mark.parametrize("name", list(ORACLE))
def test_query_matches(spark, con, name):
    result = entry_module.queries()[name](spark, SF_DIR)
    found = differences(result, con, ORACLE[name])
    assert not found, found[:5]
    if name in MONITOR:
        plan = plan_of(result)
        assert not [bad for bad in UNWANTED if bad in plan]


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(entry_module.queries())


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
