"""Every query against its SQL at the smallest scale.

Queries that run whole pipelines are left to the tests of those pipelines.
"""

import compare
import pytest

import __spark_entry__ as contract
from viewlake.suite import oracle, queries

SF = "/root/testdata/sf0.001"
LONG = {
    "scan_landing_lines", "line_lineage", "scan_raw_events", "route_valid",
    "replay_idempotent", "stream_incremental", "table_row_counts",
}


@pytest.fixture(scope="module")
def duck():
    return compare.connect(SF)


def test_every_query_has_sql():
    assert set(queries.queries()) == set(oracle.oracle_sql())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", [n for n in queries.queries() if n not in LONG])
def test_query(spark, duck, name):
    frame = contract.queries()[name](spark, SF)
    assert compare.difference(frame, duck, contract.oracle_sql()[name]) == ""


def test_entry(spark):
    assert contract.entry(spark).limit(1).count() == 1
