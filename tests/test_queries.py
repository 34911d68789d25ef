"""All registered queries against the check engine on the smallest test tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_points
from ordermill.fixtures import oracle
from ordermill.fixtures.queries import queries
from compare import differences, oracle_connection, plan_of
from conftest import SF_DIR


@pytest.fixture(scope="module")
def connection():
    return oracle_connection(SF_DIR)


def test_every_query_has_its_sql():
    assert set(queries()) == set(oracle.oracle_sql())
    assert set(queries()) <= set(entry_points.queries())
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, connection, name):
    df = queries()[name](spark, SF_DIR)
    assert differences(df, connection, oracle.oracle_sql()[name]) == []
    plan = plan_of(df)
    for operator in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin", "CollectLimit"):
        assert operator not in plan


def test_entry(spark):
    assert [row.country for row in entry_points.entry(spark).collect()] != []
