"""Every registered query against its SQL twin on the smallest tables."""

import pytest

import __spark_entry__ as contract
from checks.compare import compare, connect
from checks.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
# On the smallest tables these have nothing to report.
MAY_BE_EMPTY = {"last_watermark"}


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    problem = compare(spark, duck, SF, name)
    assert problem is None or (problem == "no rows" and name in MAY_BE_EMPTY)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    rows = contract.entry(spark).collect()
    assert rows and set(rows[0].asDict()) == {"customer_id", "channel", "reasoning", "issue_status"}
    assert contract.oracle_sql().keys() <= contract.queries().keys()
