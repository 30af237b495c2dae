"""Every registered query against its SQL twin on the smallest tables."""

import pytest

import __spark_entry__ as contract
import suite.current  # noqa: F401
import suite.learning  # noqa: F401
from suite.compare import connect, differences
from suite.registry import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    problem, rows = differences(spark, con, SF_DIR, name)
    assert problem is None
    assert rows > 0 or "search" in name  # few flights match at this size


def test_entry_is_lazy_and_stable(spark):
    first = contract.entry(spark)
    assert first.schema == contract.entry(spark).schema and first.count() > 0


def test_every_oracle_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_every_query_here_has_an_oracle():
    assert set(QUERIES) <= set(contract.oracle_sql()) and set(QUERIES) <= set(contract.queries())
