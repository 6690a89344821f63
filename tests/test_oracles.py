"""Every registered query against its oracle on the smallest driver tables."""

from pathlib import Path

import pytest
from compare import compare, connect

import __spark_entry__ as entry
from fixtrail.checks import load

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="driver tables are not here")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(load()[0]))
def test_same_rows_as_oracle(spark, con, name):
    problem, _ = compare(spark, con, entry.queries()[name], entry.oracle_sql()[name], SF_DIR)
    assert problem is None


def test_every_query_has_an_oracle():
    queries, oracles = load()
    assert set(queries) == set(oracles)
    assert set(queries) <= set(entry.queries())


def test_flagship_returns_rows(spark):
    assert entry.entry(spark).count() > 0
