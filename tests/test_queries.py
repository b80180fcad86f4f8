"""Every registered query agrees with its SQL form."""

import pytest

from __spark_entry__ import entry
from tests.check_oracle import compare, connect
from tests.conftest import SMALL
from tideline.plans.queries import ORACLES, QUERIES


@pytest.fixture(scope="session")
def con():
    return connect(SMALL)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    assert entry(spark).count() == 1100


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    # The smallest scale ends before the fixtures' bookmark, so a few results are empty on both sides there.
    assert compare(spark, con, name, QUERIES[name], ORACLES[name], SMALL) in ("", "no rows")
