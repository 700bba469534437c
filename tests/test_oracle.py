"""Every named query against its SQL, over whole tables."""

import pytest

from registry.oracle import all_oracles
from registry.queries import all_queries
from tests.oracle_check import connect, difference

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(all_queries()) == set(all_oracles())


@pytest.mark.parametrize("name", sorted(all_oracles()))
def test_matches_sql(spark, db, name):
    problem = difference(spark, db, FOLDER, all_queries()[name], all_oracles()[name])
    # At the smallest scale a filter may leave nothing on both sides.
    assert problem in (None, "EMPTY")
