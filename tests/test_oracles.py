"""Every registered query of the library against its SQL counterpart."""

import pytest

from isoclime.plans import registry
from tests.oracle import compare, connect

QUERIES, ORACLES = registry.queries(), registry.oracle_sql()
MAY_BE_EMPTY = {"e13_point_in_time_audit"}


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, sf_dir, con, name):
    assert compare(con, QUERIES[name](spark, sf_dir), ORACLES[name]) or name in MAY_BE_EMPTY


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql_gives_rows(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
