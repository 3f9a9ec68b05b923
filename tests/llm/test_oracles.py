"""Queries of the training-data operators that SQL can express, against DuckDB."""

import pytest

from isoclime.llm import queries
from tests.oracle import compare, connect


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_matches_sql(spark, sf_dir, name):
    assert compare(connect(sf_dir), queries.queries()[name](spark, sf_dir), queries.oracle_sql()[name]) > 0


def test_one_query_for_each_operator():
    assert [int(n[2:].split("_")[0]) for n in queries.queries()] == list(range(1, 14))  # thirteen operators are dealt
