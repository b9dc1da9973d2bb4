"""Every named query against its SQL counterpart at the smallest scale."""

import pytest

from check import compare, duck
from commerce_lens.catalog.oracle import oracle_statements
from commerce_lens.catalog.queries import named_queries
from tests.conftest import SMALL

STATEMENTS = oracle_statements()


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


def test_every_query_has_a_counterpart():
    assert set(named_queries()) == set(STATEMENTS)


@pytest.mark.parametrize("name", sorted(named_queries()))
def test_matches_sql(spark, con, name):
    same, note = compare(spark, con, SMALL, name, STATEMENTS[name])
    assert same, note
