"""Every registered query against its SQL, or at least for rows, on the smallest data set."""

import pytest
from check import compare, connect

from tessera.plans.queries import CHECKS, QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_matches_sql(spark, sf_dir, duck, name):
    assert compare(duck, QUERIES[name](spark, sf_dir), CHECKS[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(CHECKS)))
def test_has_rows(spark, sf_dir, name):
    assert not QUERIES[name](spark, sf_dir).isEmpty()
