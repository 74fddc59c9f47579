"""Every registered query against its SQL on the sample tables."""

import pytest

from compare import assert_same, connect
from gristmill.expected import oracle_sql
from gristmill.registry import queries


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert set(queries()) == set(oracle_sql())


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_equals_sql(name, spark, sf_dir, duck):
    assert assert_same(queries()[name](spark, sf_dir), duck, oracle_sql()[name]) > 0
