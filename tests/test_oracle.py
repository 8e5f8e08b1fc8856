"""Every registered query against its SQL on the same files."""

import pytest

from tests.oracle import connect, differences
from tidemark import checks

checks.load()


@pytest.fixture(scope="module")
def oracle(sf_dir):
    return connect(sf_dir)


def test_every_query_has_an_oracle():
    assert set(checks.QUERIES) == set(checks.ORACLES)


@pytest.mark.parametrize("name", sorted(checks.QUERIES))
def test_query(spark, sf_dir, oracle, name):
    found = differences(checks.QUERIES[name](spark, sf_dir), oracle, checks.ORACLES[name])
    assert found is None, found
