"""Every cube query against DuckDB on the smallest tables."""

import pytest

from cubelattice.plans import registry
from tests.parity import duck, same

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_matches_oracle(spark, con, name):
    assert same(registry.QUERIES[name](spark, SF), con, registry.ORACLES[name]) >= 0


def test_entry_has_rows(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0


def test_every_query_has_an_oracle():
    assert set(registry.QUERIES) == set(registry.ORACLES)
