"""Every registered query against its oracle on the smallest data."""

import pytest

from __spark_entry__ import entry
from checks import registry
from checks.run import compare
from tests.conftest import SMALL


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_matches_oracle(spark, con, name):
    ok, note, _, _ = compare(spark, con, SMALL, name, registry.QUERIES[name], registry.ORACLES.get(name))
    assert ok, note


def test_entry_has_rows(spark):
    assert entry(spark).count() > 0


def test_every_query_has_an_oracle():
    assert set(registry.QUERIES) == set(registry.ORACLES)
