"""Every registered query against its SQL twin on the small tables."""

from __future__ import annotations

import compare
import pytest

from tradewind.plans.oracle import ORACLES
from tradewind.plans.queries import QUERIES


@pytest.fixture(scope="module")
def con(root):
    return compare.database(root)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, con, root, name):
    assert compare.difference(QUERIES[name](spark, root), con, ORACLES[name]) is None
