"""Every registered query against its SQL, at two scales."""

from __future__ import annotations

import pytest

import __spark_entry__
from compare import connect, mismatch
from ledgerline.plans import oracles, queries as plans

QUERIES = plans.QUERIES
ORACLES = oracles.ORACLES


@pytest.fixture(scope="module", params=["sf0.001", "sf0.01"])
def scale(request):
    sf_dir = f"/root/testdata/{request.param}"
    return sf_dir, connect(sf_dir)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, scale, name):
    sf_dir, con = scale
    assert mismatch(QUERIES[name](spark, sf_dir), con, ORACLES[name]) is None


def test_entry(spark):
    assert __spark_entry__.entry(spark).columns == ["rec_group", "records", "published", "processed", "matched"]
