"""Every registered query against its SQL, on the smallest data."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_point
from tidemark.checks.registry import ORACLES, QUERIES
from verify import compare, connect

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(DATA)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    verdict, _ = compare(spark, con, DATA, name)
    assert verdict.startswith("ok"), verdict


def test_entry_has_rows(spark):
    assert entry_point.entry(spark).count() > 0


def test_every_query_has_an_oracle():
    assert set(ORACLES) == set(QUERIES)
