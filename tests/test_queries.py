"""Every registered query against its SQL on the smallest shared tables."""

import os

import pytest

import compare
from wardgrid.workloads import ORACLES, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    return compare.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR)
    if name in ORACLES:
        assert compare.difference(result, duck, ORACLES[name]) is None
    else:
        assert result.count() > 0
