"""Every registered query against its SQL check, at the smallest scale."""

import os

import pytest

from workloads.catalogue import QUERIES
from workloads.checks import CHECKS
from workloads.compare import connect, difference

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def connection():
    with connect(SF_DIR) as opened:
        yield opened


def test_every_query_has_a_check():
    assert set(QUERIES) == set(CHECKS)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_check(spark, connection, name):
    assert difference(spark, connection, name, SF_DIR) is None
