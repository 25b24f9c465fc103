"""Every registered query against its SQL on a small scale."""

import os

import pytest

import __spark_entry__ as book
from querybook.book import ORACLES, QUERIES
from tests.compare import duck, mismatch

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def connection():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, connection, name):
    frame = QUERIES[name](spark, SF_DIR)
    if name in ORACLES:
        assert mismatch(frame, connection, ORACLES[name]) is None
    else:
        assert frame.count() > 0


def test_entry(spark):
    assert book.entry(spark).count() > 0
