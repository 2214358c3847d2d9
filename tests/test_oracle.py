"""Every registered query against its check SQL, on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry_point
from compare import connect, differences

FOLDER = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
QUERIES = entry_point.queries()
ORACLES = entry_point.oracle_sql()


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, connection, name):
    frame = QUERIES[name](spark, FOLDER)
    if name in ORACLES:
        assert differences(frame, connection, ORACLES[name]) is None
    else:
        assert frame.count() > 0


def test_every_check_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0
