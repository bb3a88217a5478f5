"""Queries against their SQL counterparts on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
import check_oracles

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables not present")


@pytest.fixture(scope="module")
def db():
    return check_oracles.connect(FOLDER)


@pytest.mark.parametrize("name", sorted(set(entry.queries()) & set(entry.oracle_sql())))
def test_query_matches_sql(spark, db, name):
    assert check_oracles.compare(spark, db, FOLDER, name)[1] == "match"


def test_entry(spark):
    assert entry.entry(spark).count() == 1
