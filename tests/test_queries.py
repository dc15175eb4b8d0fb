"""Every registered query against its SQL twin."""

import compare
import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return compare.connect(FOLDER)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, con, name):
    problem, rows, _ = compare.compare(spark, con, FOLDER, name)
    assert problem is None
    assert rows >= 0


def test_entry(spark):
    assert entry.entry(spark).limit(1).count() == 1


def test_sql_only_for_registered_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())
