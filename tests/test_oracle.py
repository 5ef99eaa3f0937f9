import pytest
from compare import assert_same, connect
from conftest import TESTDATA

import __spark_entry__ as entry_points
from tidemark.examples.oracle import ORACLE
from tidemark.examples.queries import QUERIES

SF_DIR = str(TESTDATA / "sf0.01")


@pytest.fixture(scope="module")
def db():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLE.keys()
    assert QUERIES.keys() <= entry_points.queries().keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    df = entry_points.queries()[name](spark, SF_DIR)
    assert_same(df, db, entry_points.oracle_sql()[name])


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
