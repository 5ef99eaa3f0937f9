"""Operators that SQL can say, against DuckDB over the test tables."""

import pytest
from compare import assert_same, connect
from conftest import TESTDATA

from tidemark.llm.queries import ORACLE, QUERIES

SF_DIR = str(TESTDATA / "sf0.01")


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, name):
    db = connect(SF_DIR)
    db.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF_DIR}/documents.parquet')")
    assert_same(QUERIES[name](spark, SF_DIR), db, ORACLE[name])
