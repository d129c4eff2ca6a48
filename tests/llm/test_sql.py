"""Operators that SQL can express, against DuckDB on the same tables."""

import duckdb
import pytest

from tapline.llm.queries import QUERIES, SQL
from tests.oracle import difference

DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql(spark, name):
    link = duckdb.connect()
    for table in ("documents", "benchmark", "conversations"):
        link.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DIR}/{table}.parquet'")
    assert difference(QUERIES[name](spark, DIR), link, SQL[name]) is None
