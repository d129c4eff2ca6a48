"""Every named query gives the rows of its SQL, on whole tables of the smallest scale."""

import pytest

import __spark_entry__ as entry
from tapline.catalogue import QUERIES, SQL
from tests.oracle import TESTDATA, difference, tables

SF = "0.001"


@pytest.fixture(scope="module")
def link():
    return tables(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, link, name):
    df = entry.queries()[name](spark, f"{TESTDATA}/sf{SF}")
    assert difference(df, link, entry.oracle_sql()[name]) is None


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["output_path", "num_records", "total_records", "current_timestamp_utc", "part_number"]
    assert sorted((r.part_number, r.num_records) for r in df.collect()) == [(0, 300), (1, 300), (2, 300), (3, 100)]


def test_jdbc_queries_need_a_shared_database_on_a_cluster(spark, monkeypatch):
    from tapline import ExtractionError
    from tapline.catalogue import sources

    monkeypatch.setattr(spark.sparkContext, "master", "spark://elsewhere:7077")
    with pytest.raises(ExtractionError, match="spark.tapline.jdbcUrl"):
        sources._url(spark)
