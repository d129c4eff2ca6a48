"""Where rows come from: a database through JDBC, or the session's own tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tapline.options import ConnectionOptions
from tapline.sources import jdbc


def one_statement(query: str) -> str:
    """The query text, untouched but for blanks around it and one semicolon at its end."""
    text = query.strip()
    return text[:-1].rstrip() if text.endswith(";") else text


def read(spark: SparkSession, conn: ConnectionOptions) -> DataFrame:
    """The query result as a lazy DataFrame; the schema is known before any row is read."""
    query = one_statement(conn.query)
    if conn.reads_session_tables:
        return spark.sql(query)
    return jdbc.read(spark, conn, query)
