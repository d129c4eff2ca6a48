"""What all queries share."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tapline.api import extract
from tapline.options import SESSION_TABLES, ConnectionOptions
from tapline.plans.profiles import Switches

Query = Callable[[SparkSession, str], DataFrame]

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
)


def register(spark: SparkSession, sf_dir: str, *queries: str) -> None:
    """The given tables that the queries name, as session tables under their own names."""
    words = set(re.findall(r"\w+", " ".join(queries)))
    for name in TABLES:
        if name in words:
            spark.read.parquet(f"{sf_dir}/{name}.parquet").createOrReplaceTempView(name)


def rows(spark: SparkSession, sf_dir: str, sql: str, profile: str, declared=None, switches=Switches()) -> DataFrame:
    """A query on the given tables under a type profile."""
    register(spark, sf_dir, sql)
    return extract(spark, ConnectionOptions(SESSION_TABLES, sql, profile), declared, switches)


def extraction(sql: str, profile: str, declared: dict[str, str] | None = None, switches=Switches()) -> Query:
    return lambda spark, sf_dir: rows(spark, sf_dir, sql, profile, declared, switches)
