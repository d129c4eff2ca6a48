"""Session lookup and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

def current_session(spark: SparkSession | None = None) -> SparkSession:
    return spark or SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the cluster names, else one below the warehouse, which the driver and all executors see."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/tapline-scratch"


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A new folder name under the scratch root; nothing is created."""
    return f"{scratch_root(spark)}/tapline-{label}-{uuid.uuid4().hex}"
