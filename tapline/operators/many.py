"""Many tables in one go: each is an extraction of its own, several run at a time."""

from __future__ import annotations

from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession


RESULT_SCHEMA = "table_dir string, num_records bigint, error string"


def extract_many(spark: SparkSession, jobs: Iterable[dict] | DataFrame, at_once: int = 4, **common) -> DataFrame:
    """Run ``read_to_parquet`` for every job and return one row per job, in job order.

    A job is a dict of its arguments, or a row of a DataFrame with those as columns; ``common`` fills in what jobs
    leave out. A failing job is reported in its row and does not stop the others. With
    ``spark.scheduler.mode=FAIR`` the jobs share the cluster evenly, each in its own pool.
    """
    from tapline.api import read_to_parquet

    if isinstance(jobs, DataFrame):
        jobs = [{k: v for k, v in row.asDict().items() if v is not None} for row in jobs.collect()]
    jobs = [{**common, **job} for job in jobs]

    def run(job: dict) -> tuple[str, int | None, str | None]:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", job["table_dir"])
        try:
            return job["table_dir"], read_to_parquet(spark=spark, **job), None
        except Exception as err:  # one bad job, whatever is wrong with it, must not take the others along
            return job["table_dir"], None, str(err)

    with ThreadPoolExecutor(at_once) as pool:
        results = [pool.submit(inheritable_thread_target(spark)(run), job) for job in jobs]
        return spark.createDataFrame([r.result() for r in results], RESULT_SCHEMA)
