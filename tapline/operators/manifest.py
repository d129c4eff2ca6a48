"""The manifest: one CSV line per part, and the checks that can be made with it."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

# Header and column order of the file.
HEADER = "OUTPUT_PATH,NUM_RECORDS,TOTAL_RECORDS,CURRENT_TIMESTAMP_UTC,PART_NUMBER"
SCHEMA = (
    "output_path string, num_records bigint, total_records bigint, current_timestamp_utc bigint, part_number int"
)

# Manifest rows that one task sums up at a time.
_BLOCK = 10_000


def lines(table_dir: str, total_size: int, files: Iterable) -> Iterator[str]:
    """Header and rows for the parts of one folder, in part order."""
    yield HEADER
    for number, part in enumerate(files):
        yield f"{table_dir},{part.rows},{total_size},{part.written_millis},{number}"


def read_manifest(spark: SparkSession, *files: str) -> DataFrame:
    return spark.read.schema(SCHEMA).option("header", "true").csv(list(files))


def progress(manifest: DataFrame) -> DataFrame:
    """Rows written so far after each part of a folder, and their share of the expected total.

    Sums run in blocks of parts, and block totals are added on top, so that no task sees a whole long manifest.
    """
    block = F.floor(F.col("part_number") / _BLOCK).cast("int")
    parts = manifest.withColumn("block", block)
    before = Window.partitionBy("output_path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (
        parts.groupBy("output_path", "block").agg(F.sum("num_records").alias("block_rows"))
        .select("output_path", "block", F.coalesce(F.sum("block_rows").over(before), F.lit(0)).alias("earlier"))
    )
    within = Window.partitionBy("output_path", "block").orderBy("part_number").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return (
        parts.join(blocks, ["output_path", "block"])
        .withColumn("records_so_far", F.col("earlier") + F.sum("num_records").over(within))
        .select(
            "output_path", "part_number", "num_records", "records_so_far",
            (F.col("records_so_far") / F.nullif(F.col("total_records"), F.lit(0))).alias("progress"),
        )
    )


def reconcile(manifest: DataFrame) -> DataFrame:
    """Per folder: parts, rows written, rows expected, and whether they agree."""
    return manifest.groupBy("output_path").agg(
        F.count(F.lit(1)).alias("parts"),
        F.sum("num_records").alias("num_records"),
        F.max("total_records").alias("total_records"),
        (F.sum("num_records") == F.max("total_records")).alias("complete"),
    )
