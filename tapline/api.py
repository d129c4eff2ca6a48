"""The two calls a user makes, and their DataFrame forms."""

from __future__ import annotations

import warnings
from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from tapline.errors import as_extraction_error
from tapline.operators.json_rows import MAX_BYTES, rows_as_dicts
from tapline.operators.parts import Result, write_parts
from tapline.operators.store import Store
from tapline.options import (
    DEFAULT_BATCH_SIZE, JSON_BATCH_SIZE, ConnectionOptions, ExtractOptions, Split,
)
from tapline.plans.layout import Order
from tapline.plans.profiles import ALL_ROWS, Switches, normalise
from tapline.session import current_session, scratch_folder
from tapline.sources import jdbc, one_statement, read

# What an empty result leaves behind, by datasource type.
EMPTY_POLICY = {"POSTGRES": "none", "ODBC": "file", "ORACLE": "file"}


def _names(columns: str | Sequence[str] | None) -> tuple[str, ...]:
    return (columns,) if isinstance(columns, str) else tuple(columns or ())


def extract(
    spark: SparkSession,
    conn: ConnectionOptions,
    declared: dict[str, str] | None = None,
    switches: Switches = Switches(),
    cuts: Observation | None = None,
) -> DataFrame:
    """The query result under its type profile, lazily. ``cuts`` gets the counts of values that max_text_len cuts."""
    return _profiled(read(spark, conn), conn, declared, switches, cuts)


def _profiled(df: DataFrame, conn: ConnectionOptions, declared, switches: Switches, cuts: Observation | None) -> DataFrame:
    return normalise(df, conn.datasource_type, declared, switches, cuts)


def with_date_folders(df: DataFrame, date_column: str) -> tuple[DataFrame, tuple[str, ...]]:
    """Add year, month and day columns, as texts, that name the folder of each row; rows without a date share one."""
    no_date = F.lit("__HIVE_DEFAULT_PARTITION__")
    patterns = {"year": "yyyy", "month": "MM", "day": "dd"}
    for name, pattern in patterns.items():
        df = df.withColumn(name, F.coalesce(F.date_format(F.col(date_column).cast("date"), pattern), no_date))
    return df, tuple(patterns)


def extract_to_parquet(
    spark: SparkSession,
    conn: ConnectionOptions,
    options: ExtractOptions,
    declared: dict[str, str] | None = None,
    switches: Switches = Switches(),
    date_column: str | None = None,
    stage: bool | None = None,
    resume_dir: str | None = None,
) -> Result:
    """Read, normalise, write.

    An ordered write reads its rows more than once. ``stage`` writes the result to the scratch folder first, so that
    the source answers the query once; that is the default for databases and for queries that are not deterministic,
    and worth asking for where the query joins or aggregates. With max_text_len the result is always staged: that run
    counts the values that are cut.

    ``resume_dir`` names a folder for the rows as they come from the database, range by range. After a failure the same call
    reads only the ranges that are not in it. It is removed once the result is written.
    """
    if options.order_by and not conn.reads_session_tables and conn.split is None:
        conn = conn.with_split(Split(column=Order.of(options.order_by[0], ()).name)) if _splittable(spark, conn, options) else conn
    cuts = Observation() if switches.max_text_len else None
    if resume_dir and not conn.reads_session_tables:
        df = _profiled(jdbc.read_in_ranges(spark, conn, one_statement(conn.query), resume_dir), conn, declared, switches, cuts)
        stage = bool(stage)
    else:
        df = extract(spark, conn, declared, switches, cuts)
    staged = None
    if cuts is not None:
        stage = True
    if stage is None:
        repeatable = conn.reads_session_tables and df._jdf.queryExecution().analyzed().deterministic()
        stage = bool(options.order_by) and not repeatable
    if stage:
        staged = scratch_folder(spark, "staged")
        schema = df.schema
        df.write.parquet(staged)
        df = spark.read.schema(schema).parquet(staged)
    try:
        if date_column:
            df, folders = with_date_folders(df, date_column)
            options = replace(options, dir_columns=folders)
        counts = cuts.get if cuts is not None else {}
        result = replace(write_parts(df, options), cut={c: n for c, n in counts.items() if c != ALL_ROWS})
        if resume_dir:
            Store(spark, resume_dir).delete(resume_dir)
        return result
    finally:
        if staged:
            Store(spark, staged).delete(staged)


def _splittable(spark: SparkSession, conn: ConnectionOptions, options: ExtractOptions) -> bool:
    """Whether the first order key is of a type that a JDBC read can be cut along."""
    name = Order.of(options.order_by[0], ()).name
    field = next((f for f in read(spark, conn).schema.fields if f.name == name), None)
    return field is not None and field.dataType.typeName() in (
        "byte", "short", "integer", "long", "decimal", "date", "timestamp", "timestamp_ntz"
    )


def read_to_parquet(
    connection_string: str,
    query: str,
    base_dir: str,
    table_dir: str,
    log_dir: str,
    total_size: int,
    datasource_type: str,
    batch_size: int | None = None,
    user_name: str | None = None,
    password: str | None = None,
    encryption_key: str | None = None,
    prefix: str | None = None,
    *,
    spark: SparkSession | None = None,
    order_by: str | Sequence[str] | None = None,
    declared: dict[str, str] | None = None,
    split: Split | None = None,
    date_column: str | None = None,
    stage: bool | None = None,
    binary_fallback: bool = False,
    max_text_len: int | None = None,
    jdbc_options: dict | None = None,
    resume_dir: str | None = None,
) -> int:
    """Run one query on its source, write the result as numbered Parquet parts and a manifest, return the row count."""
    session = current_session(spark)
    size = batch_size or DEFAULT_BATCH_SIZE
    with as_extraction_error(password):
        conn = ConnectionOptions(
            connection_string, query, datasource_type, user_name, password, size, split, jdbc_options or {}
        )
        options = ExtractOptions(
            base_dir, table_dir, log_dir, total_size, prefix, encryption_key, size, _names(order_by),
            empty_policy=EMPTY_POLICY[datasource_type],
        )
        switches = Switches(binary_fallback, max_text_len)
        result = extract_to_parquet(session, conn, options, declared, switches, date_column, stage, resume_dir)
        if any(result.cut.values()):
            warnings.warn(f"values cut at max_text_len={max_text_len}, by column: {result.cut}", stacklevel=2)
        return result.rows


def read_to_json(
    connection_string: str,
    query: str,
    datasource_type: str,
    user_name: str | None = None,
    password: str | None = None,
    *,
    spark: SparkSession | None = None,
    declared: dict[str, str] | None = None,
    max_rows: int | None = None,
    max_bytes: int | None = MAX_BYTES,
    exact_decimals: bool = False,
    jdbc_options: dict | None = None,
) -> list[dict]:
    """Run one query and return all rows as dicts. For results of any size, use ``json_rows(extract(...))``."""
    session = current_session(spark)
    with as_extraction_error(password):
        conn = ConnectionOptions(
            connection_string, query, datasource_type, user_name, password, JSON_BATCH_SIZE, None, jdbc_options or {}
        )
        return rows_as_dicts(extract(session, conn, declared), max_rows, exact_decimals, max_bytes)
