"""Sinks, manifests and JSON rows. Files go to a new folder under the session's scratch folder."""

from __future__ import annotations

import base64
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from tapline.api import EMPTY_POLICY, extract_to_parquet
from tapline.catalogue.common import register, rows
from tapline.operators import paths
from tapline.operators.envelope import read_encrypted
from tapline.operators.json_rows import json_rows
from tapline.operators.manifest import progress, read_manifest, reconcile
from tapline.operators.many import extract_many
from tapline.operators.parts import write_parts
from tapline.operators.store import Store
from tapline.options import SESSION_TABLES, ConnectionOptions, ExtractOptions
from tapline.session import scratch_folder

BATCH = 300  # rows per batch; ten batches make a part
EVENTS = "SELECT event_id, ts, user_id, event_type, value, props FROM events"
_EVENTS_MILLIS = "event_id, date_trunc('milliseconds', ts) AS ts, user_id, event_type, value, props"


def _options(spark: SparkSession, table_dir: str, **more) -> ExtractOptions:
    folder = scratch_folder(spark, "output")
    more = {"batch_size": BATCH, "total_size": 0, "order_by": ("event_id",), **more}
    return ExtractOptions(f"{folder}/data", table_dir, f"{folder}/log", **more)


def _extract(spark, sf_dir, query, options, profile="POSTGRES", **more):
    register(spark, sf_dir, query)
    return extract_to_parquet(spark, ConnectionOptions(SESSION_TABLES, query, profile), options, **more)


def _part_number(options: ExtractOptions):
    name = F.col("_metadata.file_name")
    return F.regexp_extract(name, paths.part_name_pattern(options).pattern, 1).cast("int")


def flagship(spark: SparkSession, sf_dir: str, batch_size: int = BATCH) -> DataFrame:
    """Events under the Postgres profile as numbered parts in key order; the result is the manifest."""
    total = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    options = _options(spark, "events", batch_size=batch_size, total_size=total)
    result = _extract(spark, sf_dir, EVENTS, options, declared={"props": "jsonb"})
    return read_manifest(spark, *result.manifests)


def _parts_manifest(spark, sf_dir):
    return flagship(spark, sf_dir).select("output_path", "part_number", "num_records", "total_records")


def _parts_repeated_key(spark, sf_dir):
    """Orders by customer, a key that repeats: parts are exactly ten batches, and keys do not go back."""
    options = _options(spark, "orders", order_by=("o_custkey",))
    _extract(spark, sf_dir, "SELECT o_orderkey, o_custkey FROM orders", options)
    part = spark.read.parquet(paths.table_uri(options)).select("o_custkey", _part_number(options).alias("part_number"))
    return part.groupBy("part_number").agg(
        F.count("*").alias("num_records"), F.min("o_custkey").alias("first_key"), F.max("o_custkey").alias("last_key"))


def _parts_equal_rows(spark, sf_dir):
    """Rows that repeat in every column: parts are exactly ten batches all the same."""
    options = _options(spark, "lineitem", order_by=("flag DESC NULLS FIRST", "status"))
    query = "SELECT nullif(l_returnflag, 'A') AS flag, l_linestatus AS status FROM lineitem"
    _extract(spark, sf_dir, query, options, "ODBC")
    part = spark.read.parquet(paths.table_uri(options)).withColumn("part_number", _part_number(options))
    return part.groupBy("part_number", "flag", "status").agg(
        F.count("*").alias("num_records"))


def _parts_of_rows(spark, sf_dir):
    options = _options(spark, "events", prefix="pre")
    _extract(spark, sf_dir, EVENTS, options)
    return spark.read.parquet(paths.table_uri(options)).select("event_id", _part_number(options).alias("part_number"))


def _parts_composite_key(spark, sf_dir):
    options = _options(spark, "events", order_by=("event_type", "event_id"))
    _extract(spark, sf_dir, EVENTS, options)
    return spark.read.parquet(paths.table_uri(options)).select("event_id", _part_number(options).alias("part_number"))


def _parts_readback(spark, sf_dir):
    options = _options(spark, "events")
    _extract(spark, sf_dir, EVENTS, options)
    return spark.read.parquet(paths.table_uri(options))


def _parts_without_key(spark, sf_dir):
    options = _options(spark, "lineitem", order_by=())
    result = _extract(spark, sf_dir, "SELECT * FROM lineitem", options)
    return read_manifest(spark, *result.manifests).groupBy("output_path").agg(
        F.sum("num_records").alias("num_records"), (F.max("num_records") <= BATCH * 10).alias("within_limit"),
        (F.count_distinct("part_number") == F.max("part_number") + 1).alias("numbered_from_zero"),
    )


def _partition_dirs(spark, sf_dir):
    options = _options(spark, "events", order_by=())
    _extract(spark, sf_dir, EVENTS, options, date_column="ts")
    return spark.read.parquet(paths.table_uri(options)).groupBy("year", "month", "day").agg(
        F.count(F.lit(1)).alias("num_records"), F.sum(F.col("event_id").cast("decimal(38,0)")).alias("event_ids")
    )


def _dated_parts(spark, sf_dir):
    options = _options(spark, "events", batch_size=10)
    result = _extract(spark, sf_dir, EVENTS, options, date_column="ts")
    return read_manifest(spark, *result.manifests).select("output_path", "part_number", "num_records")


def _empty_result(spark, sf_dir):
    """A filter that no row passes, for each datasource type: what the manifest then holds."""
    found = []
    for profile, policy in EMPTY_POLICY.items():
        options = _options(spark, "empty", order_by=(), empty_policy=policy)
        result = _extract(spark, sf_dir, "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice < 0", options,
                          profile)
        found.append(read_manifest(spark, *result.manifests).select(
            F.lit(profile).alias("datasource_type"), "output_path", "num_records", "part_number"
        ))
    return reduce(DataFrame.unionByName, found)


def _replaced_parts(spark, sf_dir):
    """A second, shorter run into the same folder: only its rows remain."""
    options = _options(spark, "events")
    _extract(spark, sf_dir, EVENTS, options)
    _extract(spark, sf_dir, EVENTS + " WHERE event_type <> 'view'", options)
    return spark.read.parquet(paths.table_uri(options)).select("event_id", _part_number(options).alias("part_number"))


def _manifest_progress(spark, sf_dir):
    return progress(flagship(spark, sf_dir))


def _manifest_reconcile(spark, sf_dir):
    return reconcile(flagship(spark, sf_dir))


def _many_tables(spark, sf_dir):
    folder = scratch_folder(spark, "output")
    keys = {"orders": "o_orderkey", "customer": "c_custkey", "part": "p_partkey", "lineitem": None}
    jobs = [
        {"query": f"SELECT * FROM {t}", "table_dir": t, **({"order_by": k} if k else {})} for t, k in keys.items()
    ]
    register(spark, sf_dir, *[job["query"] for job in jobs])
    return extract_many(
        spark, jobs, connection_string=SESSION_TABLES, datasource_type="ODBC", base_dir=f"{folder}/data",
        log_dir=f"{folder}/log", total_size=0,
    ).select("table_dir", "num_records")


def _json_rows(spark, sf_dir):
    return json_rows(rows(
        spark, sf_dir,
        "SELECT event_id, ts, CASE WHEN event_type <> 'view' THEN user_id END AS user_id, event_type = 'error' AS failed, "
        "value, props, CAST(ts AS DATE) AS day, encode(event_type, 'UTF-8') AS raw, "
        "CASE WHEN event_type = 'click' THEN CAST('NaN' AS DOUBLE) ELSE value END AS maybe FROM events", "POSTGRES",
    ))


def _json_decimal_loss(spark, sf_dir):
    """Decimals through JSON text and back: integers where the scale is 0, else doubles."""
    texts = json_rows(rows(
        spark, sf_dir, "SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(38,10)) AS price, "
        "CAST(o_custkey AS DECIMAL(38,0)) AS whole FROM orders", "ODBC", {"price": "decimal(38,10)"},
    ))
    return texts.select(F.from_json("json", "o_orderkey bigint, price double, whole bigint").alias("r")).select("r.*")


def _json_time(spark, sf_dir):
    return json_rows(rows(spark, sf_dir, "SELECT event_id, ts AS clock FROM events", "ODBC", {"clock": "time"}))


def _new_rsa_keys(spark: SparkSession) -> tuple[str, str]:
    """A fresh RSA pair as PEM texts: (public, private)."""
    jvm = spark._jvm
    generator = jvm.java.security.KeyPairGenerator.getInstance("RSA")
    generator.initialize(2048)
    pair = generator.generateKeyPair()
    factory = jvm.java.security.KeyFactory.getInstance("RSA")

    def pem(kind, key, spec):
        encoded = factory.getKeySpec(key, jvm.java.lang.Class.forName(f"java.security.spec.{spec}")).getEncoded()
        return f"-----BEGIN {kind} KEY-----\n{base64.encodebytes(bytes(encoded)).decode()}-----END {kind} KEY-----\n"

    return (
        pem("PUBLIC", pair.getPublic(), "X509EncodedKeySpec"), pem("PRIVATE", pair.getPrivate(), "PKCS8EncodedKeySpec")
    )


def _encrypted_roundtrip(spark, sf_dir):
    public, private = _new_rsa_keys(spark)
    options = replace(_options(spark, "events"), encryption_key=public)
    write_parts(rows(spark, sf_dir, EVENTS, "POSTGRES"), options)
    folder = paths.table_uri(options)
    return read_encrypted(spark, _parts_in(spark, folder), private)


def _parts_in(spark: SparkSession, folder: str) -> list[str]:
    return sorted(f"{folder}/{name}" for name in Store(spark, folder).names(folder) if name.endswith(".encrypted"))


def _encrypted_folders(spark, sf_dir):
    """Encrypted parts in a folder for each date, each folder a sealed set; how many rows come back from each."""
    public, private = _new_rsa_keys(spark)
    options = replace(_options(spark, "events", batch_size=10), encryption_key=public)
    result = _extract(spark, sf_dir, EVENTS, options, date_column="ts")
    told = read_manifest(spark, *result.manifests)
    base = paths.table_uri(options).removesuffix("events")
    folders = [r.output_path for r in told.select("output_path").distinct().collect()]
    found = read_encrypted(spark, [uri for f in folders for uri in _parts_in(spark, f"{base}{f}")], private)
    return found.groupBy(F.to_date("ts").alias("day")).agg(F.count("*").alias("num_records")).join(
        told.groupBy(F.to_date(F.concat_ws("-", *(F.regexp_extract("output_path", rf"{p}=(\d+)", 1) for p in (
            "year", "month", "day")))).alias("day")).agg(F.count("*").alias("parts"), F.sum("num_records").alias("told")), "day")


def _json_exact_decimals(spark, sf_dir):
    """Decimals whose every digit is kept in the JSON text."""
    texts = json_rows(rows(
        spark, sf_dir, "SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS DECIMAL(30,10)) + "
        "CAST(98765432109876543 AS DECIMAL(30,10)) AS price FROM orders", "ODBC",
        {"price": "decimal(38,10)"},
    ), exact_decimals=True)
    told = {"o_orderkey": "bigint", "price": "string"}
    return texts.select(*(F.regexp_extract("json", f'"{n}":([-0-9.]+)', 1).cast(t).alias(n) for n, t in told.items()))


_RANK = "row_number() OVER (ORDER BY {}) - 1"
_PER_PART = BATCH * 10
_PARTS = (
    f"SELECT CAST(floor(({_RANK.format('event_id')}) / {_PER_PART}) AS INTEGER) AS part_number FROM events"
)

QUERIES = {
    "q06_empty_result": _empty_result,
    "parts_manifest": _parts_manifest,
    "parts_of_rows": _parts_of_rows,
    "parts_repeated_key": _parts_repeated_key,
    "parts_equal_rows": _parts_equal_rows,
    "parts_composite_key": _parts_composite_key,
    "parts_readback": _parts_readback,
    "parts_without_key": _parts_without_key,
    "parts_replaced": _replaced_parts,
    "partition_dirs": _partition_dirs,
    "dated_parts": _dated_parts,
    "manifest_progress": _manifest_progress,
    "manifest_reconcile": _manifest_reconcile,
    "many_tables": _many_tables,
    "json_rows": _json_rows,
    "json_decimal_loss": _json_decimal_loss,
    "json_time_of_day": _json_time,
    "encrypted_roundtrip": _encrypted_roundtrip,
    "encrypted_folders": _encrypted_folders,
    "json_exact_decimals": _json_exact_decimals,
}

SQL = {
    "q06_empty_result": (
        "SELECT t AS datasource_type, 'empty' AS output_path, "
        "(SELECT count(*) FROM orders WHERE o_totalprice < 0) AS num_records, CAST(0 AS INTEGER) AS part_number "
        "FROM (VALUES ('ODBC'), ('ORACLE')) v(t)"
    ),
    "parts_manifest": (
        f"SELECT 'events' AS output_path, part_number, count(*) AS num_records, "
        f"(SELECT count(*) FROM events) AS total_records FROM ({_PARTS}) GROUP BY part_number"
    ),
    "parts_of_rows": (
        f"SELECT event_id, CAST(floor(({_RANK.format('event_id')}) / {_PER_PART}) AS INTEGER) AS part_number FROM events"
    ),
    "parts_composite_key": (
        f"SELECT event_id, CAST(floor(({_RANK.format('event_type, event_id')}) / {_PER_PART}) AS INTEGER) "
        "AS part_number FROM events"
    ),
    "parts_readback": f"SELECT {_EVENTS_MILLIS} FROM events",
    "parts_without_key": (
        "SELECT 'lineitem' AS output_path, count(*) AS num_records, true AS within_limit, true AS numbered_from_zero "
        "FROM lineitem"
    ),
    "parts_repeated_key": (
        "SELECT part_number, count(*) AS num_records, min(o_custkey) AS first_key, max(o_custkey) AS last_key FROM ("
        f"SELECT o_custkey, CAST(floor(({_RANK.format('o_custkey')}) / {_PER_PART}) AS INTEGER) AS part_number FROM orders"
        ") GROUP BY part_number"
    ),
    "parts_equal_rows": (
        "SELECT part_number, flag, status, count(*) AS num_records FROM (SELECT flag, status, CAST(floor(("
        f"{_RANK.format('flag DESC NULLS FIRST, status')}) / {_PER_PART}) AS INTEGER) AS part_number FROM "
        "(SELECT nullif(l_returnflag, 'A') AS flag, l_linestatus AS status FROM lineitem)) GROUP BY ALL"
    ),
    "parts_replaced": (
        f"SELECT event_id, CAST(floor(({_RANK.format('event_id')}) / {_PER_PART}) AS INTEGER) AS part_number "
        "FROM events WHERE event_type <> 'view'"
    ),
    "partition_dirs": (
        "SELECT CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day, "
        "count(*) AS num_records, CAST(sum(event_id) AS DECIMAL(38,0)) AS event_ids FROM events GROUP BY ALL"
    ),
    "dated_parts": (
        "SELECT output_path, part_number, count(*) AS num_records FROM (SELECT "
        "strftime(ts, 'events/year=%Y/month=%m/day=%d') AS output_path, CAST(floor((row_number() OVER "
        "(PARTITION BY CAST(ts AS DATE) ORDER BY event_id) - 1) / 100) AS INTEGER) AS part_number FROM events) GROUP BY ALL"
    ),
    "manifest_progress": (
        f"SELECT 'events' AS output_path, part_number, num_records, CAST(sum(num_records) OVER (ORDER BY part_number) "
        "AS BIGINT) AS records_so_far, CAST(sum(num_records) OVER (ORDER BY part_number) AS DOUBLE) / "
        f"(SELECT count(*) FROM events) AS progress FROM (SELECT part_number, count(*) AS num_records FROM ({_PARTS}) "
        "GROUP BY part_number)"
    ),
    "manifest_reconcile": (
        f"SELECT 'events' AS output_path, CAST(ceil(count(*) / {_PER_PART}) AS BIGINT) AS parts, count(*) AS num_records, "
        "count(*) AS total_records, true AS complete FROM events"
    ),
    "many_tables": (
        "SELECT 'orders' AS table_dir, count(*) AS num_records FROM orders UNION ALL SELECT 'customer', count(*) FROM "
        "customer UNION ALL SELECT 'part', count(*) FROM part UNION ALL SELECT 'lineitem', count(*) FROM lineitem"
    ),
    "json_rows": (
        """SELECT concat('{"event_id":', event_id, ',"ts":"', strftime(ts, '%Y-%m-%dT%H:%M:%S'),
        CASE WHEN millisecond(ts) % 1000 = 0 THEN '' ELSE concat('.', lpad(CAST(millisecond(ts) % 1000 AS VARCHAR), 3, '0'))
        END, '"', CASE WHEN event_type <> 'view' THEN concat(',"user_id":', user_id) ELSE '' END, ',"failed":',
        CASE WHEN event_type = 'error' THEN 'true' ELSE 'false' END, ',"value":', CAST(value AS VARCHAR), ',"props":"',
        replace(props, '"', '\\"'), '","day":"', strftime(ts, '%Y-%m-%d'), '","raw":"', lower(hex(event_type)),
        '","maybe":', CASE WHEN event_type = 'click' THEN 'null' ELSE CAST(value AS VARCHAR) END, '}') AS json FROM events"""
    ),
    "json_decimal_loss": "SELECT o_orderkey, o_totalprice AS price, o_custkey AS whole FROM orders",
    "json_time_of_day": (
        """SELECT concat('{"event_id":', event_id, ',"clock":"', strftime(ts, '%H:%M:%S'), '"}') AS json FROM events"""
    ),
    "encrypted_folders": (
        "SELECT CAST(ts AS DATE) AS day, count(*) AS num_records, CAST(ceil(count(*) / 100) AS BIGINT) AS parts, "
        "count(*) AS told FROM events GROUP BY ALL"
    ),
    "json_exact_decimals": (
        "SELECT o_orderkey, CAST(CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS DECIMAL(30,10)) + "
        "CAST(98765432109876543 AS DECIMAL(30,10)) AS VARCHAR) AS price FROM orders"
    ),
    "encrypted_roundtrip": f"SELECT {_EVENTS_MILLIS} FROM events",
}
