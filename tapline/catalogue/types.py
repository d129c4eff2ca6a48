"""Type profiles and value rules on whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tapline import functions as V
from tapline.catalogue.common import extraction, rows
from tapline.plans.profiles import Switches, over_length_counts, unparsed_counts

# Fixed value: length at which text is cut when a cap is asked for.
TEXT_CAP = 40_000

QUERIES, SQL = {}, {}


def _add(name, spark_sql, profile, declared, same_sql, switches=Switches(), then=None):
    plain = extraction(spark_sql, profile, declared, switches)
    QUERIES[name] = (lambda spark, sf_dir: then(plain(spark, sf_dir))) if then else plain
    SQL[name] = same_sql


def _hex(*names):
    return lambda df: df.withColumns({n: F.hex(n) for n in names})


# ---------------------------------------------------------------- Postgres

_add(
    "pg_integers",
    "SELECT l_orderkey, l_linenumber AS small, l_partkey AS medium, l_suppkey AS large FROM lineitem", "POSTGRES",
    {"small": "int2", "medium": "integer", "large": "bigint"},
    "SELECT l_orderkey, CAST(l_linenumber AS SMALLINT) AS small, CAST(l_partkey AS INTEGER) AS medium, "
    "l_suppkey AS large FROM lineitem",
)
_add(
    "pg_floats", "SELECT event_id, value AS single, value AS double FROM events", "POSTGRES",
    {"single": "float4", "double": "double precision"},
    "SELECT event_id, CAST(value AS REAL) AS single, value AS double FROM events",
)
_add(
    "pg_boolean", "SELECT o_orderkey, o_orderstatus = 'F' AS finished FROM orders", "POSTGRES",
    {"finished": "boolean"}, "SELECT o_orderkey, o_orderstatus = 'F' AS finished FROM orders",
)
_SIGNED = "concat(CASE WHEN o_orderkey % 2 = 0 THEN '-' ELSE '' END, o_orderkey + 1, '.', {fraction})"
_add(
    "pg_numeric_trunc",
    f"SELECT o_orderkey, CAST({_SIGNED.format(fraction='lpad(o_custkey, 12, 0)')} AS DECIMAL(38,12)) AS num FROM orders",
    "POSTGRES", None,
    "SELECT o_orderkey, CAST("
    + _SIGNED.format(fraction="substr(lpad(CAST(o_custkey AS VARCHAR), 12, '0'), 1, 10)")
    + " AS DECIMAL(38,10)) AS num FROM orders",
)
_add(
    "pg_numeric_from_text",
    f"SELECT o_orderkey, {_SIGNED.format(fraction='lpad(o_custkey, 18, 9)')} AS num FROM orders", "POSTGRES",
    {"num": "numeric"},
    "SELECT o_orderkey, CAST("
    + _SIGNED.format(fraction="substr(lpad(CAST(o_custkey AS VARCHAR), 18, '9'), 1, 10)")
    + " AS DECIMAL(38,10)) AS num FROM orders",
)
_add(
    "pg_text", "SELECT doc_id, text, lang AS name, source AS citext FROM documents", "POSTGRES",
    {"text": "text", "name": "name", "citext": "citext"},
    "SELECT doc_id, text, lang AS name, source AS citext FROM documents",
)
_add(
    "pg_json_canonical", "SELECT event_id, props FROM events", "POSTGRES", {"props": "jsonb"},
    "SELECT event_id, CAST(json(props) AS VARCHAR) AS props FROM events",
)
_add(
    "pg_json_nested",
    """SELECT o_orderkey, concat('{ "price" : ', o_totalprice, ', "key": ', o_orderkey,
    ', "all": {"z": [1, 2.50, null], "b": true}, "all": {"z": [1.0, null], "a": "', o_orderstatus, '"} }') AS doc
    FROM orders""",
    "POSTGRES", {"doc": "json"},
    """SELECT o_orderkey, concat('{"all":{"a":"', o_orderstatus, '","z":[1.0,null]},"key":', o_orderkey, ',"price":',
    CAST(o_totalprice AS VARCHAR), '}') AS doc FROM orders""",
)
_add(
    "pg_timestamp_ms", "SELECT event_id, ts FROM events", "POSTGRES", {"ts": "timestamp"},
    "SELECT event_id, date_trunc('milliseconds', ts) AS ts FROM events",
)
_add(
    "pg_timestamp_before_1970", "SELECT event_id, ts - INTERVAL '80' YEAR AS ts FROM events", "POSTGRES", None,
    "SELECT event_id, date_trunc('milliseconds', ts - INTERVAL 80 YEAR) AS ts FROM events",
)
_add(
    "pg_timestamptz_utc", "SELECT event_id, CAST(concat(ts, '+07:00') AS TIMESTAMP) AS ts FROM events", "POSTGRES",
    {"ts": "timestamp with time zone"},
    "SELECT event_id, date_trunc('milliseconds', ts - INTERVAL 7 HOUR) AS ts FROM events",
)
_add(
    "pg_date", "SELECT o_orderkey, o_orderdate AS day FROM orders", "POSTGRES", {"day": "date"},
    "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders",
)
_add(
    "pg_varchar_text", "SELECT c_custkey, c_name, c_mktsegment FROM customer", "POSTGRES",
    {"c_name": "character varying(25)", "c_mktsegment": "bpchar"},
    "SELECT c_custkey, c_name, c_mktsegment FROM customer",
)
_add(
    "pg_varchar_bytes", "SELECT c_custkey, c_name FROM customer", "POSTGRES", {"c_name": "varchar(25)"},
    "SELECT c_custkey, hex(c_name) AS c_name FROM customer", Switches(binary_fallback=True), _hex("c_name"),
)
_add(
    "pg_bytea", "SELECT doc_id, encode(text, 'UTF-8') AS raw FROM documents", "POSTGRES", {"raw": "bytea"},
    "SELECT doc_id, hex(text) AS raw FROM documents", then=_hex("raw"),
)
_add(
    "pg_array_text", "SELECT vec_id, embedding FROM embeddings", "POSTGRES", None,
    "SELECT vec_id, unnest(generate_series(0, len(embedding) - 1)) AS pos, unnest(embedding) AS item FROM embeddings",
    then=lambda df: df.select(
        "vec_id", F.posexplode(F.from_json("embedding", "array<float>")).alias("pos", "item")
    ).withColumn("pos", F.col("pos").cast("bigint")),
)

# ---------------------------------------------------------------- generic drivers

_add(
    "odbc_decimal_bands",
    "SELECT o_orderkey, o_orderkey % 100 AS d2, o_custkey AS d9, o_orderkey * 1000003 AS d18, "
    "CAST(o_totalprice AS DECIMAL(20,4)) AS d20 FROM orders",
    "ODBC", {"d2": "decimal(2,0)", "d9": "numeric(9,0)", "d18": "decimal(18,0)", "d20": "decimal(20,4)"},
    "SELECT o_orderkey, CAST(o_orderkey % 100 AS DECIMAL(2,0)) AS d2, CAST(o_custkey AS DECIMAL(9,0)) AS d9, "
    "CAST(o_orderkey * 1000003 AS DECIMAL(18,0)) AS d18, CAST(o_totalprice AS DECIMAL(20,4)) AS d20 FROM orders",
)
_add(
    "odbc_decimal_text",
    "SELECT o_orderkey, concat(o_orderkey, '.', lpad(o_custkey, 7, '0')) AS amount, "
    "concat(o_orderkey, '.', o_custkey) AS wide FROM orders",
    "ODBC", {"amount": "decimal(20,4)", "wide": "numeric(60,4)"},
    "SELECT o_orderkey, CAST(concat(o_orderkey, '.', substr(lpad(CAST(o_custkey AS VARCHAR), 7, '0'), 1, 4)) "
    "AS DECIMAL(20,4)) AS amount, concat(o_orderkey, '.', o_custkey) AS wide FROM orders",
)
_add(
    "odbc_integers",
    "SELECT l_orderkey, l_linenumber AS tiny, l_linenumber AS small, l_suppkey AS whole, l_partkey AS big, "
    "l_returnflag = 'R' AS flag FROM lineitem",
    "ODBC", {"tiny": "tinyint", "small": "smallint", "whole": "integer", "big": "bigint", "flag": "bit"},
    "SELECT l_orderkey, CAST(l_linenumber AS TINYINT) AS tiny, CAST(l_linenumber AS SMALLINT) AS small, "
    "CAST(l_suppkey AS INTEGER) AS whole, l_partkey AS big, l_returnflag = 'R' AS flag FROM lineitem",
)
_add(
    "odbc_float_width", "SELECT event_id, value AS r, value AS f24, value AS f53, value AS d FROM events", "ODBC",
    {"r": "real", "f24": "float(24)", "f53": "float(53)", "d": "double"},
    "SELECT event_id, CAST(value AS REAL) AS r, CAST(value AS REAL) AS f24, value AS f53, value AS d FROM events",
)
# Calendar texts of which some name no day, some no time, and some are missing.
_DAY = "concat('2024-', lpad({key} % 14 + 1, 2, '0'), '-', lpad({other} % 31 + 1, 2, '0'))"
_SPARK_DAY = _DAY.format(key="o_orderkey", other="o_custkey")
_DUCK_DAY = _DAY.format(key="o_orderkey", other="o_custkey").replace("lpad(", "lpad(CAST(").replace(" + 1,", " + 1 AS VARCHAR),")
_MAYBE = "CASE WHEN o_orderkey % 10 > 0 THEN {} END"
_add(
    "odbc_invalid_epoch", f"SELECT o_orderkey, {_MAYBE.format(_SPARK_DAY)} AS day FROM orders", "ODBC", {"day": "date"},
    f"SELECT o_orderkey, CASE WHEN o_orderkey % 10 > 0 THEN coalesce(TRY_CAST({_DUCK_DAY} AS DATE), "
    "DATE '1970-01-01') END AS day FROM orders",
)
_SPARK_MOMENT = f"concat({_SPARK_DAY}, ' ', lpad(o_custkey % 26, 2, '0'), ':10:11.1239')"
_DUCK_MOMENT = f"concat({_DUCK_DAY}, ' ', lpad(CAST(o_custkey % 26 AS VARCHAR), 2, '0'), ':10:11.1239')"
_add(
    "odbc_invalid_timestamp", f"SELECT o_orderkey, {_MAYBE.format(_SPARK_MOMENT)} AS moment FROM orders", "ODBC",
    {"moment": "timestamp(6)"},
    f"SELECT o_orderkey, CASE WHEN o_orderkey % 10 > 0 THEN coalesce(date_trunc('milliseconds', "
    f"CASE WHEN o_custkey % 26 < 24 THEN TRY_CAST({_DUCK_MOMENT} AS TIMESTAMP) END), "
    "TIMESTAMP '1970-01-01 00:00:00') END AS moment FROM orders",
)
_add(
    "odbc_time_seconds",
    "SELECT event_id, ts AS moment, date_format(ts, 'HH:mm:ss.SSSSSS') AS clock FROM events", "ODBC",
    {"moment": "time", "clock": "time(6)"},
    "SELECT event_id, CAST(hour(ts) * 3600 + minute(ts) * 60 + second(ts) AS INTEGER) AS moment, "
    "CAST(hour(ts) * 3600 + minute(ts) * 60 + second(ts) AS INTEGER) AS clock FROM events",
)
_add(
    "odbc_text",
    "SELECT conv_id, turn, role AS c, text AS v, encode(text, 'UTF-8') AS bytes, encode(text, 'UTF-16LE') AS wide "
    "FROM conversations",
    "ODBC", {"c": "char(20)", "v": "varchar(40000)", "bytes": "long varchar", "wide": "nvarchar(4000)"},
    "SELECT conv_id, turn, role AS c, text AS v, text AS bytes, text AS wide FROM conversations",
)
_add(
    "odbc_binary",
    "SELECT doc_id, encode(text, 'UTF-8') AS vb, encode(lang, 'UTF-8') AS fixed, source AS unknown FROM documents",
    "ODBC", {"vb": "varbinary(8000)", "fixed": "binary(2)", "unknown": "sql_variant"},
    "SELECT doc_id, hex(text) AS vb, hex(lang) AS fixed, hex(source) AS unknown FROM documents",
    then=_hex("vb", "fixed", "unknown"),
)
_add(
    "odbc_nulls",
    "SELECT event_id, CASE WHEN event_type = 'view' THEN ts END AS moment, CASE WHEN event_type = 'click' THEN "
    "CAST(ts AS DATE) END AS day, CASE WHEN event_type = 'error' THEN ts END AS clock, "
    "nullif(event_type, 'view') AS kind FROM events",
    "ODBC", {"moment": "timestamp", "day": "date", "clock": "time", "kind": "varchar(10)"},
    "SELECT event_id, CASE WHEN event_type = 'view' THEN date_trunc('milliseconds', ts) END AS moment, "
    "CASE WHEN event_type = 'click' THEN CAST(ts AS DATE) END AS day, CASE WHEN event_type = 'error' THEN "
    "CAST(hour(ts) * 3600 + minute(ts) * 60 + second(ts) AS INTEGER) END AS clock, "
    "nullif(event_type, 'view') AS kind FROM events",
)
_add(
    "odbc_text_cap", "SELECT doc_id, text FROM documents", "ODBC", {"text": "varchar(2147483647)"},
    f"SELECT doc_id, left(text, {TEXT_CAP // 10}) AS text FROM documents", Switches(max_text_len=TEXT_CAP // 10),
)
QUERIES["odbc_over_length_report"] = lambda spark, sf_dir: over_length_counts(
    rows(spark, sf_dir, "SELECT text, source FROM documents", "ODBC"), TEXT_CAP // 10
)
SQL["odbc_over_length_report"] = (
    f"SELECT 'text' AS column_name, count(*) FILTER (length(text) > {TEXT_CAP // 10}) AS rows_over FROM documents "
    f"UNION ALL SELECT 'source', count(*) FILTER (length(source) > {TEXT_CAP // 10}) FROM documents"
)

# ---------------------------------------------------------------- Oracle

_add(
    "ora_text", "SELECT doc_id, text, encode(lang, 'UTF-8') AS lang, source FROM documents", "ORACLE",
    {"text": "clob", "lang": "char(2)", "source": "nvarchar2(20)"},
    "SELECT CAST(doc_id AS DECIMAL(19,0)) AS doc_id, text, lang, source FROM documents",
)
_add(
    "ora_text_lossy", "SELECT doc_id, concat(x'FF', encode(text, 'UTF-8'), x'E282') AS text FROM documents", "ORACLE",
    {"text": "varchar2(4000)"},
    "SELECT CAST(doc_id AS DECIMAL(19,0)) AS doc_id, concat(chr(65533), text, chr(65533)) AS text FROM documents",
)
_add(
    "ora_number_fixed",
    "SELECT o_orderkey, o_custkey, CAST(o_totalprice AS DECIMAL(20,4)) AS price, o_custkey AS whole FROM orders",
    "ORACLE", {"o_custkey": "number(12,0)", "price": "number(18,2)", "whole": "number(0,0)"},
    "SELECT CAST(o_orderkey AS DECIMAL(19,0)) AS o_orderkey, CAST(o_custkey AS DECIMAL(12,0)) AS o_custkey, "
    "CAST(o_totalprice AS DECIMAL(18,2)) AS price, CAST(o_custkey AS DECIMAL(38,0)) AS whole FROM orders",
)
_add(
    "ora_number_text",
    f"SELECT o_orderkey, CASE WHEN o_orderkey % 9 > 0 THEN {_SIGNED.format(fraction='lpad(o_custkey, 7, 0)')} "
    "ELSE 'n/a' END AS amount FROM orders",
    "ORACLE", {"o_orderkey": "number(19,0)", "amount": "number(20,4)"},
    "SELECT CAST(o_orderkey AS DECIMAL(19,0)) AS o_orderkey, CASE WHEN o_orderkey % 9 > 0 THEN CAST("
    + _SIGNED.format(fraction="substr(lpad(CAST(o_custkey AS VARCHAR), 7, '0'), 1, 4)")
    + " AS DECIMAL(20,4)) END AS amount FROM orders",
)
_add(
    "ora_free_number",
    "SELECT o_orderkey, CASE WHEN o_orderkey % 7 > 0 THEN CAST(o_totalprice AS STRING) ELSE 'n/a' END AS free, "
    "CAST(o_totalprice AS STRING) AS flt, o_totalprice AS bd, o_totalprice AS bf FROM orders",
    "ORACLE", {"free": "number", "flt": "float(126)", "bd": "binary_double", "bf": "binary_float"},
    "SELECT CAST(o_orderkey AS DECIMAL(19,0)) AS o_orderkey, CASE WHEN o_orderkey % 7 > 0 THEN o_totalprice END "
    "AS free, o_totalprice AS flt, o_totalprice AS bd, CAST(o_totalprice AS REAL) AS bf FROM orders",
)
_add(
    "ora_date_time", "SELECT event_id, ts AS stamp, ts AS day, CAST(ts AS DATE) AS only_day FROM events", "ORACLE",
    {"stamp": "timestamp(6)", "day": "date", "only_day": "date"},
    "SELECT CAST(event_id AS DECIMAL(19,0)) AS event_id, date_trunc('milliseconds', ts) AS stamp, "
    "date_trunc('milliseconds', ts) AS day, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS only_day FROM events",
)
_add(
    "ora_tz_drop",
    "SELECT event_id, concat(ts, ' +07:00') AS plus, concat(ts, ' America/New_York') AS region FROM events", "ORACLE",
    {"plus": "timestamp(6) with time zone", "region": "timestamp(6) with local time zone"},
    "SELECT CAST(event_id AS DECIMAL(19,0)) AS event_id, date_trunc('milliseconds', ts) AS plus, "
    "date_trunc('milliseconds', ts) AS region FROM events",
)
_add(
    "ora_invalid_timestamp", f"SELECT o_orderkey, {_MAYBE.format(_SPARK_MOMENT)} AS moment FROM orders", "ORACLE",
    {"moment": "timestamp(6)"},
    f"SELECT CAST(o_orderkey AS DECIMAL(19,0)) AS o_orderkey, CASE WHEN o_orderkey % 10 > 0 AND o_custkey % 26 < 24 "
    f"THEN date_trunc('milliseconds', TRY_CAST({_DUCK_MOMENT} AS TIMESTAMP)) END AS moment FROM orders",
)
_add(
    "ora_raw", "SELECT c_custkey, encode(c_name, 'UTF-8') AS raw, encode(c_mktsegment, 'UTF-8') AS blob FROM customer",
    "ORACLE", {"raw": "raw(100)", "blob": "blob"},
    "SELECT CAST(c_custkey AS DECIMAL(19,0)) AS c_custkey, hex(c_name) AS raw, hex(c_mktsegment) AS blob FROM customer",
    then=_hex("raw", "blob"),
)
_add(
    "ora_long_binary", "SELECT doc_id, text FROM documents", "ORACLE", {"text": "long"},
    "SELECT CAST(doc_id AS DECIMAL(19,0)) AS doc_id, hex(text) AS text FROM documents", then=_hex("text"),
)
_add(
    "ora_json_text", "SELECT event_id, props FROM events", "ORACLE", {"props": "json"},
    "SELECT CAST(event_id AS DECIMAL(19,0)) AS event_id, props FROM events",
)
QUERIES["ora_unparsed_report"] = lambda spark, sf_dir: unparsed_counts(
    rows(spark, sf_dir, "SELECT CASE WHEN o_orderkey % 9 > 0 THEN CAST(o_totalprice AS STRING) ELSE 'n/a' END AS price, "
         "o_orderpriority AS priority FROM orders", "ORACLE"),
    {"price": V.decimal_from_text(F.col("price"), 20, 4), "priority": V.double_from_text(F.col("priority"))},
)
SQL["ora_unparsed_report"] = (
    "SELECT 'price' AS column_name, count(*) FILTER (o_orderkey % 9 = 0) AS rows_unparsed FROM orders "
    "UNION ALL SELECT 'priority', count(*) FROM orders"
)
