"""Query shapes that pass through to the source."""

from __future__ import annotations

from tapline.catalogue.common import extraction, rows
from tapline.plans.layout import skip_rows

SKIPPED = 1000


def _order_offset(spark, sf_dir):
    return skip_rows(rows(spark, sf_dir, "SELECT * FROM orders", "ODBC"), ("o_orderkey",), SKIPPED)


def _offset_ties(spark, sf_dir):
    """An order key that repeats: the keys of the rows that are left, ties in any order."""
    return skip_rows(rows(spark, sf_dir, "SELECT * FROM orders", "ODBC"), ("o_custkey",), SKIPPED).select("o_custkey")


def _offset_equal_rows(spark, sf_dir):
    """Rows that repeat in every column, many times each."""
    return skip_rows(rows(spark, sf_dir, "SELECT l_returnflag, l_linestatus FROM lineitem", "ODBC"), ("l_returnflag",),
                     SKIPPED * 3).select("l_returnflag")


def _offset_down(spark, sf_dir):
    """Two keys, the first going down, with nulls."""
    df = rows(spark, sf_dir, "SELECT o_orderkey, nullif(o_orderpriority, '2-HIGH') AS priority, o_orderdate FROM orders", "ODBC")
    return skip_rows(df, ("priority DESC NULLS FIRST", "o_orderdate DESC", "o_orderkey"), SKIPPED * 2).select(
        "o_orderkey", "priority")


_MILLIS_ORDERS = (
    "o_orderkey, o_custkey, o_orderstatus, o_totalprice, date_trunc('milliseconds', o_orderdate) AS o_orderdate, "
    "o_orderpriority"
)

QUERIES = {
    "q01_select_limit": extraction("SELECT * FROM orders ORDER BY o_orderkey LIMIT 10", "ODBC"),
    "q02_projection_alias": extraction(
        "SELECT c_custkey AS customer, c_name AS called, c_nationkey AS nation, c_acctbal AS balance, "
        "c_mktsegment AS market FROM customer;", "ODBC"
    ),
    "q03_order_offset": _order_offset,
    "q03_offset_ties": _offset_ties,
    "offset_equal_rows": _offset_equal_rows,
    "offset_descending": _offset_down,
    "q04_distinct": extraction("SELECT DISTINCT event_type FROM events", "ODBC"),
    "q05_filter_eq": extraction("SELECT * FROM customer WHERE c_mktsegment = 'BUILDING'", "ODBC"),
    "q07_top_n": extraction("SELECT * FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 9", "ODBC"),
    "q08_generate_cast": extraction(
        "SELECT c_custkey, visit::DECIMAL(38,18) AS visit, date_add(DATE'1999-12-28', visit) AS visited, "
        "concat('{\"nation\" : ', c_nationkey, ', \"kind\":\"guest\"}') AS profile "
        "FROM customer LATERAL VIEW explode(sequence(1, 9)) g AS visit",
        "POSTGRES", {"profile": "jsonb"},
    ),
    "q09_large_object": extraction("SELECT page_id, html AS markup FROM pages", "ORACLE", {"markup": "clob"}),
}

SQL = {
    "q01_select_limit": f"SELECT {_MILLIS_ORDERS} FROM orders ORDER BY o_orderkey LIMIT 10",
    "q02_projection_alias": (
        "SELECT c_custkey AS customer, c_name AS called, c_nationkey AS nation, c_acctbal AS balance, "
        "c_mktsegment AS market FROM customer"
    ),
    "q03_order_offset": f"SELECT {_MILLIS_ORDERS} FROM orders ORDER BY o_orderkey OFFSET {SKIPPED}",
    "q03_offset_ties": f"SELECT o_custkey FROM orders ORDER BY o_custkey OFFSET {SKIPPED}",
    "offset_equal_rows": f"SELECT l_returnflag FROM lineitem ORDER BY l_returnflag OFFSET {SKIPPED * 3}",
    "offset_descending": (
        "SELECT o_orderkey, nullif(o_orderpriority, '2-HIGH') AS priority FROM orders ORDER BY priority DESC NULLS FIRST, "
        f"date_trunc('milliseconds', o_orderdate) DESC, o_orderkey OFFSET {SKIPPED * 2}"
    ),
    "q04_distinct": "SELECT DISTINCT event_type FROM events",
    "q05_filter_eq": "SELECT * FROM customer WHERE c_mktsegment = 'BUILDING'",
    "q07_top_n": f"SELECT {_MILLIS_ORDERS} FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 9",
    "q08_generate_cast": (
        "SELECT c_custkey, CAST(visit AS DECIMAL(38,10)) AS visit, CAST(DATE '1999-12-28' + CAST(visit AS INTEGER) AS DATE) "
        "AS visited, concat('{\"kind\":\"guest\",\"nation\":', c_nationkey, '}') AS profile FROM customer, range(1, 10) g(visit)"
    ),
    "q09_large_object": "SELECT CAST(page_id AS DECIMAL(19,0)) AS page_id, html AS markup FROM pages",
}
