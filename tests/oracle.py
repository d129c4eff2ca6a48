"""Run every named query beside its SQL: python tests/oracle.py [sf] [name ...]"""

import math
import os
import sys
import time
from decimal import Decimal
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
TESTDATA = "/root/testdata"


def tables(sf):
    link = duckdb.connect()
    link.execute("SET TimeZone = 'UTC'")
    for path in sorted(Path(f"{TESTDATA}/sf{sf}").glob("*.parquet")):
        link.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return link


def _cell(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    if isinstance(value, Decimal):
        return f"{value:f}"
    return repr(bytes(value)) if isinstance(value, bytearray) else repr(value)


def difference(df, link, sql):
    """None if both give the same columns and rows, else a text that says what differs."""
    names = sorted(df.columns)
    relation = link.sql(sql)
    if names != sorted(relation.columns):
        return f"columns {names} against {sorted(relation.columns)}"
    ours = sorted(tuple(_cell(r[n]) for n in names) for r in df.collect())
    at = [relation.columns.index(n) for n in names]
    theirs = sorted(tuple(_cell(r[i]) for i in at) for r in relation.fetchall())
    if ours == theirs:
        return None
    only_ours, only_theirs = set(ours) - set(theirs), set(theirs) - set(ours)
    return (f"{len(ours)} rows against {len(theirs)}; ours {str(sorted(only_ours)[:2])[:400]} "
            f"theirs {str(sorted(only_theirs)[:2])[:400]}")


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf, wanted = (sys.argv[1] if len(sys.argv) > 1 else "0.01"), sys.argv[2:]
    spark = (
        SparkSession.builder.master(os.environ.get("ORACLE_MASTER", "local[8]"))
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.executor.memory", "2g")
        .config("spark.sql.shuffle.partitions", "8").config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    link, bad = tables(sf), 0
    for name, query in entry.queries().items():
        if wanted and name not in wanted or name not in entry.oracle_sql():
            continue
        started = time.time()
        try:
            found = difference(query(spark, f"{TESTDATA}/sf{sf}"), link, entry.oracle_sql()[name])
        except Exception as err:
            found = f"{type(err).__name__}: {str(err)[:600]}"
        bad += found is not None
        print(f"{'ok  ' if found is None else 'BAD '} {time.time() - started:6.2f}s {name} {found or ''}", flush=True)
    print(f"{bad} differ")
