"""Time the headline queries and print one JSON line. BENCH_SF_DIR and BENCH_CPUS choose data and cores."""

import json
import os
import statistics
import sys
import time
from pathlib import Path

ROOT = Path(__file__).resolve().parent
sys.path.insert(0, str(ROOT))

from pyspark.sql import SparkSession  # noqa: E402

import tapline  # noqa: E402
from tapline.catalogue import QUERIES  # noqa: E402
from tapline.catalogue.common import register, rows  # noqa: E402
from tapline.session import scratch_folder  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
# Once so many seconds are gone, the rest is timed once each.
BUDGET = float(os.environ.get("BENCH_BUDGET", "300"))


def write(spark, query, **more):
    """An extraction from the given tables to a new folder."""
    folder = scratch_folder(spark, "bench")
    register(spark, SF_DIR, query)
    return tapline.read_to_parquet(
        tapline.SESSION_TABLES, query, f"{folder}/data", "t", f"{folder}/log", 0, "POSTGRES", spark=spark, **more
    )


def drain(df):
    df.write.format("noop").mode("overwrite").save()


def named(name):
    return lambda spark: drain(QUERIES[name](spark, SF_DIR))


LINES = "SELECT * FROM lineitem"
BENCHES = {
    "write_orders_in_key_order": lambda s: write(s, "SELECT * FROM orders", order_by="o_orderkey", batch_size=5000),
    "write_orders": lambda s: write(s, "SELECT * FROM orders", batch_size=5000),
    "write_lineitem": lambda s: write(s, LINES),
    "write_events_by_date_in_key_order": lambda s: write(
        s, "SELECT * FROM events", order_by="event_id", date_column="ts", batch_size=100
    ),
    "scan_events": lambda s: drain(s.read.parquet(f"{SF_DIR}/events.parquet")),
    "profile_events": lambda s: drain(
        rows(s, SF_DIR, "SELECT * FROM events", "POSTGRES", {"props": "jsonb"})
    ),
    "profile_lineitem": lambda s: drain(rows(s, SF_DIR, LINES, "POSTGRES", {"l_extendedprice": "numeric"})),
    **{name: named(name) for name in (
        "q03_order_offset", "q07_top_n", "pg_numeric_trunc", "pg_json_canonical", "pg_json_nested", "pg_timestamp_ms",
        "odbc_decimal_text", "odbc_invalid_timestamp", "odbc_text", "ora_number_text", "ora_tz_drop", "ora_long_binary",
        "jdbc_orders_roundtrip", "jdbc_partitioned_read", "parts_manifest", "partition_dirs", "json_rows",
        "encrypted_roundtrip",
    )},
}


def main():
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]").appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    wanted = sys.argv[1:] or list(BENCHES)
    seconds, once, begun = {}, [], time.perf_counter()
    for name in wanted:
        BENCHES[name](spark)  # first run compiles
        taken = []
        late = time.perf_counter() - begun > BUDGET
        once += [name] if late else []
        for _ in range(1 if late else RUNS):
            started = time.perf_counter()
            BENCHES[name](spark)
            taken.append(time.perf_counter() - started)
        seconds[name] = round(statistics.median(taken), 3)
    print(json.dumps({
        "metric": "total_seconds_median_of_runs", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": Path(SF_DIR).name.removeprefix("sf"), "cpus": int(CPUS), "runs": RUNS,
        "timed_once": once,
        "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
