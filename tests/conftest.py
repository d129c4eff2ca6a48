import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

SF_DIR = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]").appName("tapline-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("scratch")))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    for path in sorted(SF_DIR.glob("*.parquet")):
        session.read.parquet(str(path)).createOrReplaceTempView(path.stem)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def values(spark):
    """Rows of one column under a column rule: values([...], "string", rule) -> results in order."""

    def run(rows, kind, rule):
        from pyspark.sql import functions as F

        df = spark.createDataFrame([(i, v) for i, v in enumerate(rows)], f"i int, x {kind}").coalesce(1)
        return [r[0] for r in df.sortWithinPartitions("i").select(rule(F.col("x"))).collect()]

    return run
