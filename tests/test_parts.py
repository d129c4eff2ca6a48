"""Numbered parts, manifests and commit behaviour."""

import datetime as dt
import math
import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import tapline
from tapline import ExtractionError, ExtractOptions, write_parts
from tapline.operators import paths
from tapline.plans import layout


def options(folder, table="t", batch=10, **more):
    return ExtractOptions(str(folder / "data"), table, str(folder / "log"), more.pop("total_size", 0),
                          batch_size=batch, **more)


def part_files(folder, table="t"):
    root = Path(folder) / "data" / table
    return sorted(str(p.relative_to(root)) for p in root.rglob("*") if p.is_file())


def ids_by_part(spark, folder, table="t", column="id"):
    """Ids of each part in file order; each file is read by one task."""
    df = spark.read.parquet(str(folder / "data" / table)).select("_metadata.file_name", column)
    found = {name: [] for name in part_files(folder, table)}
    for name, value in df.collect():
        found[name].append(value)
    return list(found.values())


def shuffled(spark, rows, parts=5):
    """Ids 0..rows-1 in no order."""
    return spark.range(rows, numPartitions=parts).select(
        "id", (F.col("id") % 3).alias("three"), F.hash("id").cast("string").alias("text")
    ).orderBy(F.xxhash64("id"))


# One part holds 100 rows here.
@pytest.mark.parametrize("rows", [0, 1, 99, 100, 101, 1000, 1234])
def test_ordered_parts_are_exact(spark, tmp_path, rows):
    result = write_parts(shuffled(spark, rows), options(tmp_path, order_by=("id",)))
    expected = [list(range(a, min(a + 100, rows))) for a in range(0, rows, 100)] or [[]]
    assert ids_by_part(spark, tmp_path) == expected
    assert part_files(tmp_path) == [f"{i:06d}.parquet" for i in range(len(expected))]
    assert (result.rows, result.parts) == (rows, len(expected))


def test_many_parts_per_task(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(layout, "ROWS_PER_TASK", 10)
    write_parts(shuffled(spark, 5003), options(tmp_path, batch=2, order_by=("id",), max_write_tasks=7))
    assert ids_by_part(spark, tmp_path) == [list(range(a, min(a + 20, 5003))) for a in range(0, 5003, 20)]


def test_task_starts_are_part_starts_and_bounded():
    folders = [layout.Folder(("a",), 55), layout.Folder(("b",), 1000), layout.Folder(("c",), 3)]
    for tasks in (1, 2, 5, 40, 107):
        starts = layout._task_starts(folders, 10, 1058, tasks)
        assert len(starts) < tasks or tasks == 1 and not starts
        assert starts == sorted(set(starts))
        part_starts = {*range(0, 55, 10), *range(55, 1055, 10), 1055}
        assert set(starts) <= part_starts


@pytest.mark.parametrize("order", [("three", "id"), ("text", "id"), ("half", "id"), ("day", "id"), ("ts", "id"),
                                   ("dec", "id"), ("raw", "id"), ("flag", "id"), ("maybe", "id")])
def test_composite_keys_of_every_type(spark, tmp_path, order):
    df = shuffled(spark, 700).selectExpr(
        "*", "id / 2 - 100 AS half", "date'2024-01-01' + cast(id % 50 as int) AS day",
        "timestamp'2024-01-01 00:00:00.000001' + make_interval(0,0,0,0,0,0,id % 90 / 1000) AS ts",
        "cast(id % 17 as decimal(20,4)) AS dec", "unhex(hex(id % 40)) AS raw", "id % 2 = 0 AS flag",
        "CASE WHEN id % 4 > 0 THEN concat('é\"', id % 7) END AS maybe",
    )
    write_parts(df, options(tmp_path, order_by=order))
    expected = [r["id"] for r in df.orderBy(*order).collect()]
    assert ids_by_part(spark, tmp_path) == [expected[a:a + 100] for a in range(0, 700, 100)]


def test_hot_leading_key_is_split(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(layout, "ROWS_PER_TASK", 100)
    df = spark.range(3000).select("id", F.when(F.col("id") < 2000, 7).otherwise(F.col("id") % 50).alias("hot"))
    write_parts(df, options(tmp_path, order_by=("hot", "id")))
    expected = [r["id"] for r in df.orderBy("hot", "id").collect()]
    assert ids_by_part(spark, tmp_path) == [expected[a:a + 100] for a in range(0, 3000, 100)]


def test_order_key_that_repeats_is_cut_exactly(spark, tmp_path):
    write_parts(shuffled(spark, 1000), options(tmp_path, order_by=("three",)))
    parts = ids_by_part(spark, tmp_path)
    assert [len(p) for p in parts] == [100] * 10
    assert sorted(i for p in parts for i in p) == list(range(1000))


def test_a_key_shared_by_a_third_of_all_rows_is_cut_across_tasks(spark, tmp_path):
    df = spark.range(3000).select("id", F.when(F.col("id") < 1000, -1).otherwise(F.col("id")).alias("k"))
    write_parts(df, options(tmp_path, order_by=("k",)))
    parts = ids_by_part(spark, tmp_path)
    assert [len(p) for p in parts] == [100] * 30 and sorted(i for p in parts[:10] for i in p) == list(range(1000))
    assert [i for p in parts[10:] for i in p] == list(range(1000, 3000))


@pytest.mark.parametrize("kinds, order", [(3, ("k",)), (1, ("k",)), (15, ("k DESC", "v")), (1000, ("v", "k"))])
def test_equal_rows_are_cut_exactly(spark, tmp_path, monkeypatch, kinds, order):
    monkeypatch.setattr(layout, "ROWS_PER_TASK", 100)
    monkeypatch.setattr(layout, "_COPIES", 7)
    df = spark.range(1000, numPartitions=7).selectExpr(
        f"id % {kinds} AS k", "'v' AS v", "map(1, 'x') AS m").drop("d")
    assert write_parts(df, options(tmp_path, order_by=order)).rows == 1000
    down = "DESC" in order[0]
    expected = sorted((i % kinds for i in range(1000)), reverse=down)
    assert ids_by_part(spark, tmp_path, column="k") == [expected[a:a + 100] for a in range(0, 1000, 100)]


def test_zeros_of_both_signs_are_not_equal_rows(spark, tmp_path):
    df = spark.createDataFrame([(1, 0.0 if i % 3 else -0.0) for i in range(300)], "k int, d double").repartition(3)
    write_parts(df, options(tmp_path, order_by=("k",)))
    found = [math.copysign(1, r.d) for r in spark.read.parquet(str(tmp_path / "data/t")).collect()]
    assert (found.count(-1), found.count(1)) == (100, 200)


@pytest.mark.parametrize("repeats", [1, 4])
def test_a_third_of_all_rows_is_one_row(spark, tmp_path, monkeypatch, repeats):
    monkeypatch.setattr(layout, "ROWS_PER_TASK", 100)
    monkeypatch.setattr(layout, "RANK_ROWS", 50)
    df = spark.range(3000, numPartitions=6).selectExpr(
        f"CASE WHEN id < 1000 THEN 500 ELSE floor(id / {repeats}) END AS id", "CASE WHEN id < 1500 THEN 'a' ELSE 'b' END AS t")
    write_parts(df, options(tmp_path, order_by=("t", "id DESC")))
    expected = [r["id"] for r in df.orderBy("t", F.desc("id")).collect()]
    assert ids_by_part(spark, tmp_path) == [expected[a:a + 100] for a in range(0, 3000, 100)]


@pytest.mark.parametrize("name", ["half", "text", "day", "ts", "ntz", "dec", "raw", "flag", "id", "small", "single"])
@pytest.mark.parametrize("way", ["DESC", "desc nulls first", "ASC NULLS LAST", ""])
def test_keys_that_go_down_and_nulls(spark, tmp_path, name, way):
    df = shuffled(spark, 350).selectExpr(
        "*", "CASE WHEN id % 9 = 1 THEN NULL WHEN id % 9 = 2 THEN double('NaN') WHEN id % 9 = 3 THEN -0.0 ELSE id / 2 - 100 END AS half0",
        "cast(id % 5 as float) AS single0",
        "date'1969-11-01' + cast(id % 90 as int) AS day0", "cast(id % 30 - 15 as tinyint) AS small0",
        "timestamp'1969-12-31 23:59:58.000001' + make_interval(0,0,0,0,0,0,id % 90 / 1000) AS ts0",
        "timestamp_ntz'1969-12-31 23:59:58.000001' + make_interval(0,0,0,0,0,0,id % 90 / 1000) AS ntz0",
        "cast(id % 17 - 8 as decimal(20,4)) AS dec0", "unhex(hex(id % 40)) AS raw0", "id % 2 = 0 AS flag0",
        "substring('é\"aab', 1, cast(id % 7 as int)) AS text0", "id AS id0",
    )
    df = df.selectExpr("id", f"CASE WHEN id % 8 > 0 THEN {name}0 END AS `a key`")
    write_parts(df, options(tmp_path, order_by=(f"a key {way}".strip(), "id")))
    key = layout.Order.of(f"a key {way}".strip(), df.columns)
    assert key == layout.Order("a key", "desc" in way.lower(), way in ("DESC", "ASC NULLS LAST"))
    expected = [r["id"] for r in df.orderBy(key.sorted, "id").collect()]
    assert ids_by_part(spark, tmp_path) == [expected[a:a + 100] for a in range(0, 350, 100)]


def test_the_share_of_ranked_keys_does_not_follow_the_most_buckets(spark, monkeypatch):
    for name, value in {"RANK_ROWS": 200, "MIN_BUCKETS": 2, "MAX_BUCKETS": 4, "ROWS_PER_TASK": 1000}.items():
        monkeypatch.setattr(layout, name, value)
    df = shuffled(spark, 20_000)
    sort = layout.SortKey(df, ("id",))
    ranks = [5000, 10_000, 15_001]
    buckets = layout._Buckets(df.select(*sort.columns), sort, ranks, 20_000)
    assert sum(buckets.sizes) == 20_000 and len(buckets.sizes) < 60
    assert sum(buckets.sizes[i] for i in buckets.wanted) <= 20_000 // layout.BUCKETS_PER_TASK
    assert [k[1] for k, _, _ in layout._at_ranks(df.select(*sort.columns), sort, ranks, 20_000)] == [str(r) for r in ranks]


@pytest.mark.parametrize("buckets, samples", [(1, 1), (2, 3), (64, 1)])
def test_cuts_do_not_depend_on_the_sample(spark, tmp_path, monkeypatch, buckets, samples):
    monkeypatch.setattr(layout, "MIN_BUCKETS", 1)
    monkeypatch.setattr(layout, "RANK_ROWS", 10)
    monkeypatch.setattr(layout, "BUCKETS_PER_TASK", buckets)
    monkeypatch.setattr(layout, "SAMPLES_PER_BUCKET", samples)
    write_parts(shuffled(spark, 777), options(tmp_path, order_by=("three", "id")))
    expected = sorted(range(777), key=lambda i: (i % 3, i))
    assert ids_by_part(spark, tmp_path) == [expected[a:a + 100] for a in range(0, 777, 100)]


@pytest.mark.parametrize("skipped", [0, 1, 4, 5, 9, 10, 333])
def test_skip_equal_rows(spark, skipped):
    ten = spark.range(10, numPartitions=3).selectExpr("7 AS a")
    assert layout.skip_rows(ten, ("a",), skipped).count() == max(0, 10 - skipped)
    df = spark.range(100, numPartitions=3).selectExpr("id % 3 AS a", "id % 2 AS b")
    got = [r.a for r in layout.skip_rows(df, ("a DESC",), skipped).collect()]
    assert got == sorted((i % 3 for i in range(100)), reverse=True)[skipped:]


@pytest.mark.parametrize("skipped", [0, 1, 499, 999, 1000, 2000])
def test_skip_rows(spark, skipped):
    df = layout.skip_rows(shuffled(spark, 1000), ("three", "id"), skipped)
    expected = sorted(range(1000), key=lambda i: (i % 3, i))[skipped:]
    assert [r.id for r in df.collect()] == expected


def test_without_order_key_one_partition_is_cut_in_source_order(spark, tmp_path):
    df = spark.range(250).orderBy(F.desc("id")).coalesce(1)
    write_parts(df, options(tmp_path))
    down = list(range(249, -1, -1))
    assert ids_by_part(spark, tmp_path) == [down[:100], down[100:200], down[200:]]


def test_without_order_key_nothing_is_lost(spark, tmp_path):
    result = write_parts(spark.range(1000, numPartitions=7), options(tmp_path))
    parts = ids_by_part(spark, tmp_path)
    assert sorted(i for p in parts for i in p) == list(range(1000))
    assert max(map(len, parts)) <= 100 and result.rows == 1000


@pytest.mark.parametrize("order", [(), ("id",)])
def test_empty_result(spark, tmp_path, order):
    empty = spark.range(10).where("id < 0")
    assert write_parts(empty, options(tmp_path, "file", order_by=order)).rows == 0
    assert part_files(tmp_path, "file") == ["000000.parquet"]
    assert spark.read.parquet(str(tmp_path / "data/file")).schema.names == ["id"]
    assert (tmp_path / "log/file.csv").read_text().splitlines()[1].startswith("file,0,0,")
    write_parts(empty, options(tmp_path, "none", order_by=order, empty_policy="none"))
    assert part_files(tmp_path, "none") == []
    assert (tmp_path / "log/none.csv").read_text() == (
        "OUTPUT_PATH,NUM_RECORDS,TOTAL_RECORDS,CURRENT_TIMESTAMP_UTC,PART_NUMBER\n"
    )


@pytest.mark.parametrize("order", [(), ("id",)])
def test_folders_by_date(spark, tmp_path, order):
    df = spark.range(1000).selectExpr(
        "id", "CASE WHEN id % 10 < 6 THEN date'2024-01-05' WHEN id % 10 < 9 THEN date'2023-12-31' END AS d"
    )
    dated, folders = tapline.api.with_date_folders(df, "d")
    result = write_parts(dated, options(tmp_path, dir_columns=folders, order_by=order, prefix="p"))
    hot = "year=2024/month=01/day=05"
    names = part_files(tmp_path)
    assert {n.rsplit("/", 1)[0] for n in names} == {
        hot, "year=2023/month=12/day=31", "/".join(f"{k}=__HIVE_DEFAULT_PARTITION__" for k in ("year", "month", "day")),
    }
    back = spark.read.option("basePath", str(tmp_path / "data/t")).parquet(str(tmp_path / "data/t"))
    assert back.count() == 1000 and back.where("year = 2024 and month = 1 and day = 5").count() == 600
    assert (tmp_path / "log/t_2024_01_05.csv").exists() and len(result.manifests) == 3
    if order:
        parts = [spark.read.parquet(str(tmp_path / f"data/t/{hot}/p{i:06d}.parquet")) for i in range(6)]
        expected = [i for i in range(1000) if i % 10 < 6]
        assert [[r["id"] for r in p.collect()] for p in parts] == [expected[a:a + 100] for a in range(0, 600, 100)]


def test_a_shorter_run_replaces_a_longer_one(spark, tmp_path):
    write_parts(spark.range(500), options(tmp_path, order_by=("id",)))
    other = tmp_path / "data/t/other000009.parquet"
    other.write_bytes(b"x")
    write_parts(spark.range(150), options(tmp_path, order_by=("id",)))
    assert part_files(tmp_path) == ["000000.parquet", "000001.parquet", "other000009.parquet"]
    other.unlink()
    assert ids_by_part(spark, tmp_path) == [list(range(100)), list(range(100, 150))]


def test_a_failed_run_leaves_the_earlier_one_in_place(spark, tmp_path):
    write_parts(spark.range(150), options(tmp_path))
    before = (tmp_path / "log/t.csv").read_text()
    bad = spark.range(1000).selectExpr("id", "CASE WHEN id = 999 THEN raise_error('no') ELSE 1 END AS v")
    with pytest.raises(Exception):
        write_parts(bad, options(tmp_path))
    assert sorted(len(p) for p in ids_by_part(spark, tmp_path))[-1] <= 100
    assert sum(map(len, ids_by_part(spark, tmp_path))) == 150
    assert (tmp_path / "log/t.csv").read_text() == before
    assert not [p for p in os.listdir(tmp_path / "data/t") if p.startswith(".writing")]


def test_folders_by_any_column(spark, tmp_path):
    df = spark.range(100).selectExpr("id", "concat('a b:', id % 2) kind")
    assert write_parts(df, options(tmp_path, dir_columns=("kind",))).rows == 100
    assert spark.read.parquet(str(tmp_path / "data/t")).where("kind = 'a b:1'").count() == 50
    odd = spark.range(90).selectExpr("id", "element_at(array('a b:1', 'x/y', '', null, 'ü%\"'), cast(id % 5 + 1 as int)) kind")
    found = {}
    for name, order in (("u", ()), ("v", ("id",))):
        assert write_parts(odd, options(tmp_path, name, dir_columns=("kind",), order_by=order)).rows == 90
        found[name] = {n.rsplit("/", 1)[0] for n in part_files(tmp_path, name)}
    assert found["u"] == found["v"] and "kind=x%2Fy" in found["v"] and "kind=__HIVE_DEFAULT_PARTITION__" in found["v"]


def test_duplicate_columns_are_refused(spark, tmp_path):
    with pytest.raises(ExtractionError, match="duplicate"):
        write_parts(spark.sql("select 1 a, 2 a"), options(tmp_path))


def test_files_are_snappy_parquet_1(spark, tmp_path):
    import pyarrow.parquet as pq

    write_parts(spark.range(10).selectExpr("id", "timestamp_ntz'2024-01-01 00:00:00.123' ts"), options(tmp_path))
    meta = pq.ParquetFile(tmp_path / "data/t/000000.parquet").metadata
    assert meta.row_group(0).column(0).compression == "SNAPPY"
    assert meta.row_group(0).column(0).statistics is not None


def test_manifest(spark, tmp_path):
    started = int(dt.datetime.now().timestamp() * 1000)
    result = write_parts(shuffled(spark, 250), options(tmp_path, order_by=("id",), total_size=250))
    manifest = tapline.read_manifest(spark, *result.manifests)
    rows = manifest.orderBy("part_number").collect()
    assert [(r.output_path, r.num_records, r.total_records, r.part_number) for r in rows] == [
        ("t", 100, 250, 0), ("t", 100, 250, 1), ("t", 50, 250, 2),
    ]
    assert all(started - 2000 <= r.current_timestamp_utc <= started + 600_000 for r in rows)
    steps = tapline.progress(manifest).orderBy("part_number").collect()
    assert [(s.records_so_far, s.progress) for s in steps] == [(100, 0.4), (200, 0.8), (250, 1.0)]
    assert tapline.reconcile(manifest).first().asDict() == {
        "output_path": "t", "parts": 3, "num_records": 250, "total_records": 250, "complete": True,
    }


def test_progress_over_many_blocks(spark, monkeypatch):
    from tapline.operators import manifest as m

    monkeypatch.setattr(m, "_BLOCK", 10)
    df = spark.range(95).selectExpr("'t' output_path", "id + 1 num_records", "4560L total_records",
                                    "0L current_timestamp_utc", "cast(id as int) part_number")
    got = [r.records_so_far for r in m.progress(df).orderBy("part_number").collect()]
    assert got == [sum(range(1, i + 2)) for i in range(95)]


def test_paths():
    def of(base, **more):
        return ExtractOptions(base, "sales/eu", "logs", 40, **more)

    assert paths.part_key(of("s3://lake"), 7) == "/sales/eu/000007.parquet"
    for base in ("s3://lake/raw/daily", "s3://lake/raw/daily/"):
        assert paths.part_key(of(base), 12) == "/raw/daily/sales/eu/000012.parquet"
    assert paths.part_key(of("s3://lake/a/b/", prefix="x", encryption_key="k"), 1234567) == (
        "/a/b/sales/eu/x1234567.parquet.encrypted"
    )
    assert paths.table_uri(of("s3://lake/a/")) == "s3a://lake/a/sales/eu"
    assert paths.table_uri(of("s3://lake")) == "s3a://lake/sales/eu"
    assert paths.table_uri(of("/data/")) == "/data/sales/eu"
    assert paths.table_uri(of("data")) == "data/sales/eu"
    assert paths.log_path("logs", "sales/year=2031/month=11/day=30") == "logs/sales_2031_11_30.csv"
    assert paths.log_path("logs", "T") == "logs/T.csv"


def test_the_only_full_shuffle_is_one_and_compiled(spark):
    df = shuffled(spark, 1000)
    plan = layout.plan_layout(df, (), ("id",), 100, 50)
    text = layout.arrange(spark.range(1000), (), ("id",), plan)._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange") == 1
