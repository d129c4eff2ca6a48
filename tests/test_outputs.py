"""JSON rows, encrypted parts, many tables."""

import base64
import datetime as dt
from decimal import Decimal as D
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import tapline
from tapline import ExtractionError, ExtractOptions, json_rows, read_encrypted, rows_as_dicts, write_parts


def test_json_texts(spark):
    df = spark.createDataFrame(
        [(1, "é\"\n", True, 1.5, b"\xff\x00", dt.date(2024, 1, 2), dt.datetime(2024, 1, 2, 3, 4, 5, 120000), D("1.50"), 7),
         (None,) * 9,
         (2, "", False, float("nan"), b"", dt.date(1969, 1, 1), dt.datetime(2024, 1, 2, 3, 4, 5), D("-2.25"), 2**40),
         (3, "x", None, float("inf"), None, None, None, None, None)],
        "i int, s string, b boolean, f double, r binary, d date, t timestamp_ntz, n decimal(10,2), l bigint",
    ).coalesce(1)
    assert [r.json for r in json_rows(df).collect()] == [
        '{"i":1,"s":"é\\"\\n","b":true,"f":1.5,"r":"ff00","d":"2024-01-02","t":"2024-01-02T03:04:05.120","n":1.5,"l":7}',
        "{}",
        '{"i":2,"s":"","b":false,"f":null,"r":"","d":"1969-01-01","t":"2024-01-02T03:04:05","n":-2.25,"l":1099511627776}',
        '{"i":3,"s":"x","f":null}',
    ]


def test_dicts(spark):
    df = spark.sql(
        "select 1 a, cast(null as int) b, double('nan') c, cast(12 as decimal(38,0)) d, "
        "cast('99999999999999999999' as decimal(38,0)) e, array(1, 2) f, float(1.1) g, 'x' `odd \"name`"
    )
    assert rows_as_dicts(df) == [
        {"a": 1, "c": None, "d": 12, "e": 1e20, "f": "[1,2]", "g": 1.1, 'odd "name': "x"}
    ]


def test_exact_decimals_are_kept_as_texts_of_the_number(spark):
    df = spark.sql("select cast('1.10' as decimal(38,2)) a")
    assert json_rows(df, exact_decimals=True).first().json == '{"a":1.10}'
    assert json_rows(df).first().json == '{"a":1.1}'


def test_time_of_day(spark):
    df = tapline.normalise(spark.sql("select '09:05:07.9' t, cast(null as string) u"), "ODBC", {"t": "time", "u": "time"})
    assert json_rows(df).first().json == '{"t":"09:05:07"}'


def test_instants_are_utc(spark):
    df = spark.sql("select timestamp'2024-01-01 10:00:00.5+07:00' t, timestamp'2024-01-01 10:00:00+07:00' u")
    assert json_rows(df).first().json == '{"t":"2024-01-01T03:00:00.500","u":"2024-01-01T03:00:00"}'


def test_scratch_folder():
    from tapline import session

    class Fake:
        def __init__(self, **settings):
            self.settings = {"spark.sql.warehouse.dir": "hdfs://lake/warehouse/", **settings}
            self.conf = self.sparkContext = self

        def get(self, key, default=None):
            return self.settings.get(key, default)

        def getCheckpointDir(self):
            return None

    assert session.scratch_root(Fake(**{"spark.checkpoint.dir": "hdfs://shared/"})) == "hdfs://shared"
    assert session.scratch_root(Fake()) == "hdfs://lake/warehouse/tapline-scratch"


def test_exact_decimals_in_dicts(spark):
    from decimal import Decimal

    df = spark.sql("SELECT CAST('12345678901234567890.1234567890' AS DECIMAL(38,10)) AS d")
    assert rows_as_dicts(df, exact_decimals=True) == [{"d": Decimal("12345678901234567890.1234567890")}]
    assert isinstance(rows_as_dicts(df)[0]["d"], float)


def test_dicts_guard(spark):
    assert len(rows_as_dicts(spark.range(10), max_rows=10)) == 10
    with pytest.raises(ExtractionError, match="more than 9 rows"):
        rows_as_dicts(spark.range(10), max_rows=9)
    # Ten texts of eight bytes each.
    assert len(rows_as_dicts(spark.range(10), max_bytes=80)) == 10
    with pytest.raises(ExtractionError, match=r"more than 79 bytes of JSON \(after 9 rows\)"):
        rows_as_dicts(spark.range(10), max_bytes=79)
    assert len(rows_as_dicts(spark.range(10), max_bytes=None)) == 10
    with pytest.raises(ExtractionError, match="bytes of JSON"):
        tapline.read_to_json(tapline.SESSION_TABLES, "select id from range(100)", "ODBC", spark=spark, max_bytes=100)


def test_duplicate_names(spark):
    with pytest.raises(ExtractionError, match="duplicate"):
        json_rows(spark.sql("select 1 a, 2 a"))


def new_keys(spark):
    """A key pair of our own: (public PEM, private PEM)."""
    jvm = spark._jvm
    generator = jvm.java.security.KeyPairGenerator.getInstance("RSA")
    generator.initialize(2048)
    pair = generator.generateKeyPair()
    factory = jvm.java.security.KeyFactory.getInstance("RSA")

    def pem(kind, key, spec):
        encoded = factory.getKeySpec(key, jvm.java.lang.Class.forName(f"java.security.spec.{spec}")).getEncoded()
        body = base64.encodebytes(bytes(encoded)).decode()
        return f"-----BEGIN {kind} KEY-----\n{body}-----END {kind} KEY-----\n"

    return pem("PUBLIC", pair.getPublic(), "X509EncodedKeySpec"), pem("PRIVATE", pair.getPrivate(), "PKCS8EncodedKeySpec")


@pytest.fixture(scope="module")
def rsa(spark):
    return new_keys(spark)


def encrypted(spark, df, tmp_path, rsa, table="t", **more):
    options = ExtractOptions(str(tmp_path / "d"), table, str(tmp_path / "l"), 0, encryption_key=rsa[0],
                             batch_size=more.pop("batch_size", 20), **more)
    result = write_parts(df, options)
    return result, sorted(str(p) for p in (tmp_path / "d" / table).rglob("*.encrypted"))


@pytest.mark.parametrize("order", [(), ("event_id",)])
def test_encrypted_round_trip(spark, tmp_path, rsa, order):
    df = tapline.normalise(spark.table("events"), "POSTGRES", {"props": "jsonb"})
    result, files = encrypted(spark, df, tmp_path, rsa, order_by=order)
    assert result.rows == 1000 and [Path(f).name for f in files] == [f"{i:06d}.parquet.encrypted" for i in range(5)]
    assert all(Path(f).read_bytes()[:8] == b"TAPLENV1" and b"PAR1" not in Path(f).read_bytes() for f in files)
    back = read_encrypted(spark, files, rsa[1])
    assert back.dtypes == df.dtypes
    assert back.exceptAll(df).count() == 0 and df.exceptAll(back).count() == 0
    if order:
        assert [[r.event_id for r in read_encrypted(spark, [f], rsa[1], partial=True).collect()] for f in files] == [
            list(range(a, a + 200)) for a in range(0, 1000, 200)
        ]


def test_encrypted_parts_of_many_frames(spark, tmp_path, rsa, monkeypatch):
    from tapline.operators import envelope

    monkeypatch.setattr(envelope, "FRAME_BYTES", 500)
    df = spark.table("documents").select("doc_id", "text")
    _, files = encrypted(spark, df, tmp_path, rsa, order_by=("doc_id",), batch_size=5)
    assert len(files) == 4
    assert read_encrypted(spark, files, rsa[1]).exceptAll(df).count() == 0


def test_encrypted_folders_and_empty(spark, tmp_path, rsa):
    dated, folders = tapline.api.with_date_folders(spark.table("events"), "ts")
    result, files = encrypted(spark, dated, tmp_path, rsa, dir_columns=folders, order_by=("event_id",))
    assert result.rows == 1000 and all("/year=2024/month=" in f for f in files)
    assert read_encrypted(spark, files, rsa[1]).count() == 1000
    result, files = encrypted(spark, spark.range(10).where("id < 0"), tmp_path, rsa, "empty")
    assert result.rows == 0 and len(files) == 1 and read_encrypted(spark, files, rsa[1]).count() == 0


@pytest.mark.parametrize("damage", ["flip", "cut", "header", "swap"])
def test_damaged_parts_do_not_open(spark, tmp_path, rsa, damage, monkeypatch):
    from tapline.operators import envelope

    monkeypatch.setattr(envelope, "FRAME_BYTES", 500)
    _, files = encrypted(spark, spark.range(500).selectExpr("id", "uuid() u"), tmp_path, rsa, order_by=("id",))
    raw = bytearray(Path(files[0]).read_bytes())
    head = 12 + int.from_bytes(raw[8:12], "big")
    if damage == "flip":
        raw[-40] ^= 1
    elif damage == "cut":
        del raw[head + 4 + int.from_bytes(raw[head:head + 4], "big"):]
    elif damage == "header":
        del raw[head:]
    else:
        other = Path(files[1]).read_bytes()
        raw = bytearray(other[:12 + int.from_bytes(other[8:12], "big")]) + raw[head:]
    Path(files[0]).write_bytes(raw)
    with pytest.raises(Exception):
        read_encrypted(spark, files[:1], rsa[1], partial=True).collect()


@pytest.mark.parametrize("damage", ["missing", "repeated", "swapped", "foreign", "seal", "number"])
def test_parts_are_a_set(spark, tmp_path, rsa, damage):
    df = spark.range(100)
    _, files = encrypted(spark, df, tmp_path, rsa, order_by=("id",), batch_size=2, prefix="p1")
    _, others = encrypted(spark, df, tmp_path, rsa, "other", order_by=("id",), batch_size=2, prefix="p1")
    assert read_encrypted(spark, files[::-1], rsa[1]).count() == 100
    assert not [r for r in spark.read.format("binaryFile").load(str(tmp_path / "d/t")).collect() if r.path.endswith("seal")]
    seal = tmp_path / "d/t/_p1parts.seal"
    if damage == "missing":
        files = files[:3] + files[4:]
    elif damage == "repeated":
        files = files[:4] + files[:1]
    elif damage == "swapped":
        one, two = Path(files[0]).read_bytes(), Path(files[1]).read_bytes()
        Path(files[0]).write_bytes(two)
        Path(files[1]).write_bytes(one)
    elif damage == "foreign":
        Path(files[2]).write_bytes(Path(others[2]).read_bytes())
    elif damage == "seal":
        seal.unlink()
    else:
        seal.write_text(seal.read_text().replace('"parts": 5', '"parts": 4'))
        files = files[:4]
    with pytest.raises(Exception, match="not the|another run|no seal"):
        read_encrypted(spark, files, rsa[1]).count()
    if damage != "repeated":
        assert read_encrypted(spark, files, rsa[1], partial=True).count() in (80, 100)


def test_keys_must_fit(spark, tmp_path, rsa):
    with pytest.raises(ExtractionError, match="not an RSA public key"):
        encrypted(spark, spark.range(5), tmp_path, ("nonsense", ""))
    _, files = encrypted(spark, spark.range(5), tmp_path, rsa)
    with pytest.raises(ExtractionError, match="does not open"):
        read_encrypted(spark, files, new_keys(spark)[1])


def test_the_key_is_in_no_plan(spark, tmp_path, rsa, monkeypatch):
    from tapline.operators import envelope

    frames = type(spark.range(1))
    key, plans, collect = b"0123456789abcdef" * 2, [], frames.collect
    monkeypatch.setattr(envelope.os, "urandom", lambda n: key[:n])

    def seen(df):
        plans.append(df._jdf.queryExecution().toString())
        return collect(df)

    monkeypatch.setattr(frames, "collect", seen)
    encrypted(spark, spark.range(5), tmp_path, rsa)
    text = "".join(plans)
    assert "aes_encrypt" in text and "0123456789abcdef" not in text and key.hex() not in text.lower()


def test_many_tables(spark, tmp_path):
    jobs = [
        {"query": "select * from orders", "table_dir": "orders", "total_size": 1500, "order_by": "o_orderkey"},
        {"query": "select * from nowhere", "table_dir": "nowhere", "total_size": 0},
        {"query": "select * from customer", "table_dir": "customer", "total_size": 150},
    ]
    got = tapline.extract_many(
        spark, jobs, connection_string=tapline.SESSION_TABLES, datasource_type="ODBC",
        base_dir=str(tmp_path / "d"), log_dir=str(tmp_path / "l"),
    ).collect()
    assert [(r.table_dir, r.num_records) for r in got] == [("orders", 1500), ("nowhere", None), ("customer", 150)]
    assert got[0].error is None and "nowhere" in got[1].error
    config = spark.createDataFrame([("select * from region", "region", 5)], "query string, table_dir string, total_size int")
    again = tapline.extract_many(
        spark, config, connection_string=tapline.SESSION_TABLES, datasource_type="ORACLE",
        base_dir=str(tmp_path / "d"), log_dir=str(tmp_path / "l"),
    ).first()
    assert again.num_records == 5


def test_drop_in_call(spark, tmp_path):
    rows = tapline.read_to_parquet(
        tapline.SESSION_TABLES, "SELECT event_id, ts, props FROM events;", str(tmp_path / "d"),
        "sales/year=2031/month=11/day=30", str(tmp_path / "l"), 1000, "POSTGRES", 30, None, None, None, "pre",
    )
    assert rows == 1000 and (tmp_path / "l/sales_2031_11_30.csv").exists()
    assert {p.name[:3] for p in (tmp_path / "d/sales/year=2031/month=11/day=30").iterdir()} == {"pre"}
    assert tapline.read_to_json(tapline.SESSION_TABLES, "select r_regionkey from region where r_regionkey = 1",
                                "POSTGRES") == [{"r_regionkey": 1}]


def test_staging_reads_the_query_once(spark, tmp_path):
    rows = tapline.read_to_parquet(
        tapline.SESSION_TABLES, "select cast(rand() * 1e15 as bigint) * 1000 + event_id % 1000 k from events",
        str(tmp_path / "d"), "t", str(tmp_path / "l"), 1000, "ODBC", batch_size=10, order_by="k",
    )
    files = sorted((tmp_path / "d/t").iterdir())
    keys = [r.k for f in files for r in spark.read.parquet(str(f)).collect()]
    assert rows == 1000 and len(files) == 10 and keys == sorted(keys)
