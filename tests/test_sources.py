"""Addresses as texts, and JDBC reads against a database inside this process (no port is opened)."""

import datetime as dt
import uuid
import warnings
from decimal import Decimal as D

import pytest

import tapline
from tapline import ConnectionOptions, ExtractionError, Split
from tapline.sources import jdbc, one_statement, read

DRIVER = "org.apache.derby.jdbc.EmbeddedDriver"


def address(text, kind, user=None, password=None):
    found = jdbc.address(ConnectionOptions(text, "select 1", kind, user, password))
    return found.url, found.driver, found.options


def test_postgres_address():
    assert address("localhost:5432/db", "POSTGRES", "u", "p@:/") == (
        "jdbc:postgresql://localhost:5432/db", "org.postgresql.Driver",
        {"user": "u", "password": "p@:/", "sslmode": "verify-full", "loginTimeout": "10"},
    )
    assert address("h/db", "POSTGRES")[2]["user"] == ""


def test_oracle_address():
    assert address("localhost/pdb1", "ORACLE", "u", "p") == (
        "jdbc:oracle:thin:@//localhost/pdb1", "oracle.jdbc.OracleDriver", {"user": "u", "password": "p"}
    )
    assert address("(DESCRIPTION=...)", "ORACLE", "u", "p")[0] == "jdbc:oracle:thin:@(DESCRIPTION=...)"
    with pytest.raises(ExtractionError, match="user_name and password"):
        address("localhost/pdb1", "ORACLE", "u")


def test_generic_addresses_take_the_login_from_the_string_only():
    assert address("Driver=/usr/lib/odbc/libmaodbc.so;Port=3307;DB=sales;ServerName=shop;Uid=reader;Pwd=w0rd;"
                   "CharSet=latin1;useCompression=true", "ODBC", "ignored", "ignored") == (
        "jdbc:mysql://shop:3307/sales", "com.mysql.cj.jdbc.Driver",
        {"useCompression": "true", "connectTimeout": "10000", "characterEncoding": "latin1", "user": "reader",
         "password": "w0rd"},
    )
    assert address("Server=tcp:store.example,1444;Driver=/opt/x/msodbcsql18/lib64/libmsodbcsql-18.so;pwd={a;=}}b};"
                   "uid=etl;encrypt=optional;dbname=stock", "ODBC") == (
        "jdbc:sqlserver://store.example:1444", "com.microsoft.sqlserver.jdbc.SQLServerDriver",
        {"loginTimeout": "10", "databaseName": "stock", "encrypt": "false", "user": "etl", "password": "a;=}b"},
    )
    assert address("Driver={IBM DB2 CLI};Host=ledger;DB=books", "ODBC")[0] == "jdbc:db2://ledger:50000/books"
    assert address("Driver={psqlODBC};Host=pg;Port=5433;DB=d", "ODBC")[2]["sslmode"] == "verify-full"
    assert address("Driver={Oracle in OraClient};DBQ=ora:1522/pdb;Uid=a;Pwd=b", "ODBC") == (
        "jdbc:oracle:thin:@//ora:1522/pdb", "oracle.jdbc.OracleDriver", {"user": "a", "password": "b"}
    )
    with pytest.raises(ExtractionError, match="no JDBC driver is known"):
        address("Driver={Nothing};Server=h", "ODBC")


def test_any_jdbc_url_is_taken_as_it_is():
    assert address("jdbc:mariadb://h/d", "ODBC") == ("jdbc:mariadb://h/d", "", {})
    given = ConnectionOptions("DSN=warehouse", "select 1", "ODBC", jdbc={"url": "jdbc:h2:/d", "driver": "org.h2.Driver"})
    options = jdbc._reader_options(given)
    assert (options["url"], options["driver"]) == ("jdbc:h2:/d", "org.h2.Driver")
    assert "driver" not in jdbc._reader_options(ConnectionOptions("jdbc:h2:/d", "select 1", "ODBC"))


def test_one_semicolon_goes():
    assert one_statement(" select 1 ; ") == "select 1"
    assert one_statement("select ';'") == "select ';'"
    assert one_statement("select 1;;") == "select 1;"


def test_secrets_do_not_show():
    conn = ConnectionOptions("Driver={MySQL};Pwd=secret1;", "q", "ODBC", "u", "secret2", jdbc={"password": "secret3"})
    assert "secret" not in repr(conn) and "secret" not in repr(jdbc._generic_address("Driver={MySQL};Pwd=secret1;"))
    from tapline.errors import as_extraction_error

    with pytest.raises(ExtractionError) as err, as_extraction_error("hunter2"):
        raise RuntimeError("at jdbc:x://u:abc@h/db;password=zzz;x=1 with hunter2")
    assert str(err.value) == "Database error: at jdbc:x://u:***@h/db;password=***;x=1 with ***"


def test_predicates_cover_every_row_once():
    assert jdbc.modulo_predicates("k", 2) == ("MOD(ABS(k), 2) = 0 OR k IS NULL", "MOD(ABS(k), 2) = 1")
    assert jdbc.range_predicates("d", ["1", "5"]) == ("d < 1 OR d IS NULL", "d >= 1 AND d < 5", "d >= 5")


@pytest.fixture(scope="module")
def database(spark):
    url = f"jdbc:derby:memory:t{uuid.uuid4().hex};create=true"
    jvm = spark._jvm
    jvm.org.apache.spark.sql.execution.datasources.jdbc.DriverRegistry.register(DRIVER)
    link = jvm.java.sql.DriverManager.getConnection(url)
    run = link.createStatement().execute
    run("create table ty (a int, b smallint, c bigint, d real, e double, f decimal(20,4), g numeric(9,0), h boolean,"
        " i char(5), j varchar(20), k long varchar, l clob, m blob, n varchar(10) for bit data, o date, p time,"
        " q timestamp, r char(3) for bit data)")
    run("insert into ty values (1,2,3,1.5,2.5,3.25,7,true,'ab','cd','ef','gh',cast(x'00ff' as blob),x'ff00',"
        "'2024-01-02','10:11:12','2024-01-02 03:04:05.123456',x'010203')")
    run("insert into ty (a) values (2)")
    run("create table numbers (k bigint, v varchar(20), day date)")
    insert = link.prepareStatement("insert into numbers values (?, ?, ?)")
    for i in range(1000):
        insert.setLong(1, i * 7 - 300)
        insert.setString(2, f"v{i}")
        insert.setString(3, f"2024-01-{i % 28 + 1:02d}") if i % 100 else insert.setNull(3, 91)
        insert.addBatch()
    insert.executeBatch()
    link.close()
    return url


def conn(database, query, **more):
    return ConnectionOptions(database, query, "ODBC", **more)


def test_every_type(spark, database):
    df = tapline.extract(spark, conn(database, "select * from ty order by a"))
    first, second = df.collect()
    assert [f.dataType.simpleString() for f in df.schema.fields] == [
        "int", "smallint", "bigint", "float", "double", "decimal(20,4)", "decimal(9,0)", "boolean", "string",
        "string", "string", "string", "binary", "binary", "date", "int", "timestamp_ntz", "binary",
    ]
    assert list(first) == [
        1, 2, 3, 1.5, 2.5, D("3.2500"), D(7), True, "ab   ", "cd", "ef", "gh", b"\x00\xff", b"\xff\x00",
        dt.date(2024, 1, 2), 36672, dt.datetime(2024, 1, 2, 3, 4, 5, 123000), b"\x01\x02\x03",
    ]
    assert list(second) == [2] + [None] * 17


def test_schema_without_rows_and_pushdown(spark, database):
    df = read(spark, conn(database, "select * from numbers"))
    assert df.schema.names == ["K", "V", "DAY"]
    plan = df.where("K > 5").select("V")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [*IsNotNull(K), *GreaterThan(K,5)]" in plan and "ReadSchema: struct<V:string>" in plan


@pytest.mark.parametrize("split", [
    Split(column="K", partitions=4), Split(column="K", lower=0, upper=100, partitions=3),
    Split(predicates=jdbc.modulo_predicates("K", 5)),
    Split(column="DAY", days=(dt.date(2024, 1, 9), dt.date(2024, 1, 5))),
])
def test_parallel_reads_are_whole(spark, database, split):
    df = read(spark, conn(database, "select * from numbers;", split=split))
    assert df.rdd.getNumPartitions() == (len(split.predicates) or split.partitions or 3)
    assert sorted(r.K for r in df.collect()) == [i * 7 - 300 for i in range(1000)]


@pytest.fixture(scope="module")
def skewed(spark, database):
    """Most keys close together, one far off, one value in a fifth of all rows, and nulls, for each type of key."""
    from pyspark.sql import functions as F

    k = F.expr("CASE WHEN id < 2400 THEN id WHEN id < 3000 THEN 700 WHEN id = 3000 THEN 1000000000 END")
    spark.range(3050).select(
        k.alias("K"), (k / 7).alias("D"), (k / 8).cast("decimal(20,3)").alias("N"), F.timestamp_seconds(k).alias("T"),
        F.date_add(F.lit("2000-01-01"), (k % 5000).cast("int")).alias("DAY"),
    ).write.jdbc(database, "SKEWED", mode="overwrite", properties={"driver": DRIVER})
    return database


@pytest.mark.parametrize("column", ["K", "D", "N", "T", "DAY"])
@pytest.mark.parametrize("parts", [2, 7])
def test_ranges_hold_about_equally_many_rows(spark, skewed, column, parts):
    df = read(spark, conn(skewed, "select * from skewed", split=Split(column=column, partitions=parts)))
    sizes = [len(part) for part in df.rdd.glom().collect()]
    assert sum(sizes) == 3050 and parts - 1 <= len(sizes) <= parts
    share = 3001 / parts
    # The first range has the nulls too, and the value of 601 rows cannot be parted.
    assert max(sizes) <= 1.4 * share + max(49, 601 - share) and min(sizes) >= 0.6 * share


def test_a_text_key_cannot_split_a_read(spark, database):
    with pytest.raises(ExtractionError, match="cannot split"):
        read(spark, conn(database, "select * from numbers", split=Split(column="V")))


def test_a_read_goes_on_where_it_stopped(spark, database, tmp_path, monkeypatch):
    from pyspark.sql import functions as F

    link = spark._jvm.java.sql.DriverManager.getConnection(database)
    run = link.createStatement().execute
    run("create table wares (k bigint, v int)")
    for i in range(60):
        run(f"insert into wares values ({i}, {i})")
    whole, broken, asked = jdbc.read, True, []

    def watched(session, given, query):
        df = whole(session, given, query)
        predicate = given.split.predicates[0] if given.split and given.split.predicates else ""
        asked.append(predicate)
        return df.where(F.raise_error(F.lit("line lost")).isNotNull()) if broken and ">= 30" in predicate else df

    monkeypatch.setattr(jdbc, "read", watched)

    def write(query="select k, v from wares"):
        return tapline.read_to_parquet(
            database, query, str(tmp_path / "d"), "t", str(tmp_path / "l"), 60, "ODBC", batch_size=1, spark=spark, order_by="K",
            split=Split(column="K", partitions=6), resume_dir=str(tmp_path / "ranges"))

    with pytest.raises(ExtractionError, match="line lost"):
        write()
    assert not (tmp_path / "d/t").exists()
    done = {p.parent.name for p in (tmp_path / "ranges").glob("*/_SUCCESS")}
    assert done == {f"range-{i:06d}" for i in (0, 1, 2, 4, 5)}
    with pytest.raises(ExtractionError, match="another query"):
        write("select k from wares")
    broken = False
    asked.clear()
    # What is staged is not read again: these rows no longer are what was read.
    run("update wares set v = -1 where k < 5")
    assert write() == 60
    assert sorted({p for p in asked if p}) == ['"K" < 10 OR "K" IS NULL', '"K" >= 30 AND "K" < 40']
    rows = spark.read.parquet(str(tmp_path / "d/t")).orderBy("K").collect()
    assert [(r.K, r.V) for r in rows] == [(i, i) for i in range(60)]
    assert not (tmp_path / "ranges").exists()


def test_empty_table_split(spark, database):
    assert read(spark, conn(database, "select * from numbers where k > 99999", split=Split(column="K"))).count() == 0


def test_read_to_parquet_in_key_order(spark, database, tmp_path):
    rows = tapline.read_to_parquet(
        database, "select k, v from numbers", str(tmp_path / "d"), "t", str(tmp_path / "l"), 1000, "ODBC",
        batch_size=30, spark=spark, order_by="K",
    )
    parts = sorted((tmp_path / "d/t").glob("*.parquet"))
    assert rows == 1000 and len(parts) == 4
    keys = [r.K for p in parts for r in spark.read.parquet(str(p)).collect()]
    assert keys == [i * 7 - 300 for i in range(1000)]


def test_a_split_column_may_need_quotes(spark, database):
    query = 'select k as "orderId", v as "select" from numbers'
    df = read(spark, conn(database, query, split=Split(column="orderId", partitions=3)))
    assert df.rdd.getNumPartitions() == 3 and sorted(r.orderId for r in df.collect()) == [i * 7 - 300 for i in range(1000)]


def test_read_to_parquet_in_cursor_order(spark, database, tmp_path):
    tapline.read_to_parquet(
        database, "select k from numbers order by k desc", str(tmp_path / "d"), "t", str(tmp_path / "l"), 1000, "ODBC",
        30, spark=spark,
    )
    parts = sorted((tmp_path / "d/t").glob("*.parquet"))
    found = [[r.K for r in spark.read.parquet(str(p)).collect()] for p in parts]
    assert [len(f) for f in found] == [300, 300, 300, 100]
    assert sum(found, []) == [i * 7 - 300 for i in reversed(range(1000))]


def test_read_to_json(spark, database):
    got = tapline.read_to_json(database, "select * from ty where a = 1", "ODBC", spark=spark)
    assert got == [{
        "A": 1, "B": 2, "C": 3, "D": 1.5, "E": 2.5, "F": 3.25, "G": 7, "H": True, "I": "ab   ", "J": "cd", "K": "ef",
        "L": "gh", "M": "00ff", "N": "ff00", "O": "2024-01-02", "P": "10:11:12", "Q": "2024-01-02T03:04:05.123",
        "R": "010203",
    }]
    assert tapline.read_to_json(database, "select * from ty where a = 2", "ODBC", spark=spark) == [{"A": 2}]
    assert tapline.read_to_json(database, "select * from ty where 1 = 0", "ODBC", spark=spark) == []


@pytest.mark.parametrize("text, query, kind", [
    ("good", "select * from nope", "database"), ("good", "selec", "database"),
    ("jdbc:derby:memory:absent", "select 1 from t", "connection"), ("Driver={MySQL};Server=h;", "select 1", "connection"),
])
def test_failures_are_told_apart(spark, database, text, query, kind):
    with pytest.raises(ExtractionError) as err:
        tapline.read_to_json(database if text == "good" else text, query, "ODBC", spark=spark)
    assert err.value.kind == kind and err.value.__cause__ is not None


def test_cut_values_are_counted(spark, database, tmp_path):
    def write(name, **more):
        return tapline.read_to_parquet(database, "select k, v, cast(v as varchar(9)) w from numbers", str(tmp_path / name), "t",
                                       str(tmp_path / "l"), 1000, "ODBC", 30, spark=spark, **more)

    with pytest.warns(UserWarning, match=r"max_text_len=3, by column: \{'V': 900, 'W': 900\}"):
        assert write("cut", max_text_len=3, order_by="K") == 1000
    assert spark.read.parquet(str(tmp_path / "cut/t")).where("length(v) > 3").count() == 0
    with warnings.catch_warnings():
        warnings.simplefilter("error", UserWarning)
        write("whole", max_text_len=4)


def test_query_shapes_on_session_tables(spark):
    def rows(query, kind="ODBC"):
        return tapline.extract(spark, ConnectionOptions(tapline.SESSION_TABLES, query, kind))

    assert rows("select * from orders order by o_orderkey limit 10").count() == 10
    assert rows("select num::NUMERIC, current_timestamp()::DATE as d, '{\"a\": \"a\"}' j "
                "from explode(sequence(1, 6)) t(num)", "POSTGRES").dtypes[1] == ("d", "date")
    assert rows("select distinct event_type from events").count() == 5
    assert rows("select * from events order by event_id offset 990").count() == 10
    assert rows("select * from events where 1 = 0").count() == 0
