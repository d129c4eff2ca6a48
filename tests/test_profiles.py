"""Type profiles: what a source type becomes."""

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

import tapline
from tapline import ExtractionError, Switches, normalise
from tapline.plans.declared import parse


def typed(spark, profile, sql, declared=None, switches=Switches()):
    """{column: (type, value, metadata)} of a one-row query."""
    df = normalise(spark.sql(sql), profile, declared, switches)
    row = df.first()
    return {f.name: (f.dataType.simpleString(), row[f.name], f.metadata) for f in df.schema.fields}


def test_type_texts():
    assert (parse("NUMBER(20,4)").name, parse("NUMBER(20,4)").args) == ("number", (20, 4))
    assert (parse("timestamp(6) with time zone").name, parse("timestamp(6) with time zone").args) == (
        "timestamp with time zone", (6,)
    )
    assert parse("VARCHAR () FOR BIT DATA").name == "varchar for bit data"
    assert parse("varchar2(20 char)").args == (20,)
    assert parse("int4").name == "int4" and parse("double precision").name == "double precision"
    assert parse("number(5,-2)").args == (5, -2)


def test_postgres(spark):
    got = typed(
        spark, "POSTGRES",
        """select 1S i2, 2 i4, 3L i8, 1.5F f4, 2.5D f8, true b, cast('-1.00000000009' as decimal(38,18)) num,
        'x' t, '{"b":1.0,"a":2}' j, timestamp_ntz'1969-12-31 23:59:59.123999' ts, timestamp'2024-01-01 00:00:00.1239Z' tz,
        date'2024-01-02' d, x'00ff' raw, array(1,2) arr, 'vc' vc, 'Tru' ch, '12345.678901234567' numtext""",
        {"j": "jsonb", "vc": "varchar(10)", "ch": "char", "numtext": "numeric(30,12)"},
    )
    ts = dt.datetime
    assert got == {
        "i2": ("smallint", 1, {}), "i4": ("int", 2, {}), "i8": ("bigint", 3, {}), "f4": ("float", 1.5, {}),
        "f8": ("double", 2.5, {}), "b": ("boolean", True, {}),
        "num": ("decimal(38,10)", D("-1.0000000000"), {}), "t": ("string", "x", {}),
        "j": ("string", '{"a":2,"b":1.0}', {"json": "true"}),
        "ts": ("timestamp_ntz", ts(1969, 12, 31, 23, 59, 59, 123000), {}),
        "tz": ("timestamp_ntz", ts(2024, 1, 1, 0, 0, 0, 123000), {}),
        "d": ("date", dt.date(2024, 1, 2), {}), "raw": ("binary", b"\x00\xff", {}), "arr": ("string", "[1,2]", {}),
        "vc": ("string", "vc", {}), "ch": ("string", "Tru", {}),
        "numtext": ("decimal(38,10)", D("12345.6789012345"), {}),
    }


def test_postgres_binary_fallback(spark):
    got = typed(
        spark, "POSTGRES",
        "select 'é' vc, '00112233-4455-6677-8899-aabbccddeeff' u, timestamp_ntz'1970-01-01 10:11:12' t, 'text' s",
        {"vc": "varchar", "u": "uuid", "t": "time"}, Switches(binary_fallback=True),
    )
    assert got["vc"][:2] == ("binary", "é".encode())
    assert got["u"][1] == bytes.fromhex("00112233445566778899aabbccddeeff")
    assert got["t"][1] == b"10:11:12.000000"
    assert got["s"][:2] == ("string", "text")


def test_odbc(spark):
    got = typed(
        spark, "ODBC",
        """select 1 i, 2 s, 3L b, 4 t, true bit, 1.5D r, 1.5D f24, 1.5D f53, 1.5D dbl, 12 d2, 123456789 d9,
        123456789012345678 d18, '12.34567' d20, '1' d40, 1234 neg, '2024-13-01' badd, '2024-01-02' d,
        '2024-01-01 25:00:00' badts, timestamp_ntz'2024-01-02 03:04:05.678999' ts, '10:11:12.9' tm,
        timestamp_ntz'1970-01-01 10:11:12.9' tm2, 'abcdef' v, x'610062000000' w, x'0102' vb, x'0304' bin,
        'g' guid, 'u' unk""",
        {
            "i": "integer", "s": "smallint", "b": "bigint", "t": "tinyint", "bit": "bit", "r": "real",
            "f24": "float(24)", "f53": "float(53)", "dbl": "double", "d2": "decimal(2,0)", "d9": "numeric(9,0)",
            "d18": "decimal(18,0)", "d20": "decimal(20,4)", "d40": "decimal(40,2)", "neg": "decimal(5,-2)",
            "badd": "date", "d": "date", "badts": "timestamp(6)", "ts": "timestamp", "tm": "time",
            "tm2": "time", "v": "varchar(20)", "w": "nvarchar(10)", "vb": "varbinary(10)", "bin": "binary(2)",
            "guid": "uniqueidentifier", "unk": "sql_variant",
        },
    )
    stamp = dt.datetime
    second = {"time_unit": "second"}
    assert got == {
        "i": ("int", 1, {}), "s": ("smallint", 2, {}), "b": ("bigint", 3, {}), "t": ("tinyint", 4, {}),
        "bit": ("boolean", True, {}), "r": ("float", 1.5, {}), "f24": ("float", 1.5, {}),
        "f53": ("double", 1.5, {}), "dbl": ("double", 1.5, {}), "d2": ("decimal(2,0)", D(12), {}),
        "d9": ("decimal(9,0)", D(123456789), {}), "d18": ("decimal(18,0)", D(123456789012345678), {}),
        "d20": ("decimal(20,4)", D("12.3456"), {}), "d40": ("string", "1", {}), "neg": ("decimal(7,0)", D(1234), {}),
        "badd": ("date", dt.date(1970, 1, 1), {}), "d": ("date", dt.date(2024, 1, 2), {}),
        "badts": ("timestamp_ntz", stamp(1970, 1, 1), {}),
        "ts": ("timestamp_ntz", stamp(2024, 1, 2, 3, 4, 5, 678000), {}), "tm": ("int", 36672, second),
        "tm2": ("int", 36672, second), "v": ("string", "abcdef", {}), "w": ("string", "ab\x00", {}),
        "vb": ("binary", b"\x01\x02", {}), "bin": ("binary", b"\x03\x04", {}), "guid": ("string", "g", {}),
        "unk": ("binary", b"u", {}),
    }


def test_odbc_text_cap_is_only_applied_when_asked_for(spark):
    sql = "select repeat('é', 50) v, unhex(repeat('ff', 50)) b"
    whole = typed(spark, "ODBC", sql)
    assert len(whole["v"][1]) == 50 and len(whole["b"][1]) == 50
    capped = typed(spark, "ODBC", sql, switches=Switches(max_text_len=40))
    assert capped["v"][1] == "é" * 40 and capped["b"][1] == b"\xff" * 40


def test_oracle(spark):
    got = typed(
        spark, "ORACLE",
        """select 'a' v, x'ff61' bad, cast(12.5 as decimal(20,4)) n, '-1.23456' ntext, 'oops' nbad, '1e5' free,
        '12.5' flt, 1.5D bd, 1.5F bf, timestamp_ntz'2024-01-02 03:04:05.678999' d, date'2024-01-02' dd,
        '2024-01-02 03:04:05.678999 +07:00' tz, '2024-13-02 00:00:00' badts, 'long text' lng, x'0102' raw, '{}' js,
        7L big, 12 n0""",
        {
            "bad": "varchar2(10)", "n": "number(20,4)", "ntext": "number(20,4)", "nbad": "number(5,0)",
            "free": "number", "flt": "float(126)", "bd": "binary_double", "bf": "binary_float", "d": "date",
            "tz": "timestamp(6) with time zone", "badts": "timestamp(6)", "lng": "long", "raw": "raw(10)",
            "js": "json", "n0": "number(0,0)",
        },
    )
    fixed, free = {"is_free_size_number": "false"}, {"is_free_size_number": "true"}
    moment = dt.datetime(2024, 1, 2, 3, 4, 5, 678000)
    assert got == {
        "v": ("string", "a", fixed), "bad": ("string", "\ufffda", fixed),
        "n": ("decimal(20,4)", D("12.5000"), fixed), "ntext": ("decimal(20,4)", D("-1.2345"), fixed),
        "nbad": ("decimal(5,0)", None, fixed), "free": ("double", 100000.0, free), "flt": ("double", 12.5, free),
        "bd": ("double", 1.5, fixed), "bf": ("float", 1.5, fixed), "d": ("timestamp_ntz", moment, fixed),
        "dd": ("timestamp_ntz", dt.datetime(2024, 1, 2), fixed), "tz": ("timestamp_ntz", moment, fixed),
        "badts": ("timestamp_ntz", None, fixed), "lng": ("binary", b"long text", fixed),
        "raw": ("binary", b"\x01\x02", fixed), "js": ("string", "{}", fixed), "big": ("decimal(19,0)", D(7), fixed),
        "n0": ("decimal(38,0)", D(12), fixed),
    }


@pytest.mark.parametrize("kind", ["rowid", "interval year(2) to month", "boolean", "ref cursor"])
def test_oracle_refuses_before_reading(spark, kind):
    with pytest.raises(ExtractionError, match="Extractor does not support Oracle Type") as err:
        normalise(spark.sql("select raise_error('read') c"), "ORACLE", {"c": kind})
    assert err.value.kind == "not_implemented"


def test_number_outside_fixed_point_is_free(spark):
    got = typed(spark, "ORACLE", "select '150' a, '0.00012' b", {"a": "number(3,-1)", "b": "number(3,5)"})
    assert got["a"][:2] == ("double", 150.0) and got["b"][:2] == ("double", 0.00012)


@pytest.mark.parametrize("profile", ["POSTGRES", "ODBC"])
def test_nulls_stay_null(spark, profile):
    sql = ("select cast(null as int) i, cast(null as string) s, cast(null as decimal(20,12)) d, cast(null as binary) b,"
           " cast(null as timestamp_ntz) t, cast(null as date) dt, cast(null as boolean) o, cast(null as string) j,"
           " cast(null as string) n, cast(null as string) sd")
    declared = {"POSTGRES": {"j": "jsonb", "n": "numeric"},
                "ODBC": {"n": "decimal(10,2)", "sd": "date", "t": "timestamp"}}
    assert set(normalise(spark.sql(sql), profile, declared[profile]).first()) == {None}


def test_declared_names_must_exist(spark):
    with pytest.raises(ValueError, match="do not exist"):
        normalise(spark.sql("select 1 a"), "ODBC", {"b": "integer"})


def test_reports(spark):
    from tapline.functions import decimal_from_text
    from tapline.plans.profiles import over_length_counts, unparsed_counts

    df = spark.createDataFrame([("abc", "1"), ("a", "x"), (None, None)], "a string, b string")
    assert {tuple(r) for r in over_length_counts(df, 2).collect()} == {("a", 1), ("b", 0)}
    assert over_length_counts(spark.range(1), 2).collect() == []
    assert [tuple(r) for r in unparsed_counts(df, {"b": decimal_from_text(F.col("b"), 10, 0)}).collect()] == [("b", 1)]


def test_profiles_are_one_projection_over_a_pruned_scan(spark):
    df = normalise(spark.table("events"), "POSTGRES").select("ts")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<ts:timestamp_ntz>" in plan and "Exchange" not in plan


def test_unknown_datasource():
    with pytest.raises(ExtractionError) as err:
        tapline.ConnectionOptions("x", "select 1", "MYSQL")
    assert str(err.value) == "Not Implemented error: Datasource MYSQL is not supported"
