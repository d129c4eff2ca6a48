"""Value rules on hand-made vectors."""

import datetime as dt
from decimal import ROUND_DOWN, Context, Decimal as D

import pytest
from hypothesis import given, settings, strategies as st

from tapline import functions as V
from tapline.errors import ExtractionError, as_extraction_error
from tapline.functions.json_text import canonicaliser


def cut(number, digits):
    """Python's own cut toward zero."""
    return number.quantize(D(1).scaleb(-digits), rounding=ROUND_DOWN, context=Context(prec=60))


def ts(text):
    return dt.datetime.fromisoformat(text)


def test_decimals_are_cut_toward_zero(values):
    rows = [D("1.00000000009"), D("-1.00000000009"), D("-0.00000000001"), None,
            D("12345678901234567890.123456789098765432"), D("5")]
    assert values(rows, "decimal(38,18)", V.truncate_decimal) == [
        D("1.0000000000"), D("-1.0000000000"), D("0E-10"), None, D("12345678901234567890.1234567890"), D("5.0000000000"),
    ]


def test_decimal_keeps_28_digits_at_scale_10(values):
    big = D("1234567890123456789012345678.0123456789")
    assert values([big, -big], "decimal(38,10)", V.truncate_decimal) == [big, -big]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.decimals(-10**15, 10**15, places=14), min_size=1, max_size=50))
def test_decimal_cut_property(values, numbers):
    got = values(numbers, "decimal(38,14)", V.truncate_decimal)
    assert got == [cut(n, 10) for n in numbers]


def test_decimal_from_text(values):
    rows = ["-0.5", "12.30", "bad", "", "1.23456", "-1.23456", None, "1e5", " 5", ".5", "5.", "+7",
            "12345678901234567890123456789012345.99999"]
    assert values(rows, "string", lambda c: V.decimal_from_text(c, 38, 3)) == [
        D("-0.500"), D("12.300"), None, None, D("1.234"), D("-1.234"), None, None, None, None, None, D("7.000"),
        D("12345678901234567890123456789012345.999"),
    ]
    assert values(["1.9", "-1.9", "42"], "string", lambda c: V.decimal_from_text(c, 10, 0)) == [D(1), D(-1), D(42)]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.decimals(-10**9, 10**9, places=7), min_size=1, max_size=50))
def test_decimal_text_property(values, numbers):
    texts = [format(n, "f") for n in numbers]
    got = values(texts, "string", lambda c: V.decimal_from_text(c, 38, 4))
    assert got == [cut(n, 4) for n in numbers]


def test_double_from_text(values):
    rows = ["1.5", "1e5", "-.5", "5.", "bad", "", " 1", "1.0d", "inf", None]
    assert values(rows, "string", V.double_from_text) == [
        1.5, 1e5, -0.5, 5.0, None, None, None, None, float("inf"), None,
    ]


def test_timestamps_floor_to_millis_also_before_1970(values):
    rows = [ts("1969-12-31 23:59:59.123999"), ts("1970-01-01 00:00:00"), ts("9999-12-31 23:59:59.999999"), None,
            ts("2024-03-10 02:30:00.000999")]
    assert values(rows, "timestamp_ntz", V.floor_to_millis) == [
        ts("1969-12-31 23:59:59.123"), ts("1970-01-01 00:00:00"), ts("9999-12-31 23:59:59.999"), None,
        ts("2024-03-10 02:30:00"),
    ]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.datetimes(dt.datetime(1900, 1, 1), dt.datetime(2200, 1, 1)), min_size=1, max_size=50))
def test_timestamp_floor_property(values, moments):
    assert values(moments, "timestamp_ntz", V.floor_to_millis) == [
        m.replace(microsecond=m.microsecond // 1000 * 1000) for m in moments
    ]


def test_timestamps_do_not_depend_on_the_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        df = spark.sql(
            "select timestamp_ntz'2024-03-10 02:30:00.1239' gap, timestamp'2024-11-03 05:30:00.1239Z' first_time,"
            " timestamp'2024-11-03 06:30:00.1239Z' second_time"
        )
        row = df.select(V.floor_to_millis(df.gap), V.instant_to_millis(df.first_time),
                        V.instant_to_millis(df.second_time)).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert list(row) == [ts("2024-03-10 02:30:00.123"), ts("2024-11-03 05:30:00.123"), ts("2024-11-03 06:30:00.123")]


CALENDAR = ["2024-01-02 03:04:05.678901", "2024-13-01 00:00:00", "2024-02-30", None, "junk", "2024-01-05",
            "2024-01-01 25:00:00"]


def test_invalid_calendar_values(values):
    epoch, good, day = ts("1970-01-01 00:00:00"), ts("2024-01-02 03:04:05.678"), ts("2024-01-05 00:00:00")
    assert values(CALENDAR, "string", V.timestamp_or_epoch) == [good, epoch, epoch, None, epoch, day, epoch]
    assert values(CALENDAR, "string", V.timestamp_or_null) == [good, None, None, None, None, day, None]
    assert values(["2024-01-05", "2024-13-05", None, "x"], "string", V.date_or_epoch) == [
        dt.date(2024, 1, 5), dt.date(1970, 1, 1), None, dt.date(1970, 1, 1),
    ]


def test_offsets_are_ignored(values):
    rows = ["2024-01-01 10:11:12.123456789+07:00", "2024-01-01 10:11:12 -05:00", "2024-01-01 10:11:12.5 +7:00",
            "2024-01-01T10:11:12Z", "2024-01-01 10:11:12.0 Asia/Ho_Chi_Minh", "2024-01-01", None]
    noon = "2024-01-01 10:11:12"
    assert values(rows, "string", V.wall_clock) == [
        ts(noon + ".123456"), ts(noon), ts(noon + ".500"), ts(noon), ts(noon), ts("2024-01-01 00:00:00"), None,
    ]


def test_seconds_of_day(values):
    from tapline.functions.times import seconds_of_day_text

    assert values([ts("1970-01-01 10:11:12.9"), None], "timestamp_ntz", V.seconds_of_day) == [36672, None]
    assert values(["10:11:12.9", "23:59:59", None], "string", seconds_of_day_text) == [36672, 86399, None]


JSON_CASES = [
    ('{"b":1,"a":[2,{"d":null,"c":true}]}', '{"a":[2,{"c":true,"d":null}],"b":1}'),
    ('{ "b" : 1.0, "a" : 2.50 }', '{"a":2.5,"b":1.0}'),
    ('{"b":1,"b":2}', '{"b":2}'),
    ("null", "null"),
    ("1e16", "1e16"), ("1e15", "1000000000000000.0"), ("1.5e300", "1.5e300"), ("0.00001", "0.00001"),
    ("0.000001", "1e-6"), ("-0", "-0.0"), ("123456.789", "123456.789"), ("[]", "[]"),
    ("18446744073709551615", "18446744073709551615"), ("12345678901234567890123", "1.2345678901234568e22"),
    ('"\\u001f\\u00e9/\\n"', '"\\u001fé/\\n"'),
    ('[0.10,10.50,-0.5,0.001,0.0001,100.00,1234567.25]', '[0.1,10.5,-0.5,0.001,0.0001,100.0,1234567.25]'),
    ('[0.1234567890123456789,9007199254740993,0.30000000000000004]',
     '[0.12345678901234568,9007199254740993,0.30000000000000004]'),
    ('{"z":"1.5","y":"e"}', '{"y":"e","z":"1.5"}'),
    ('{"\U0001F600":1,"￿":2}', '{"￿":2,"\U0001F600":1}'),
]


def test_canonical_json(values):
    from tapline.functions.json_text import canonical_json

    assert values([a for a, _ in JSON_CASES] + [None], "string", canonical_json) == [b for _, b in JSON_CASES] + [None]


JSON_VALUES = st.recursive(
    st.none() | st.booleans() | st.integers(-(2**63), 2**63) | st.floats(allow_nan=False, allow_infinity=False)
    | st.decimals(-10**6, 10**6, places=3).map(float) | st.text(st.characters(exclude_categories=["Cs"])),
    lambda inner: st.lists(inner, max_size=3) | st.dictionaries(st.text(max_size=5), inner, max_size=3), max_leaves=8,
)


@settings(max_examples=10, deadline=None)
@given(st.lists(JSON_VALUES, min_size=1, max_size=100))
def test_both_json_paths_agree(values, documents):
    import json

    texts = [json.dumps(d, ensure_ascii=False) for d in documents]
    assert values(texts, "string", V.canonical_json) == list(map(canonicaliser(), texts))


def test_bad_json_fails(values):
    with pytest.raises(Exception, match="Expecting|JSON"):
        values(["{"], "string", V.canonical_json)


def test_lossy_utf8(values):
    assert values([b"\xffa", b"\xe2\x82", "é".encode(), None], "binary", V.lossy_utf8) == ["�a", "�", "é", None]


def test_strict_utf8(values):
    assert values(["é".encode(), None], "binary", lambda c: V.strict_utf8(c, "n")) == ["é", None]
    with pytest.raises(ExtractionError) as err, as_extraction_error():
        values([b"\xffa"], "binary", lambda c: V.strict_utf8(c, "n"))
    assert str(err.value) == "Data error: Column: n, Error: Failed to convert bytes to UTF-8 string"
    assert err.value.kind == "data" and isinstance(err.value, OSError)


def test_utf16(values):
    texts = ["é😀x", "", "a" * 3000, None]
    raw = [t.encode("utf-16le") if t is not None else None for t in texts]
    assert values(raw, "binary", lambda c: V.decode_utf16(c, "n")) == texts


@pytest.mark.parametrize("raw", [
    b"abc", *[t.encode("utf-16le", "surrogatepass") for t in ("\ud800x", "x\udc00", "\udc00\ud800", "a\ud800\ud800")]
])
def test_bad_utf16_fails(values, raw):
    with pytest.raises(Exception, match="Column: n, Error: Failed to convert bytes to UTF-16 string"):
        values([raw], "binary", lambda c: V.decode_utf16(c, "n"))


def test_cap_and_hex(values):
    assert values(["abcdef", "ab", None], "string", lambda c: V.cap_text(c, 3)) == ["abc", "ab", None]
    assert values(["abcdef", "ab", None], "string", lambda c: V.over_length(c, 3)) == [True, False, None]
    assert values([b"\xff\x00", None], "binary", V.hex_lower) == ["ff00", None]
