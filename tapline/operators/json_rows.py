"""Rows as JSON texts, and as Python dicts for results that are meant to fit in one process."""

from __future__ import annotations

import json
from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tapline.errors import ExtractionError
from tapline.functions.times import instant_to_millis

_TIME_UNIT = "time_unit"


def _name(field: T.StructField) -> str:
    return "`" + field.name.replace("`", "``") + "`"


def _timestamp_text(c: Column) -> Column:
    """ISO text; milliseconds only where there are any."""
    millis = (F.extract(F.lit("SECOND"), c) * 1000).cast("bigint") % 1000
    whole = F.replace(F.substring(c.cast("string"), 1, 19), F.lit(" "), F.lit("T"))
    return F.when(millis == 0, whole).otherwise(F.concat(whole, F.lit("."), F.lpad(millis.cast("string"), 3, "0")))


def _time_text(c: Column) -> Column:
    """Seconds of day as HH:MM:SS."""
    return F.format_string("%02d:%02d:%02d", F.floor(c / 3600), F.floor(c / 60) % 60, c % 60)


def _value(field: T.StructField, exact_decimals: bool) -> Column:
    c, kind = F.col(_name(field)), field.dataType
    if isinstance(kind, T.BinaryType):
        return F.lower(F.hex(c))
    if isinstance(kind, T.DateType):
        return c.cast("string")
    if isinstance(kind, T.TimestampNTZType):
        return _timestamp_text(c)
    if isinstance(kind, T.TimestampType):
        return _timestamp_text(instant_to_millis(c))
    if isinstance(kind, T.IntegerType) and field.metadata.get(_TIME_UNIT) == "second":
        return F.when(c.isNotNull(), _time_text(c))
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
        return F.to_json(c)
    return c


def _decimal_pair(field: T.StructField) -> tuple[Column, Column | None]:
    """A decimal as an integer where it is one that fits 64 bits, else as a double; one of the two is NULL."""
    c = F.col(_name(field))
    if field.dataType.scale > 0:
        return c.cast("double"), None
    whole = c.try_cast("bigint")
    return whole, F.when(whole.isNull(), c.cast("double"))


def _member(name: str, value: Column) -> Column:
    """``"name":value``, or NULL where the value is NULL."""
    text = F.to_json(F.struct(value.alias(name)))
    return F.when(value.isNotNull(), F.substring(text, F.lit(2), F.length(text) - 2))


# Bytes of JSON that a list of dicts is made of at most, unless the caller asks for more: the list takes several times as much.
MAX_BYTES = 256 << 20


def json_rows(df: DataFrame, exact_decimals: bool = False) -> DataFrame:
    """One column ``json``: an object per row, keys in column order, NULL columns left out, NaN and Inf as null."""
    if len(set(df.columns)) != len(df.columns):
        raise ExtractionError("data", f"duplicate column names in the result: {df.columns}")
    members: list[Column] = []
    run: list[Column] = []  # neighbouring columns that one to_json call can print

    def close_run() -> None:
        if run:
            text = F.to_json(F.struct(*run))
            members.append(F.nullif(F.substring(text, F.lit(2), F.length(text) - 2), F.lit("")))
            run.clear()

    for field in df.schema.fields:
        kind = field.dataType
        if isinstance(kind, (T.FloatType, T.DoubleType)):
            close_run()
            c = F.col(_name(field))
            finite = ~(F.isnan(c) | F.abs(c).eqNullSafe(float("inf")))
            null_text = F.to_json(F.struct(F.lit(0).alias(field.name)))
            empty = F.concat(F.substring(null_text, F.lit(2), F.length(null_text) - 3), F.lit("null"))
            members.append(F.when(c.isNull(), F.lit(None)).when(finite, _member(field.name, c)).otherwise(empty))
        elif isinstance(kind, T.DecimalType) and not exact_decimals:
            close_run()
            first, second = _decimal_pair(field)
            member = _member(field.name, first)
            members.append(member if second is None else F.coalesce(member, _member(field.name, second)))
        else:
            run.append(_value(field, exact_decimals).alias(field.name))
    close_run()
    return df.select(F.concat(F.lit("{"), F.concat_ws(",", *members), F.lit("}")).alias("json"))


def _python_value(value):
    if isinstance(value, int) and not isinstance(value, bool) and not -(2**63) <= value < 2**63:
        return float(value)
    return value


def rows_as_dicts(
    df: DataFrame, max_rows: int | None = None, exact_decimals: bool = False, max_bytes: int | None = MAX_BYTES
) -> list[dict]:
    """All rows as dicts, fetched partition by partition. A result above ``max_rows``, or whose JSON texts have more than
    ``max_bytes`` bytes together, is refused, never cut.

    With ``exact_decimals`` numbers with a fraction come as ``Decimal`` and whole ones as ``int``, every digit kept.
    """
    rows: list[dict] = []
    size = 0
    for (text,) in json_rows(df, exact_decimals).toLocalIterator():
        size += len(text.encode())
        if max_rows is not None and len(rows) >= max_rows:
            raise ExtractionError("data", f"the result has more than {max_rows} rows: use json_rows or read_to_parquet")
        if max_bytes is not None and size > max_bytes:
            raise ExtractionError(
                "data", f"the result has more than {max_bytes} bytes of JSON (after {len(rows)} rows): raise max_bytes, or "
                "use json_rows or read_to_parquet")
        if exact_decimals:
            rows.append(json.loads(text, parse_float=Decimal))
        else:
            rows.append({k: _python_value(v) for k, v in json.loads(text).items()})
    return rows
