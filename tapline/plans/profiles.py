"""Type profiles: one projection that gives every column the type and the value rules of its source system."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, functions as F, types as T

from tapline import functions as V
from tapline.errors import ExtractionError
from tapline.functions.json_text import exact_json, plain_json
from tapline.functions.times import seconds_of_day_text
from tapline.plans.declared import Declared, declared_types


@dataclass(frozen=True)
class Switches:
    """Choices that differ from, or go beyond, the default of a profile."""

    binary_fallback: bool = False  # Postgres types outside the known ones as bytes instead of text
    max_text_len: int | None = None  # cut texts and bytes at this length


@dataclass(frozen=True)
class Source:
    """A column as it arrives: its Spark column, name, Spark type and declared type."""

    col: Column
    name: str
    type: T.DataType
    declared: Declared
    switches: Switches

    @property
    def first_name(self) -> str:
        return f"`__first_{self.name.replace('`', '``')}`"

    @property
    def is_text(self) -> bool:
        return isinstance(self.type, T.StringType)

    @property
    def is_bytes(self) -> bool:
        return isinstance(self.type, T.BinaryType)

    @property
    def is_nested(self) -> bool:
        return isinstance(self.type, (T.ArrayType, T.MapType, T.StructType, T.VariantType))


@dataclass(frozen=True)
class Target:
    """A column as it leaves. ``first`` is computed one projection earlier, for rules that use it more than once."""

    col: Column
    metadata: dict = field(default_factory=dict)
    first: Column | None = None
    cut: Column | None = None  # whether max_text_len cuts the value


Rule = Callable[[Source], Target]


def _cast(name: str) -> Rule:
    return lambda s: Target(s.col.cast(name))


def _millis(s: Source) -> Column:
    """Any date, timestamp or timestamp text as a zone-less timestamp at milliseconds."""
    if isinstance(s.type, T.TimestampType):
        return V.instant_to_millis(s.col)
    if isinstance(s.type, T.TimestampNTZType):
        return V.floor_to_millis(s.col)
    if isinstance(s.type, T.DateType):
        return s.col.cast("timestamp_ntz")
    return V.timestamp_or_null(s.col)


def _text(s: Source) -> Column:
    if s.is_nested:
        return F.to_json(s.col)
    if s.is_bytes:
        return V.strict_utf8(s.col, s.name)
    return s.col.cast("string")


def _fixed_point(s: Source, precision: int, scale: int) -> Column:
    """Number or text to decimal(precision, scale), longer fractions cut toward zero."""
    if isinstance(s.type, T.DecimalType):
        if s.type.scale > scale:
            return V.truncate_decimal(s.col, scale, precision)
        return s.col.cast(T.DecimalType(precision, scale))
    if s.is_text:
        digits = rf"^([^.]*\.[0-9]{{{scale}}})[0-9]+$" if scale else r"^([^.]*)\.[0-9]+$"
        return F.regexp_replace(s.col, digits, "$1").cast(T.DecimalType(precision, scale))
    if isinstance(s.type, (T.FloatType, T.DoubleType)):
        # A binary fraction has at most 17 significant digits; its text is exact and can be cut. The larger the number,
        # the fewer of them stand after the point: none from 1e18 on.
        text, size = s.col.cast("string"), F.abs(s.col)
        target = T.DecimalType(precision, scale)
        return (
            F.when(size < 1e15, V.truncate_decimal(text.cast(T.DecimalType(38, min(38, max(scale, 18)))), scale, precision))
            .when(size < 1e18, V.truncate_decimal(text.cast(T.DecimalType(38, max(scale, 4))), scale, precision))
            .otherwise(text.cast(T.DecimalType(38, 0)).cast(target))
        )
    return s.col.cast(T.DecimalType(precision, scale))


# ---------------------------------------------------------------- Postgres

# Spellings of one type.
_PG_ALIASES = {
    "smallint": "int2", "integer": "int4", "int": "int4", "bigint": "int8", "real": "float4",
    "double precision": "float8", "boolean": "bool", "decimal": "numeric",
    "smallserial": "int2", "serial": "int4", "bigserial": "int8",
    "timestamp without time zone": "timestamp", "timestamp with time zone": "timestamptz",
    "character varying": "varchar", "character": "bpchar",
}


def _pg_numeric(s: Source) -> Target:
    return Target(_fixed_point(s, 38, 10))


def _pg_json(s: Source) -> Target:
    text = F.to_json(s.col) if s.is_nested else s.col.cast("string")
    return Target(exact_json(text, F.col(s.first_name)), {"json": "true"}, plain_json(text))


def _pg_other(s: Source) -> Target:
    """Types outside the profile: bytes stay bytes, the rest is text, or the wire bytes of text if asked for."""
    if s.is_bytes:
        return Target(s.col)
    if isinstance(s.type, (T.TimestampType, T.TimestampNTZType)):
        # Drivers hand a time of day over as a timestamp on 1970-01-01.
        text = F.date_format(s.col, "HH:mm:ss.SSSSSS")
    else:
        text = _text(s)
    if not s.switches.binary_fallback:
        return Target(text)
    if s.declared.name == "uuid":
        return Target(F.unhex(F.replace(text, F.lit("-"), F.lit(""))))
    return Target(F.encode(text, "UTF-8"))


# Type names of the source, here and in the two tables below.
_POSTGRES: dict[str, Rule] = {
    "int2": _cast("smallint"), "int4": _cast("int"), "int8": _cast("bigint"),
    "float4": _cast("float"), "float8": _cast("double"), "bool": _cast("boolean"),
    "numeric": _pg_numeric,
    **dict.fromkeys(
        ("text", "citext", "ltree", "lquery", "ltxtquery", "name", "char"), lambda s: Target(_text(s))
    ),
    "json": _pg_json, "jsonb": _pg_json,
    "timestamp": lambda s: Target(_millis(s)), "timestamptz": lambda s: Target(_millis(s)),
    "date": _cast("date"),
}


def _postgres(s: Source) -> Target:
    name = _PG_ALIASES.get(s.declared.name, s.declared.name)
    return _POSTGRES.get(name, _pg_other)(s)


# ---------------------------------------------------------------- generic drivers

_ODBC_ALIASES = {
    "int": "integer", "int identity": "integer", "int unsigned": "bigint", "tinyint unsigned": "smallint",
    "smallint unsigned": "integer", "boolean": "bit", "bool": "bit", "double precision": "double", "money": "decimal",
    "smallmoney": "decimal", "datetime": "timestamp", "datetime2": "timestamp", "smalldatetime": "timestamp",
    "long varchar": "longvarchar", "clob": "longvarchar", "text": "longvarchar", "longtext": "longvarchar",
    "mediumtext": "longvarchar", "tinytext": "longvarchar", "xml": "longvarchar", "json": "longvarchar",
    "nchar": "wchar", "nvarchar": "wvarchar", "ntext": "wlongvarchar", "nclob": "wlongvarchar",
    "graphic": "wchar", "vargraphic": "wvarchar", "dbclob": "wlongvarchar", "character": "char",
    "character varying": "varchar", "uniqueidentifier": "guid", "blob": "longvarbinary",
    "longblob": "longvarbinary", "mediumblob": "longvarbinary", "tinyblob": "longvarbinary",
    "image": "longvarbinary", "char for bit data": "binary", "varchar for bit data": "varbinary",
    "long varchar for bit data": "longvarbinary", "bytea": "varbinary", "raw": "varbinary",
}


def _odbc_decimal(s: Source) -> Target:
    precision, scale = s.declared.precision, s.declared.scale or 0
    if precision is None:
        precision, scale = (s.type.precision, s.type.scale) if isinstance(s.type, T.DecimalType) else (38, 0)
    if precision > 38:
        return Target(s.col.cast("string"))
    if scale < 0:
        precision, scale = min(38, precision - scale), 0
    return Target(_fixed_point(s, max(precision, 1), scale))


def _odbc_float(s: Source) -> Target:
    return Target(s.col.cast("float" if s.declared.precision is not None and s.declared.precision <= 24 else "double"))


def _odbc_date(s: Source) -> Target:
    return Target(V.date_or_epoch(s.col) if s.is_text else s.col.cast("date"))


def _odbc_timestamp(s: Source) -> Target:
    return Target(V.timestamp_or_epoch(s.col) if s.is_text else _millis(s))


def _odbc_time(s: Source) -> Target:
    seconds = seconds_of_day_text(s.col) if s.is_text else V.seconds_of_day(s.col)
    return Target(seconds, {"time_unit": "second"})


def _capped(value: Column, cap: int | None) -> Target:
    """Text or bytes, cut if asked for."""
    return Target(F.substring(value, 1, cap), cut=V.over_length(value, cap)) if cap else Target(value)


def _odbc_text(s: Source) -> Target:
    return _capped(_text(s), s.switches.max_text_len)


def _odbc_wide_text(s: Source) -> Target:
    return _capped(V.decode_utf16(s.col, s.name), s.switches.max_text_len) if s.is_bytes else _odbc_text(s)


def _odbc_bytes(s: Source) -> Target:
    return _capped(s.col if s.is_bytes else F.encode(_text(s), "UTF-8"), s.switches.max_text_len)


_ODBC: dict[str, Rule] = {
    "numeric": _odbc_decimal, "decimal": _odbc_decimal,
    "integer": _cast("int"), "smallint": _cast("smallint"), "bigint": _cast("bigint"),
    "tinyint": _cast("tinyint"), "bit": _cast("boolean"),
    "real": _cast("float"), "float": _odbc_float, "double": _cast("double"),
    "date": _odbc_date, "timestamp": _odbc_timestamp, "time": _odbc_time,
    **dict.fromkeys(("char", "varchar", "longvarchar", "guid"), _odbc_text),
    **dict.fromkeys(("wchar", "wvarchar", "wlongvarchar"), _odbc_wide_text),
    **dict.fromkeys(("binary", "varbinary", "longvarbinary"), _odbc_bytes),
}


def _odbc(s: Source) -> Target:
    name = _ODBC_ALIASES.get(s.declared.name, s.declared.name)
    return _ODBC.get(name, _odbc_bytes)(s)


# ---------------------------------------------------------------- Oracle


def _ora_number(s: Source) -> Target:
    precision, scale = s.declared.precision, s.declared.scale
    if precision is None:
        # NUMBER without arguments has no fixed point.
        precision, scale = 0, -127
    scale = scale or 0
    if 0 <= scale <= precision <= 38:
        precision = precision or 38
        if s.is_text:
            return Target(V.decimal_from_text(s.col, precision, scale))
        return Target(_fixed_point(s, precision, scale))
    return _ora_free_number(s)


def _ora_free_number(s: Source) -> Target:
    number = V.double_from_text(s.col) if s.is_text else s.col.cast("double")
    return Target(number, {"is_free_size_number": "true"})


def _ora_text(s: Source) -> Target:
    if s.is_nested:
        return Target(F.to_json(s.col))
    return Target(V.lossy_utf8(s.col) if s.is_bytes else s.col.cast("string"))


def _ora_timestamp(s: Source) -> Target:
    return Target(_millis(s))


def _ora_bytes(s: Source) -> Target:
    return Target(s.col if s.is_bytes else F.encode(s.col.cast("string"), "UTF-8"))


_ORACLE: dict[str, Rule] = {
    **dict.fromkeys(("varchar2", "nvarchar2", "char", "nchar", "clob", "nclob", "json", "varchar"), _ora_text),
    "number": _ora_number, "float": _ora_free_number,
    "binary_double": _cast("double"), "binary_float": _cast("float"),
    **dict.fromkeys(
        ("date", "timestamp", "timestamp with time zone", "timestamp with local time zone", "timestamptz",
         "timestampltz"),
        _ora_timestamp,
    ),
    **dict.fromkeys(("raw", "blob", "bfile", "long", "long raw"), _ora_bytes),
}


def _oracle(s: Source) -> Target:
    rule = _ORACLE.get(s.declared.name)
    if rule is None:
        raise ExtractionError("not_implemented", f"Extractor does not support Oracle Type {s.declared}")
    target = rule(s)
    return Target(target.col, {"is_free_size_number": "false", **target.metadata})


# Name of the count of all rows beside the counts of cut values.
ALL_ROWS = "__rows"

_PROFILES: dict[str, Rule] = {"POSTGRES": _postgres, "ODBC": _odbc, "ORACLE": _oracle}


def normalise(
    df: DataFrame,
    profile: str,
    declared: dict[str, str] | None = None,
    switches: Switches = Switches(),
    cuts: Observation | None = None,
) -> DataFrame:
    """The profile as a projection. Nothing is read here; an unsupported type raises at once.

    ``cuts`` gets, from the first run over the rows, how many values of each column max_text_len cut, and all rows.
    """
    rule = _PROFILES[profile]
    sources = declared_types(df.schema, profile, declared)
    columns, earlier, counts = [], {}, [F.count(F.lit(1)).alias(ALL_ROWS)]
    for f in df.schema.fields:
        quoted = F.col("`" + f.name.replace("`", "``") + "`")
        target = rule(Source(quoted, f.name, f.dataType, sources[f.name], switches))
        columns.append(target.col.alias(f.name, metadata=target.metadata))
        if target.first is not None:
            earlier[f"__first_{f.name}"] = target.first
        if target.cut is not None:
            counts.append(F.count_if(target.cut).alias(f.name))
    if cuts is not None:
        df = df.observe(cuts, *counts)
    return df.withColumns(earlier).select(*columns) if earlier else df.select(*columns)


def over_length_counts(df: DataFrame, cap: int) -> DataFrame:
    """Rows per text column that are longer than ``cap``: one aggregation, one row per text column."""
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    if not names:
        return df.sparkSession.createDataFrame([], "column_name string, rows_over bigint")
    counts = [F.count_if(V.over_length(F.col(f"`{n}`"), cap)).alias(n) for n in names]
    pairs = F.array(*[F.struct(F.lit(n).alias("column_name"), F.col(f"`{n}`").alias("rows_over")) for n in names])
    return df.agg(*counts).select(F.inline(pairs))


def unparsed_counts(before: DataFrame, after_rule: dict[str, Column]) -> DataFrame:
    """Rows per column whose text is present but gives NULL under a rule: the report for silent parse failures."""
    names = list(after_rule)
    counts = [F.count_if(F.col(f"`{n}`").isNotNull() & after_rule[n].isNull()).alias(n) for n in names]
    pairs = F.array(*[F.struct(F.lit(n).alias("column_name"), F.col(f"`{n}`").alias("rows_unparsed")) for n in names])
    return before.agg(*counts).select(F.inline(pairs))
