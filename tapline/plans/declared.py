"""Source column types as the database names them."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import types as T

_TYPE_TEXT = re.compile(r"^(?P<head>[^()]+?)\s*(?:\((?P<args>[^)]*)\)\s*(?P<tail>[^()]*))?$")


@dataclass(frozen=True)
class Declared:
    """A type name in lower case without its arguments, and the arguments."""

    name: str
    args: tuple[int, ...] = ()

    @property
    def precision(self) -> int | None:
        return self.args[0] if self.args else None

    @property
    def scale(self) -> int | None:
        return self.args[1] if len(self.args) > 1 else None

    def __str__(self) -> str:
        return self.name + (f"({','.join(map(str, self.args))})" if self.args else "")


def parse(text: str) -> Declared:
    """``timestamp(6) with time zone`` is ("timestamp with time zone", (6,)); ``VARCHAR () FOR BIT DATA`` has no args."""
    match = _TYPE_TEXT.match(text.strip())
    if not match:
        return Declared(text.strip().lower())
    name = " ".join(f"{match['head']} {match['tail'] or ''}".lower().split())
    numbers = re.findall(r"-?[0-9]+", match["args"] or "")
    return Declared(name, tuple(int(n) for n in numbers))


# The source type that stands for a Spark type when nothing was declared.
_BY_SPARK_TYPE = {
    "POSTGRES": {
        T.ByteType: "int2", T.ShortType: "int2", T.IntegerType: "int4", T.LongType: "int8",
        T.FloatType: "float4", T.DoubleType: "float8", T.BooleanType: "bool", T.DecimalType: "numeric",
        T.StringType: "text", T.BinaryType: "bytea", T.DateType: "date", T.TimestampNTZType: "timestamp",
        T.TimestampType: "timestamptz", T.VariantType: "jsonb", T.ArrayType: "array", T.MapType: "map",
        T.StructType: "record",
    },
    "ODBC": {
        T.ByteType: "tinyint", T.ShortType: "smallint", T.IntegerType: "integer", T.LongType: "bigint",
        T.FloatType: "real", T.DoubleType: "double", T.BooleanType: "bit", T.DecimalType: "decimal",
        T.StringType: "varchar", T.BinaryType: "varbinary", T.DateType: "date",
        T.TimestampNTZType: "timestamp", T.TimestampType: "timestamp", T.ArrayType: "array",
        T.MapType: "map", T.StructType: "row",
    },
    "ORACLE": {
        T.ByteType: "number(3,0)", T.ShortType: "number(5,0)", T.IntegerType: "number(10,0)",
        T.LongType: "number(19,0)", T.FloatType: "binary_float", T.DoubleType: "binary_double",
        T.BooleanType: "boolean", T.DecimalType: "number", T.StringType: "varchar2", T.BinaryType: "blob",
        T.DateType: "date", T.TimestampNTZType: "timestamp", T.TimestampType: "timestamp",
        T.ArrayType: "array", T.MapType: "map", T.StructType: "object",
    },
}


def of_field(field: T.StructField, profile: str) -> Declared:
    """The type a JDBC driver reported for a column, else the profile's type for its Spark type."""
    spark_type = field.dataType
    reported = field.metadata.get("jdbcClientType")
    known = parse(reported) if reported else None
    if known is None:
        named = _BY_SPARK_TYPE[profile].get(type(spark_type))
        known = parse(named) if named else Declared(spark_type.simpleString())
    if not known.args and isinstance(spark_type, T.DecimalType):
        # The driver's type name carries no arguments. Its scale may lie outside what Spark's type can say: below zero or
        # above the precision (-127: no fixed point).
        return Declared(known.name, (spark_type.precision, field.metadata.get("scale", spark_type.scale)))
    return known


def declared_types(schema: T.StructType, profile: str, given: dict[str, str] | None = None) -> dict[str, Declared]:
    """Source type of every column; ``given`` names win over what the driver reported."""
    given = given or {}
    unknown = set(given) - set(schema.names)
    if unknown:
        raise ValueError(f"declared types for columns that do not exist: {sorted(unknown)}")
    return {f.name: parse(given[f.name]) if f.name in given else of_field(f, profile) for f in schema.fields}
