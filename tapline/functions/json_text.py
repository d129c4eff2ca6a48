"""Canonical JSON text: compact, keys sorted, the last of equal keys wins."""

from __future__ import annotations

import json
import re
import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, functions as F
from pyspark.sql.types import StringType

# Executors get the helpers with the task, so they need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Documents with something that the JVM's variant type would print differently. Matches inside texts do no harm.
_NEEDS_EXACT = (
    r"(?=[-0-9.\\\x{10000}-\x{10FFFF}])(?:"  # only these can start a match
    r"[0-9](?:[eE]|[0-9.]{16})"  # exponents; more digits than a double holds, integers near or beyond 64 bits
    r"|\.0(?:0*(?![0-9])|000)"  # a fraction of zeros (1.0 would become 1); small fractions
    r"|-0(?![.0-9])"  # negative zero
    r"|\\u(?:00[01]|[dD][89abAB])"  # escaped control characters
    r"|[\x{10000}-\x{10FFFF}])"  # keys outside the basic plane sort differently in UTF-16
)

_U64_MAX = 2**64 - 1
_I64_MIN = -(2**63)
_ESCAPES = {'"': '\\"', "\\": "\\\\", "\b": "\\b", "\f": "\\f", "\n": "\\n", "\r": "\\r", "\t": "\\t"}
_ESCAPE_TABLE = {i: _ESCAPES.get(chr(i), f"\\u{i:04x}") for i in range(32)} | {ord(k): v for k, v in _ESCAPES.items()}


def _float_text(value: float) -> str:
    """Shortest text of a double; plain notation between 1e-5 and 1e16, exponent form outside."""
    sign, (digits, exponent) = "-" if str(value)[0] == "-" else "", _shortest(abs(value))
    point = len(digits) + exponent
    if exponent >= 0 and point <= 16:
        return f"{sign}{digits}{'0' * exponent}.0"
    if 0 < point <= 16:
        return f"{sign}{digits[:point]}.{digits[point:]}"
    if -5 < point <= 0:
        return f"{sign}0.{'0' * -point}{digits}"
    mantissa = digits if len(digits) == 1 else f"{digits[0]}.{digits[1:]}"
    return f"{sign}{mantissa}e{point - 1}"


def _shortest(value: float) -> tuple[str, int]:
    """Significant digits and power of ten of a non-negative double."""
    mantissa, _, exponent = f"{value!r}".partition("e")
    whole, _, fraction = mantissa.partition(".")
    fraction = fraction.rstrip("0")
    digits = (whole + fraction).lstrip("0")
    power = int(exponent or 0) - len(fraction)
    stripped = digits.rstrip("0")
    return (stripped, power + len(digits) - len(stripped)) if stripped else ("0", 0)


def _string_text(value: str) -> str:
    return '"' + value.translate(_ESCAPE_TABLE) + '"'


def _number(text: str):
    value = int(text)
    return float(text) if text == "-0" or not _I64_MIN <= value <= _U64_MAX else value


def _write(value) -> str:
    if value is None:
        return "null"
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, int):
        return str(value)
    if isinstance(value, float):
        return _float_text(value)
    if isinstance(value, str):
        return _string_text(value)
    if isinstance(value, list):
        return "[" + ",".join(map(_write, value)) + "]"
    return "{" + ",".join(f"{_string_text(k)}:{_write(value[k])}" for k in sorted(value)) + "}"


def _reject_constant(text: str):
    raise ValueError(f"{text} is not JSON")


_HUGE = re.compile(r"[0-9]{19}")


def canonicaliser():
    """A function that gives the canonical form of one JSON text; ValueError if it is not JSON."""
    decode = json.JSONDecoder(parse_constant=_reject_constant).decode
    encode = json.JSONEncoder(ensure_ascii=False, sort_keys=True, separators=(",", ":")).encode

    def canonical(text: str) -> str:
        # Python's own printing differs in exponents, negative zero and integers beyond 64 bits.
        if "-0" in text or _HUGE.search(text):
            return _write(json.loads(text, parse_int=_number, parse_constant=_reject_constant))
        value = decode(text)
        out = encode(value)
        return _write(value) if "e-" in out or "e+" in out else out

    return canonical


@F.pandas_udf(StringType())
def _exact(texts: pd.Series) -> pd.Series:
    return texts.map(canonicaliser(), na_action="ignore")


def plain_json(c: Column) -> Column:
    """Canonical form by the JVM, or NULL for a document that it cannot be trusted with."""
    return F.when(~c.rlike(_NEEDS_EXACT), F.to_json(F.try_parse_json(c)))


def exact_json(c: Column, plain: Column) -> Column:
    """``plain`` where it is there; the other documents go to Python, which sees NULL for all others."""
    return F.coalesce(plain, _exact(F.when(plain.isNull(), c)))


def canonical_json(c: Column) -> Column:
    """Canonical form of a JSON text column."""
    return exact_json(c, plain_json(c))
