"""Text and bytes."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _as_text(c: Column) -> Column:
    return c.cast("string")


def _bad_bytes(name: str, charset: str) -> Column:
    return F.raise_error(F.lit(f"Column: {name}, Error: Failed to convert bytes to {charset} string"))


def strict_utf8(c: Column, name: str) -> Column:
    """Bytes or text as text; bytes that are not UTF-8 fail the run and name the column."""
    text = _as_text(c)
    return F.when(text.isNull() | F.is_valid_utf8(text), text).otherwise(_bad_bytes(name, "UTF-8"))


def lossy_utf8(c: Column) -> Column:
    """Bytes or text as text; bytes that are not UTF-8 become U+FFFD."""
    return F.make_valid_utf8(_as_text(c))


# Half of a surrogate pair on its own, in 16-bit units written as four hex digits and a blank.
_LONE_SURROGATE = r"\bD[89AB].. (?!D[C-F])|(?<!\bD[89AB].. )\bD[C-F].. "


def decode_utf16(c: Column, name: str) -> Column:
    """UTF-16 little-endian bytes as text; an odd length or a lone surrogate fails the run."""
    units = F.regexp_replace(F.hex(c), "(..)(..)", "$2$1 ")
    # Most texts have no byte from D8 to DF, and the look at single units is not made for them.
    bad = (F.length(c) % 2 == 1) | (F.hex(c).rlike("D[89A-F]") & units.rlike(_LONE_SURROGATE))
    return F.when(bad, _bad_bytes(name, "UTF-16")).otherwise(F.decode(c, "UTF-16LE"))


def over_length(c: Column, cap: int) -> Column:
    """True where text has more than ``cap`` characters."""
    return F.length(c) > cap


def cap_text(c: Column, cap: int) -> Column:
    """Text cut at ``cap`` characters (asked for with max_text_len; the default keeps whole texts)."""
    return F.left(c, F.lit(cap))


def hex_lower(c: Column) -> Column:
    return F.lower(F.hex(c))
