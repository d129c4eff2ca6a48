"""Decimals and numeric text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql.types import DecimalType

# Plain decimal text: a sign, digits, and a fraction with at least one digit.
PLAIN_NUMBER = r"^[+-]?[0-9]+(\.[0-9]+)?$"

# Text that reads as a floating point number, with no blanks around it.
FLOAT_TEXT = r"(?i)^[+-]?(inf|infinity|nan|([0-9]+\.?[0-9]*|\.[0-9]+)(e[+-]?[0-9]+)?)$"


def truncate_decimal(c: Column, scale: int = 10, precision: int = 38) -> Column:
    """A decimal at ``scale`` digits; longer fractions are cut toward zero, never rounded."""
    digits = F.lit(scale)
    cut = F.when(c < 0, F.ceil(c, digits)).otherwise(F.floor(c, digits))
    return cut.cast(DecimalType(precision, scale))


def decimal_from_text(c: Column, precision: int, scale: int) -> Column:
    """Plain decimal text to decimal(precision, scale), cut toward zero; text that is no number gives NULL.

    The cut is made in the text, so neither the digits before nor the digits after the point are limited
    by an intermediate type.
    """
    if scale:
        cut = F.regexp_replace(c, rf"^([^.]*\.[0-9]{{{scale}}})[0-9]+$", "$1")
    else:
        cut = F.regexp_replace(c, r"^([^.]*)\.[0-9]+$", "$1")
    return F.when(c.rlike(PLAIN_NUMBER), cut.try_cast(DecimalType(precision, scale)))


def double_from_text(c: Column) -> Column:
    """Numeric text to double; text that is no number gives NULL."""
    return F.when(c.rlike(FLOAT_TEXT), c.try_cast("double"))
