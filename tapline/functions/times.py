"""Dates, timestamps and times of day. Results do not depend on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"
EPOCH_DATE = "date'1970-01-01'"

# Calendar text as databases print it: the local fields down to microseconds, then digits and a zone to leave out.
_LOCAL = r"[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}(?:[ T][0-9]{1,2}:[0-9]{1,2}(?::[0-9]{1,2}(?:\.[0-9]{1,6})?)?)?"
_ZONE = r"(?:Z|[A-Za-z_]+(?:/[A-Za-z_/+0-9-]+)?|[+-][0-9]{1,2}(?::?[0-9]{2}){0,2})"
_CALENDAR = rf"^\s*({_LOCAL})[0-9]*\s*{_ZONE}?\s*$"
_DATE_TEXT = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}"


def _shift(c: Column, unit: str, amount: Column) -> Column:
    return F.timestamp_add(unit, amount, c)


def floor_to_millis(c: Column) -> Column:
    """A zone-less timestamp at whole milliseconds, floored also before 1970."""
    micros = (F.extract(F.lit("SECOND"), c) * 1_000_000).cast("bigint")
    return _shift(c, "MICROSECOND", -(micros % 1000))


def instant_to_millis(c: Column) -> Column:
    """A timestamp with zone as zone-less UTC at whole milliseconds, floored."""
    return _shift(F.expr(EPOCH), "MILLISECOND", F.unix_millis(c))


def wall_clock(c: Column) -> Column:
    """Timestamp text with its local fields taken as they stand and any offset ignored."""
    return F.regexp_extract(c, _CALENDAR, 1).try_cast("timestamp_ntz")


def timestamp_or_null(c: Column) -> Column:
    """Timestamp text to milliseconds; an impossible calendar value gives NULL."""
    return floor_to_millis(wall_clock(c))


def timestamp_or_epoch(c: Column) -> Column:
    """Timestamp text to milliseconds; an impossible calendar value gives the epoch, NULL stays NULL."""
    return F.when(c.isNotNull(), F.coalesce(timestamp_or_null(c), F.expr(EPOCH)))


def date_or_epoch(c: Column) -> Column:
    """Date text to date; an impossible calendar value gives 1970-01-01, NULL stays NULL."""
    parsed = F.when(c.rlike(_DATE_TEXT), c.try_cast("date"))
    return F.when(c.isNotNull(), F.coalesce(parsed, F.expr(EPOCH_DATE)))


def seconds_of_day(c: Column) -> Column:
    """Time of day of a timestamp as whole seconds; the fraction is dropped."""
    return (F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c)).cast("int")


def seconds_of_day_text(c: Column) -> Column:
    """As seconds_of_day, for text HH:MM:SS with an optional fraction."""
    def field(i: int) -> Column:
        return F.regexp_extract(c, r"^([0-9]{1,2}):([0-9]{1,2}):([0-9]{1,2})", i).try_cast("int")

    return field(1) * 3600 + field(2) * 60 + field(3)
