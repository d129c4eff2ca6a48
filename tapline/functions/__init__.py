"""Value rules: Column in, Column out."""

from tapline.functions.json_text import canonical_json
from tapline.functions.numbers import decimal_from_text, double_from_text, truncate_decimal
from tapline.functions.text import (
    cap_text, decode_utf16, hex_lower, lossy_utf8, over_length, strict_utf8,
)
from tapline.functions.times import (
    date_or_epoch, floor_to_millis, instant_to_millis, seconds_of_day, timestamp_or_epoch,
    timestamp_or_null, wall_clock,
)

__all__ = [
    "canonical_json", "cap_text", "date_or_epoch", "decimal_from_text", "decode_utf16", "double_from_text",
    "floor_to_millis", "hex_lower", "instant_to_millis", "lossy_utf8", "over_length", "seconds_of_day",
    "strict_utf8", "timestamp_or_epoch", "timestamp_or_null", "truncate_decimal", "wall_clock",
]
