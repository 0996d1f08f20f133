"""Column expressions: time, distance, text and number handling."""

from farebox.functions.clock import (
    day_of_month,
    hour_label,
    iso_day,
    parse_stamp,
    utc_clock,
    whole_seconds,
)
from farebox.functions.geo import great_circle_km, great_circle_km_arrow
from farebox.functions.numbers import finite, or_zero, parse_decimal, parse_whole, ratio
from farebox.functions.text import spaced_stamp, stripped

__all__ = [
    "day_of_month",
    "finite",
    "great_circle_km",
    "great_circle_km_arrow",
    "hour_label",
    "iso_day",
    "or_zero",
    "parse_decimal",
    "parse_stamp",
    "parse_whole",
    "ratio",
    "spaced_stamp",
    "stripped",
    "utc_clock",
    "whole_seconds",
]
