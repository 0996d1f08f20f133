"""Cleaning of raw text fields."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def stripped(text: Column) -> Column:
    """Text without leading and trailing blanks."""
    return F.trim(text)


def spaced_stamp(text: Column) -> Column:
    """Timestamp text with a blank between date and time instead of ``T``."""
    return F.replace(stripped(text), F.lit("T"), F.lit(" "))
