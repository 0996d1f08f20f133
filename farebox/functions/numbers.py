"""Number parsing that never raises, and NULL-safe arithmetic."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: a whole number, which exports also write with a decimal part ("1.0").
WHOLE_PATTERN = r"^\s*([+-]?\d+)(\.\d*)?\s*$"


def parse_decimal(text: Column) -> Column:
    """Double from text, NULL where the text is no number."""
    return text.try_cast("double")


def parse_whole(text: Column) -> Column:
    """Int from text; a decimal part is cut off, other text is NULL."""
    return F.coalesce(text.try_cast("int"), F.regexp_extract(text, WHOLE_PATTERN, 1).try_cast("int"))


def or_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0.0))


def ratio(part: Column, whole: Column) -> Column:
    """part / whole, NULL unless whole is above zero."""
    return F.when(whole > 0, part / whole)


def finite(value: Column) -> Column:
    """True for a number that is neither NaN nor infinite; NULL stays NULL, which filters drop.

    One comparison, as NaN sorts above infinity: the value may be parsed text.
    """
    return F.abs(value) < float("inf")
