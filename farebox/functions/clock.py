"""Time expressions. Trip times are wall-clock (TIMESTAMP_NTZ), so no result
depends on the session's time zone."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from farebox.functions.text import spaced_stamp

# Accepted timestamp text (after the T is a blank), day text and hour text.
STAMP_PATTERN = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}(\.\d{1,6})?$"
DAY_FORMAT = "yyyy-MM-dd"
HOUR_FORMAT = "%02d"


def parse_stamp(text: Column) -> Column:
    """Timestamp from text with 0-6 fraction digits; anything else is NULL.

    The pattern guards the cast, which alone would also take ``2024`` and
    silently drop a zone suffix.
    """
    cleaned = spaced_stamp(text)
    return F.when(cleaned.rlike(STAMP_PATTERN), cleaned.try_cast("timestamp_ntz"))


def utc_clock(moment: Column) -> Column:
    """Wall clock in UTC of a stored zone-aware timestamp, whatever the session's zone is."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(moment), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def whole_seconds(start: Column, end: Column) -> Column:
    """Elapsed seconds; both ends are cut to whole seconds first."""
    return F.unix_timestamp(end) - F.unix_timestamp(start)


def iso_day(moment: Column) -> Column:
    """Date text; going through the date keeps it free of daylight-saving gaps."""
    return F.date_format(F.to_date(moment), DAY_FORMAT)


def hour_label(hour: Column) -> Column:
    """Two-digit hour; NULL stays NULL, which the format alone would write as text."""
    return F.when(hour.isNotNull(), F.format_string(HOUR_FORMAT, hour))


def day_of_month(day: Column) -> Column:
    """Day number of a date or of date text; NULL for text that is no date."""
    return F.dayofmonth(day.try_cast("date"))
