"""Predicates. Each returns a Column, so several combine into one ``where``."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farebox.operators.projection import is_derived
from farebox.params import ReportWindow


def hour_in(moment: Column, hours: Iterable[int]) -> Column:
    return F.hour(moment).isin(list(hours))


def date_in(day: Column, dates: Iterable[date]) -> Column:
    """Date membership on a stored date column; prunes its partitions."""
    return day.isin(list(dates))


def moment_in(moment: str, spans: Iterable[tuple[date, date]]) -> Column:
    """Membership of a timestamp column in half-open date spans.

    Plain comparisons on the stored timestamp reach the Parquet scan, where
    they skip row groups; a cast to date would not.
    """
    within = (f"({moment} >= TIMESTAMP_NTZ'{start}' AND {moment} < TIMESTAMP_NTZ'{end}')" for start, end in spans)
    return F.expr(" OR ".join(within))


def in_report_hours(window: ReportWindow, moment: str = "pickup_datetime") -> Column:
    return hour_in(F.col(moment), window.hours)


def in_report_window(df: DataFrame, window: ReportWindow) -> Column:
    """Report hours on report dates, by the stored date where there is one.

    A date taken from the pickup time is no column of the table: the filter then
    compares the time itself, which reaches the scan.
    """
    if "pickup_date" in df.columns and not is_derived(df, "pickup_date"):
        on_date = date_in(F.col("pickup_date"), window.dates)
    else:
        on_date = moment_in("pickup_datetime", window.date_spans)
    return on_date & in_report_hours(window)


def _on_axis(degrees: Column, limit: float) -> Column:
    """Zero stands for a coordinate that was not recorded. NULL fails the range."""
    return degrees.between(-limit, limit) & (degrees != 0.0)


def valid_point(lat: Column, lon: Column) -> Column:
    """A coordinate that was recorded and lies on the globe."""
    return _on_axis(lat, 90.0) & _on_axis(lon, 180.0)


def positive(*values: Column) -> Column:
    return reduce(and_, (value > 0 for value in values))


def present(*names: str) -> Column:
    return reduce(and_, (F.col(name).isNotNull() for name in names))
