"""Q1: trips, mean duration and tail distance per hour of day."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farebox.functions import great_circle_km, great_circle_km_arrow, whole_seconds
from farebox.operators.aggregates import (
    histogram,
    histogram_percentile,
    percentile_by,
    row_count,
)
from farebox.operators.filters import in_report_hours, positive, valid_point
from farebox.operators.projection import with_hour_label
from farebox.operators.ranking import in_order
from farebox.params import ReportWindow

# Columns of a GPS trip that this report cannot do without.
HOURLY_NEEDS = [
    "pickup_datetime",
    "dropoff_datetime",
    "pickup_latitude",
    "pickup_longitude",
    "dropoff_latitude",
    "dropoff_longitude",
]

Distance = Callable[[Column, Column, Column, Column], Column]


def _measured(trips: DataFrame, window: ReportWindow, distance: Distance) -> DataFrame:
    """Hour, minutes and distance of the trips that count, three columns wide."""
    pickup = F.col("pickup_latitude"), F.col("pickup_longitude")
    dropoff = F.col("dropoff_latitude"), F.col("dropoff_longitude")
    seconds = whole_seconds(F.col("pickup_datetime"), F.col("dropoff_datetime"))
    return trips.where(
        in_report_hours(window) & positive(seconds) & valid_point(*pickup) & valid_point(*dropoff)
    ).select(
        F.hour("pickup_datetime").alias("hour_of_day"),
        (seconds / 60.0).alias("minutes"),
        distance(*pickup, *dropoff).alias("km"),
    )


def _profile(trips: DataFrame, window: ReportWindow, distance: Distance) -> DataFrame:
    tails = percentile_by(
        _measured(trips, window, distance),
        ["hour_of_day"],
        "km",
        "P90HaversineKm",
        Trips=(row_count(), F.sum("Trips")),
        minutes=(F.sum("minutes"), F.sum("minutes")),
    )
    per_hour = tails.select(
        "hour_of_day", "Trips", (F.col("minutes") / F.col("Trips")).alias("AvgDurationMin"), "P90HaversineKm"
    )
    return with_hour_label(in_order(per_hour, "hour_of_day"))


def hourly_profile(trips: DataFrame, window: ReportWindow) -> DataFrame:
    return _profile(trips, window, great_circle_km)


def hourly_profile_arrow(trips: DataFrame, window: ReportWindow) -> DataFrame:
    """The profile with the distance from an Arrow UDF; rows are filtered before they leave the JVM."""
    return _profile(trips, window, great_circle_km_arrow)


def hourly_profile_histogram(trips: DataFrame, window: ReportWindow) -> DataFrame:
    """The profile with the tail read off 0.5 km bins: the lower edge of its bin.

    The shuffle carries at most 1001 rows per hour and task, whatever the data size.
    """
    measured = _measured(trips, window, great_circle_km)
    bins = histogram(measured, ["hour_of_day"], "km", minutes=F.sum("minutes"))
    per_hour = histogram_percentile(bins, ["hour_of_day"], minutes=F.sum("minutes")).select(
        "hour_of_day",
        F.col("rows").alias("Trips"),
        (F.col("minutes") / F.col("rows")).alias("AvgDurationMin"),
        F.col("percentile").alias("P90HaversineKm"),
    )
    return with_hour_label(in_order(per_hour, "hour_of_day"))
