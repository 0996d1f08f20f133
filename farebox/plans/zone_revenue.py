"""Q6: revenue and its congestion and airport part, per vendor and service zone.

Sums are taken per vendor and zone id first; the lookup joins those few rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farebox.functions import ratio
from farebox.operators.aggregates import row_count, sum_or_zero
from farebox.operators.filters import in_report_window, present
from farebox.operators.joins import lookup
from farebox.operators.projection import in_role, with_revenue_defaults
from farebox.params import ReportWindow


def zone_revenue(trips: DataFrame, zones: DataFrame, window: ReportWindow) -> DataFrame:
    trips = with_revenue_defaults(trips)
    per_zone = (
        trips.where(in_report_window(trips, window) & present("pu_location_id"))
        .groupBy("vendor_id", "pu_location_id")
        .agg(
            row_count().alias("zone_trips"),
            sum_or_zero(F.col("total_amount")).alias("zone_revenue"),
            sum_or_zero(F.col("congestion_surcharge"), F.col("airport_fee")).alias("zone_fees"),
        )
    )
    pickup = in_role(zones, {"location_id": "pu_location_id", "service_zone": "pickup_service_zone"})
    totals = (
        lookup(per_zone, pickup, "pu_location_id", required=["pickup_service_zone"])
        .groupBy("vendor_id", "pickup_service_zone")
        .agg(
            F.sum("zone_trips").alias("Trips"),
            F.sum("zone_revenue").alias("TotalRevenue"),
            F.sum("zone_fees").alias("CongestionAirport"),
        )
    )
    shares = {
        "Share": ratio(F.col("CongestionAirport"), F.col("TotalRevenue")),
        "AvgRevenuePerTrip": F.col("TotalRevenue") / F.col("Trips"),
    }
    return totals.withColumns(shares).orderBy("vendor_id", "pickup_service_zone")
