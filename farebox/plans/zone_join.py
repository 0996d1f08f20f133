"""Q7: trips with the attributes of the first N zones, by a chosen join strategy."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farebox.operators.filters import in_report_window
from farebox.operators.joins import first_rows, join_with_strategy
from farebox.params import ReportWindow

# Fixed value: zones taken unless told otherwise.
ZONES_TAKEN = 50


def zone_join(
    trips: DataFrame, zones: DataFrame, window: ReportWindow, zone_count: int = ZONES_TAKEN, strategy: str = "auto"
) -> DataFrame:
    """All trips of the window; those outside the N zones keep NULL attributes.

    ``auto`` broadcasts, as N bounds the zones. A shuffled strategy sends trips
    by zone id; the salt spreads a busy zone over several tasks.
    """
    few = first_rows(zones, "location_id", zone_count).withColumnRenamed("location_id", "pu_location_id")
    inside = trips.where(in_report_window(trips, window))
    salt = ["pickup_datetime"] if strategy in ("merge", "shuffle_hash") else []
    return join_with_strategy(inside, few, key="pu_location_id", strategy=strategy, salt_by=salt).select(
        *trips.columns, *[F.col(name) for name in ("borough", "zone", "service_zone")]
    )
