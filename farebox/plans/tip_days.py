"""Q2: the K dates with the highest mean tip per mile, per vendor."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farebox.functions import iso_day, ratio
from farebox.operators.filters import in_report_hours, positive, present
from farebox.operators.ranking import top_per_group
from farebox.params import ReportWindow

# Columns of a GPS trip that this report cannot do without.
TIP_NEEDS = ["vendor_id", "pickup_datetime", "trip_distance", "fare_amount", "tip_amount"]


def top_tip_days(trips: DataFrame, window: ReportWindow) -> DataFrame:
    """Groups by the 4-byte date; its text form is made for the result only."""
    usable = trips.where(
        in_report_hours(window)
        & positive(F.col("trip_distance"), F.col("fare_amount"))
        & present("vendor_id", "pickup_datetime")
    )
    daily = usable.groupBy("vendor_id", F.to_date("pickup_datetime").alias("day")).agg(
        F.avg(ratio(F.col("tip_amount"), F.col("trip_distance"))).alias("avg_tip_per_mile")
    )
    best_first = [F.col("avg_tip_per_mile").desc_nulls_last(), F.col("day")]
    best = top_per_group(daily, by=["vendor_id"], order=best_first, count=window.top_k)
    return best.orderBy("vendor_id", *best_first).select(
        "vendor_id", iso_day(F.col("day")).alias("date"), "avg_tip_per_mile"
    )


TOP_TIP_DAYS_SQL = """
SELECT vendor_id, date_format(day, 'yyyy-MM-dd') AS date, avg_tip_per_mile
FROM (
  SELECT *, row_number() OVER (PARTITION BY vendor_id ORDER BY avg_tip_per_mile DESC NULLS LAST, day) AS place
  FROM (
    SELECT vendor_id, to_date(pickup_datetime) AS day, avg(tip_amount / nullif(trip_distance, 0)) AS avg_tip_per_mile
    FROM {trips}
    WHERE array_contains(:hours, hour(pickup_datetime))
      AND trip_distance > 0 AND fare_amount > 0
      AND vendor_id IS NOT NULL AND pickup_datetime IS NOT NULL
    GROUP BY ALL
  )
)
WHERE place <= :k
ORDER BY vendor_id, avg_tip_per_mile DESC NULLS LAST, day
"""


def top_tip_days_sql(trips: DataFrame, window: ReportWindow) -> DataFrame:
    hours = F.array(*[F.lit(hour) for hour in window.hours])
    return trips.sparkSession.sql(TOP_TIP_DAYS_SQL, args={"hours": hours, "k": window.top_k}, trips=trips)
