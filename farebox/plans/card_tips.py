"""Q4: per pickup borough, the share of card trips and their mean tip rate.

Counts and sums are taken per zone id first; the lookup joins one row per zone.
``card_share`` is a double (not a decimal cut to five digits).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farebox.functions import ratio
from farebox.operators.aggregates import row_count
from farebox.operators.filters import in_report_window, present
from farebox.operators.joins import lookup
from farebox.operators.projection import in_role
from farebox.params import ReportWindow

# Fixed value: payment type of a card trip.
CARD = 1


def card_tips(trips: DataFrame, zones: DataFrame, window: ReportWindow) -> DataFrame:
    by_card = F.col("payment_type") == CARD
    rate = F.when(by_card, ratio(F.col("tip_amount"), F.col("fare_amount")))
    per_zone = (
        trips.where(in_report_window(trips, window) & present("pu_location_id"))
        .groupBy("pu_location_id")
        .agg(
            row_count().alias("zone_trips"),
            F.count_if(by_card).alias("card_trips"),
            F.sum(rate).alias("rate_sum"),
            F.count(rate).alias("rated_trips"),
        )
    )
    pickup = in_role(zones, {"location_id": "pu_location_id", "borough": "pickup_borough"})
    rates = (
        lookup(per_zone, pickup, "pu_location_id", required=["pickup_borough"])
        .groupBy("pickup_borough")
        .agg(
            F.sum("zone_trips").alias("Trips"),
            (F.sum("card_trips") / F.sum("zone_trips")).alias("card_share"),
            ratio(F.sum("rate_sum"), F.sum("rated_trips")).alias("avg_tip_rate_card"),
        )
    )
    return rates.orderBy(F.col("avg_tip_rate_card").desc_nulls_last(), "pickup_borough")


CARD_TIPS_SQL = """
WITH per_zone AS (
  SELECT pu_location_id, count(*) AS zone_trips, count_if(payment_type = :card) AS card_trips,
         sum(rate) AS rate_sum, count(rate) AS rated_trips
  FROM (
    SELECT pu_location_id, payment_type,
           CASE WHEN payment_type = :card AND fare_amount > 0 THEN tip_amount / fare_amount END AS rate
    FROM {trips}
  )
  GROUP BY pu_location_id
)
SELECT borough AS pickup_borough,
       sum(zone_trips) AS Trips,
       sum(card_trips) / sum(zone_trips) AS card_share,
       try_divide(sum(rate_sum), sum(rated_trips)) AS avg_tip_rate_card
FROM per_zone LEFT JOIN {zones} ON location_id = pu_location_id
WHERE borough IS NOT NULL
GROUP BY borough
ORDER BY avg_tip_rate_card DESC NULLS LAST, pickup_borough
"""


def card_tips_sql(trips: DataFrame, zones: DataFrame, window: ReportWindow) -> DataFrame:
    inside = trips.where(in_report_window(trips, window))
    return trips.sparkSession.sql(CARD_TIPS_SQL, args={"card": CARD}, trips=inside, zones=zones)
