"""Q3: the K largest flows between different boroughs.

Trips are counted per pair of zone ids before the zones are looked up. The
lookups and the second count then see at most (zones x zones) rows, so neither a
zone holding a third of the trips nor a large zone table costs a big shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farebox.operators.aggregates import row_count
from farebox.operators.filters import in_report_window, present
from farebox.operators.joins import lookup
from farebox.operators.projection import in_role
from farebox.operators.ranking import top_overall
from farebox.params import ReportWindow


def zone_flows(trips: DataFrame, zones: DataFrame, window: ReportWindow) -> DataFrame:
    pairs = (
        trips.where(in_report_window(trips, window) & present("pu_location_id", "do_location_id"))
        .groupBy("pu_location_id", "do_location_id")
        .agg(row_count().alias("pair_trips"))
    )
    pickup = in_role(zones, {"location_id": "pu_location_id", "borough": "pickup_borough"})
    dropoff = in_role(zones, {"location_id": "do_location_id", "borough": "dropoff_borough"})
    named = lookup(lookup(pairs, pickup, "pu_location_id"), dropoff, "do_location_id")
    crossing = present("pickup_borough", "dropoff_borough") & (F.col("pickup_borough") != F.col("dropoff_borough"))
    flows = (
        named.where(crossing)
        .groupBy("pickup_borough", "dropoff_borough")
        .agg(F.sum("pair_trips").alias("trips"))
    )
    return top_overall(flows, [F.col("trips").desc(), "pickup_borough", "dropoff_borough"], window.top_k)


ZONE_FLOWS_SQL = """
WITH pairs AS (
  SELECT pu_location_id, do_location_id, count(*) AS pair_trips
  FROM {trips}
  GROUP BY ALL
)
SELECT origin.borough AS pickup_borough, target.borough AS dropoff_borough, sum(pair_trips) AS trips
FROM pairs
LEFT JOIN {zones} AS origin ON origin.location_id = pu_location_id
LEFT JOIN {zones} AS target ON target.location_id = do_location_id
WHERE origin.borough <> target.borough
GROUP BY ALL
ORDER BY trips DESC, pickup_borough, dropoff_borough
LIMIT :k
"""


def zone_flows_sql(trips: DataFrame, zones: DataFrame, window: ReportWindow) -> DataFrame:
    inside = trips.where(in_report_window(trips, window))
    return trips.sparkSession.sql(ZONE_FLOWS_SQL, args={"k": window.top_k}, trips=inside, zones=zones)
