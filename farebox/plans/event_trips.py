"""Trip and zone tables derived from the ``events``, ``nation`` and ``region`` tables.

Times, ids and amounts are functions of the event alone, so scans stay narrow
and time filters reach Parquet (``pickup_datetime`` is the stored column).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from farebox.sources import under

# Columns of the tables that are read by every report: naming them saves a job that reads file footers.
KNOWN_SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
}

TRIP_COLUMNS = """
event_id
event_type
CAST(event_id % 2 + 1 AS INT) AS vendor_id
ts AS pickup_datetime
timestampadd(SECOND, floor(value * 60) - 60, ts) AS dropoff_datetime
value / 10 AS trip_distance
40.5D + (event_id * 37 % 500) / 1000D AS pickup_latitude
-74.2D + (event_id * 53 % 500) / 1000D AS pickup_longitude
40.5D + (event_id * 71 % 500) / 1000D AS dropoff_latitude
-74.2D + (event_id * 97 % 500) / 1000D AS dropoff_longitude
CAST(user_id % 27 AS INT) AS pu_location_id
CAST(event_id % 26 AS INT) AS do_location_id
CASE WHEN event_type = 'purchase' THEN 1 ELSE 2 END AS payment_type
value AS fare_amount
value * (event_id % 7) / 20 AS tip_amount
value * 1.5D AS total_amount
CASE WHEN event_id % 3 <> 0 THEN 2.5D END AS congestion_surcharge
CASE WHEN event_id % 11 = 0 THEN 1.25D END AS airport_fee
"""

ZONE_COLUMNS = """
n_nationkey AS location_id
r_name AS borough
n_name AS zone
'SZ_' || n_nationkey % 3 AS service_zone
"""


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    reader = spark.read.schema(KNOWN_SCHEMAS[name]) if name in KNOWN_SCHEMAS else spark.read
    return reader.parquet(under(folder, f"{name}.parquet"))


def event_trips(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "events").selectExpr(*TRIP_COLUMNS.strip().split("\n"))


def nation_zones(spark: SparkSession, folder: str) -> DataFrame:
    region = read_table(spark, folder, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    nation = read_table(spark, folder, "nation")
    return nation.join(region, "n_regionkey").selectExpr(*ZONE_COLUMNS.strip().split("\n"))
