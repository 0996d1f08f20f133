"""Small raw files in the layouts of the trip and zone tables."""

from __future__ import annotations

from pathlib import Path

GPS_HEADER = (
    "VendorID,tpep_pickup_datetime,tpep_dropoff_datetime,passenger_count,trip_distance,pickup_longitude,"
    "pickup_latitude,RateCodeID,store_and_fwd_flag,dropoff_longitude,dropoff_latitude,payment_type,fare_amount,"
    "extra,mta_tax,tip_amount,tolls_amount,improvement_surcharge,total_amount"
)
ZONED_HEADER = (
    "VendorID,tpep_pickup_datetime,tpep_dropoff_datetime,passenger_count,trip_distance,RatecodeID,"
    "store_and_fwd_flag,PULocationID,DOLocationID,payment_type,fare_amount,extra,mta_tax,tip_amount,tolls_amount,"
    "improvement_surcharge,total_amount,congestion_surcharge,Airport_fee,cbd_congestion_fee"
)
ZONES_HEADER = "LocationID,Borough,Zone,service_zone"

GPS_ROWS = [
    "1,2015-01-01 00:00:00,2015-01-01 00:10:00,1,2.0,-74.0,40.0,1,N,-73.0,40.0,1,10.0,0,0,2.0,0,0,12.0",
    "1,2015-01-01T00:10:00,2015-01-01T00:20:00,1,2.0,-74.0,40.0,1,N,-73.0,40.0,1,10.0,0,0,1.0,0,0,11.0",
    "2,2015-01-01 01:00:00,2015-01-01 01:20:00,1,1.0,-73.0,40.0,1,N,-73.0,41.0,1,5.0,0,0,0.0,0,0,5.0",
]
ZONED_ROWS = [
    "2,2024-01-01 00:30:00,2024-01-01 00:45:00,1,1.0,1,N,161,2,2,8.0,0,0,0.0,0,0,9.5,0.0,0.0,",
    "1,2024-01-01 10:00:00,2024-01-01 10:10:00,1,1.0,1,N,2,161,1,10.0,0,0,2.0,0,0,12.0,2.5,0.0,",
]
ZONE_ROWS = ["161,Manhattan,Midtown,Yellow Zone", "2,Queens,Jamaica Bay,Boro Zone"]


def write(path: Path, header: str, rows: list[str]) -> str:
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join([header, *rows]) + "\n")
    return str(path)


def write_all(folder: Path) -> dict[str, str]:
    """The three raw tables; the arguments of ``load_tables``."""
    return {
        "gps_trips": write(folder / "gps.csv", GPS_HEADER, GPS_ROWS),
        "zoned_trips": write(folder / "zoned.csv", ZONED_HEADER, ZONED_ROWS),
        "zones": write(folder / "zones.csv", ZONES_HEADER, ZONE_ROWS),
    }
