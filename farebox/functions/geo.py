"""Great-circle distance, as column math and as an Arrow UDF."""

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: mean Earth radius in km.
EARTH_RADIUS_KM = 6371.0


def great_circle_km(lat_a: Column, lon_a: Column, lat_b: Column, lon_b: Column) -> Column:
    """Haversine distance in km, inside whole-stage codegen."""
    half_lat = F.sin(F.radians(lat_b - lat_a) / 2)
    half_lon = F.sin(F.radians(lon_b - lon_a) / 2)
    chord = half_lat * half_lat + F.cos(F.radians(lat_a)) * F.cos(F.radians(lat_b)) * half_lon * half_lon
    # abs(): rounding can lift the chord of antipodal points a hair above 1.
    return F.atan2(F.sqrt(chord), F.sqrt(F.abs(1 - chord))) * (2 * EARTH_RADIUS_KM)


def great_circle_km_arrow(lat_a: Column, lon_a: Column, lat_b: Column, lon_b: Column) -> Column:
    """The same distance in Python over Arrow batches; NULL in gives NULL out.

    The function is local so that it travels to the executors by value and needs
    no copy of this package there.
    """
    diameter = 2 * EARTH_RADIUS_KM

    @F.pandas_udf("double")
    def distance(lat_a: pd.Series, lon_a: pd.Series, lat_b: pd.Series, lon_b: pd.Series) -> pd.Series:
        half_lat, half_lon = np.radians(lat_b - lat_a) / 2, np.radians(lon_b - lon_a) / 2
        across = np.cos(np.radians(lat_a)) * np.cos(np.radians(lat_b))
        chord = np.sin(half_lat) ** 2 + across * np.sin(half_lon) ** 2
        return diameter * np.arcsin(np.sqrt(np.minimum(chord, 1.0)))

    return distance(lat_a, lon_a, lat_b, lon_b)
