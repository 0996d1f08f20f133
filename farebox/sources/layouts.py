"""Column layouts of the three tables and the cleaner they drive.

A layout is data; ``conform`` turns a raw table of any accepted spelling into
the typed columns of its layout with one projection, so Catalyst prunes what a
report does not read.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farebox.functions import parse_decimal, parse_stamp, parse_whole, utc_clock
from farebox.operators.projection import evaluated_once, with_pickup_date


@dataclass(frozen=True)
class Field:
    """One clean column: its type, its raw header, and whether a table must have it.

    A table may spell the column either way, in any case.
    """

    name: str
    type: str
    header: str
    required: bool = False

    @property
    def spellings(self) -> tuple[str, str]:
        return self.header, self.name


@dataclass(frozen=True)
class Layout:
    """A table's columns, whether it carries ``pickup_date``, and the time that reports filter on."""

    title: str
    fields: tuple[Field, ...]
    dated: bool = False
    moment: str | None = None

    @property
    def raw_schema(self) -> T.StructType:
        """All-text schema of the raw files, for scans that need no header."""
        return T.StructType([T.StructField(field.header, T.StringType()) for field in self.fields])


# Columns, types and headers of the trip and zone files.
GPS_TRIPS = Layout(
    "GPS trips",
    (
        Field("vendor_id", "int", "VendorID", required=True),
        Field("pickup_datetime", "timestamp_ntz", "tpep_pickup_datetime", required=True),
        Field("dropoff_datetime", "timestamp_ntz", "tpep_dropoff_datetime", required=True),
        Field("passenger_count", "int", "passenger_count"),
        Field("trip_distance", "double", "trip_distance"),
        Field("pickup_longitude", "double", "pickup_longitude", required=True),
        Field("pickup_latitude", "double", "pickup_latitude", required=True),
        Field("ratecode_id", "int", "RateCodeID"),
        Field("store_and_fwd_flag", "string", "store_and_fwd_flag"),
        Field("dropoff_longitude", "double", "dropoff_longitude", required=True),
        Field("dropoff_latitude", "double", "dropoff_latitude", required=True),
        Field("payment_type", "int", "payment_type"),
        Field("fare_amount", "double", "fare_amount"),
        Field("extra", "double", "extra"),
        Field("mta_tax", "double", "mta_tax"),
        Field("tip_amount", "double", "tip_amount"),
        Field("tolls_amount", "double", "tolls_amount"),
        Field("improvement_surcharge", "double", "improvement_surcharge"),
        Field("total_amount", "double", "total_amount"),
    ),
    moment="pickup_datetime",
)

ZONED_TRIPS = Layout(
    "zoned trips",
    (
        Field("vendor_id", "int", "VendorID", required=True),
        Field("pickup_datetime", "timestamp_ntz", "tpep_pickup_datetime", required=True),
        Field("dropoff_datetime", "timestamp_ntz", "tpep_dropoff_datetime", required=True),
        Field("passenger_count", "int", "passenger_count"),
        Field("trip_distance", "double", "trip_distance"),
        Field("ratecode_id", "int", "RatecodeID"),
        Field("store_and_fwd_flag", "string", "store_and_fwd_flag"),
        Field("pu_location_id", "int", "PULocationID", required=True),
        Field("do_location_id", "int", "DOLocationID", required=True),
        Field("payment_type", "int", "payment_type"),
        Field("fare_amount", "double", "fare_amount"),
        Field("extra", "double", "extra"),
        Field("mta_tax", "double", "mta_tax"),
        Field("tip_amount", "double", "tip_amount"),
        Field("tolls_amount", "double", "tolls_amount"),
        Field("improvement_surcharge", "double", "improvement_surcharge"),
        Field("total_amount", "double", "total_amount"),
        Field("congestion_surcharge", "double", "congestion_surcharge"),
        Field("airport_fee", "double", "Airport_fee"),
        Field("cbd_congestion_fee", "double", "cbd_congestion_fee"),
    ),
    dated=True,
    moment="pickup_datetime",
)

ZONES = Layout(
    "zones",
    (
        Field("location_id", "int", "LocationID", required=True),
        Field("borough", "string", "Borough", required=True),
        Field("zone", "string", "Zone", required=True),
        Field("service_zone", "string", "service_zone"),
    ),
)


# How each type is read from text.
PARSERS = {"int": parse_whole, "double": parse_decimal, "timestamp_ntz": parse_stamp}


def find_column(columns: Sequence[str], names: Sequence[str]) -> str | None:
    """The table's own spelling of the first of ``names`` it has, ignoring case."""
    spelling = {column.lower(): column for column in columns}
    return next((spelling[name.lower()] for name in names if name.lower() in spelling), None)


def require_columns(df: DataFrame, layout: Layout) -> None:
    """One error for all required fields the table lacks, before any job runs."""
    missing = [
        f"{field.name} (as {' or '.join(dict.fromkeys(field.spellings))})"
        for field in layout.fields
        if field.required and find_column(df.columns, field.spellings) is None
    ]
    if missing:
        raise ValueError(f"the {layout.title} table lacks required columns: {'; '.join(missing)}")


def _typed(column: Column, stored: T.DataType, wanted: str) -> Column:
    """Text is parsed without raising; a stored type is kept, or cast where it differs.

    A kept column stays bare, so filters on it still reach the Parquet scan.
    """
    if stored.simpleString() == wanted:
        return column
    if isinstance(stored, T.TimestampType) and wanted == "timestamp_ntz":
        return utc_clock(column)
    if isinstance(stored, T.StringType) and wanted in PARSERS:
        return PARSERS[wanted](column)
    return column.try_cast(wanted)


def conform(df: DataFrame, layout: Layout, parse_once: bool = True) -> DataFrame:
    """Raw or already clean table -> typed columns of the layout.

    A field the table lacks becomes a typed NULL. Dated layouts carry
    ``pickup_date`` as a date, taken from the table or from the pickup time.

    Where the layout's time is stored as text, it is parsed once a row, before any filter sees it; otherwise a filter with
    many date spans would parse it for each of them. A stored timestamp stays bare.
    """
    require_columns(df, layout)
    stored = {field.name: field.dataType for field in df.schema.fields}

    def pick(name: str, names: Sequence[str], wanted: str) -> Column:
        source = find_column(df.columns, names)
        if source is None:
            return F.lit(None).cast(wanted).alias(name)
        return _typed(F.col(f"`{source}`"), stored[source], wanted).alias(name)

    columns = [pick(field.name, field.spellings, field.type) for field in layout.fields]
    spellings = next((field.spellings for field in layout.fields if field.name == layout.moment), ())
    texts = parse_once and isinstance(stored.get(find_column(df.columns, spellings)), T.StringType)

    def settled(clean: DataFrame) -> DataFrame:
        return evaluated_once(clean, layout.moment) if texts else clean

    if not layout.dated:
        return settled(df.select(*columns))
    if (given := find_column(df.columns, ["pickup_date"])) is not None:
        columns.append(_typed(F.col(f"`{given}`"), stored[given], "date").alias("pickup_date"))
    return with_pickup_date(settled(df.select(*columns)))
