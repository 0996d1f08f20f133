"""Table layouts, scans, loaders, sinks and the CSV to Parquet conversion."""

from farebox.sources.files import (
    TripTables,
    convert_tables,
    load_table,
    load_tables,
    maybe_cache,
    register_views,
    release,
    scan_csv,
    scan_csv_rows,
    scan_parquet,
    scan_tolerant,
    under,
    write_csv_result,
    write_parquet,
)
from farebox.sources.layouts import GPS_TRIPS, ZONED_TRIPS, ZONES, Layout, conform
from farebox.sources.scratch import scratch_path

__all__ = [
    "GPS_TRIPS",
    "ZONED_TRIPS",
    "ZONES",
    "Layout",
    "TripTables",
    "conform",
    "convert_tables",
    "load_table",
    "load_tables",
    "maybe_cache",
    "register_views",
    "release",
    "scan_csv",
    "scan_csv_rows",
    "scan_parquet",
    "scan_tolerant",
    "scratch_path",
    "under",
    "write_csv_result",
    "write_parquet",
]
