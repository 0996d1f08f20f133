"""The reports on samples with hand-computed results, in every variant and format."""

import math

import pytest
import samples
from farebox import ReportWindow, plans
from farebox.sources import GPS_TRIPS, convert_tables, load_tables, scan_tolerant
from farebox.sources.files import load_converted

WINDOW = ReportWindow.from_id(600)


def distance_km(lat_a, lon_a, lat_b, lon_b):
    """Spherical law of cosines: an independent form."""
    a, b, d = math.radians(lat_a), math.radians(lat_b), math.radians(lon_b - lon_a)
    return 6371.0 * math.acos(math.sin(a) * math.sin(b) + math.cos(a) * math.cos(b) * math.cos(d))


@pytest.fixture(scope="module")
def raw(tmp_path_factory):
    return samples.write_all(tmp_path_factory.mktemp("raw"))


@pytest.fixture(scope="module", params=["csv", "parquet"])
def tables(request, spark, raw, tmp_path_factory):
    if request.param == "csv":
        return load_tables(spark, **raw, fmt="csv")
    target = str(tmp_path_factory.mktemp("converted"))
    convert_tables(spark, **raw, target=target)
    return load_converted(spark, target)


@pytest.mark.parametrize(
    ("report", "tolerance"),
    [(plans.hourly_profile, 1e-6), (plans.hourly_profile_arrow, 1e-6), (plans.hourly_profile_histogram, 0.5)],
)
def test_hourly_profile(tables, report, tolerance):
    rows = report(tables.gps_trips, WINDOW).collect()
    assert [(r.hour_of_day, r.hour_str, r.Trips, r.AvgDurationMin) for r in rows] == [
        (0, "00", 2, 10.0),
        (1, "01", 1, 20.0),
    ]
    assert rows[0].P90HaversineKm == pytest.approx(distance_km(40, -74, 40, -73), abs=tolerance)
    assert rows[1].P90HaversineKm == pytest.approx(distance_km(40, -73, 41, -73), abs=tolerance)


def test_histogram_gives_the_lower_edge(tables):
    rows = plans.hourly_profile_histogram(tables.gps_trips, WINDOW).collect()
    assert [r.P90HaversineKm for r in rows] == [85.0, 111.0]


def test_hourly_profile_from_text(spark, raw):
    needed = ["pickup_datetime", "dropoff_datetime", "pickup_latitude", "dropoff_latitude"]
    rows = plans.hourly_profile_histogram(scan_tolerant(spark, raw["gps_trips"], GPS_TRIPS, needed), WINDOW).collect()
    assert [(r.Trips, r.P90HaversineKm) for r in rows] == [(2, 85.0), (1, 111.0)]


@pytest.mark.parametrize("report", [plans.top_tip_days, plans.top_tip_days_sql])
def test_top_tip_days(tables, report):
    rows = report(tables.gps_trips, WINDOW).collect()
    assert [tuple(r) for r in rows] == [(1, "2015-01-01", 0.75), (2, "2015-01-01", 0.0)]


@pytest.mark.parametrize("report", [plans.zone_flows, plans.zone_flows_sql])
def test_zone_flows(tables, report):
    rows = report(tables.zoned_trips, tables.zones, WINDOW).collect()
    assert [tuple(r) for r in rows] == [("Manhattan", "Queens", 1)]


@pytest.mark.parametrize("report", [plans.card_tips, plans.card_tips_sql])
def test_card_tips(tables, report):
    rows = report(tables.zoned_trips, tables.zones, WINDOW).collect()
    assert [tuple(r) for r in rows] == [("Manhattan", 1, 0.0, None)]


@pytest.mark.parametrize("strategy", ["auto", "broadcast", "merge", "shuffle_hash"])
def test_zone_balance(tables, strategy):
    report = plans.zone_balance(tables.zoned_trips, tables.zones, WINDOW, strategy=strategy)
    assert [tuple(r) for r in report.collect()] == [
        ("Manhattan", "Midtown", 1, 0, 1.0),
        ("Queens", "Jamaica Bay", 0, 1, 1.0),
    ]


def test_zone_balance_limit(tables):
    report = plans.zone_balance(tables.zoned_trips, tables.zones, WINDOW, limit=1)
    assert [r.zone for r in report.collect()] == ["Midtown"]


def test_zone_revenue(tables):
    rows = plans.zone_revenue(tables.zoned_trips, tables.zones, WINDOW).collect()
    assert [tuple(r) for r in rows] == [(2, "Yellow Zone", 1, 9.5, 0.0, 0.0, 9.5)]


@pytest.mark.parametrize("strategy", ["auto", "broadcast", "merge", "shuffle_hash"])
def test_zone_join_keeps_trips_outside_the_first_zones(tables, strategy):
    """Only zone 2 is taken; the trip from zone 161 stays, without attributes."""
    joined = plans.zone_join(tables.zoned_trips, tables.zones, WINDOW, zone_count=1, strategy=strategy)
    assert joined.columns == [*tables.zoned_trips.columns, "borough", "zone", "service_zone"]
    rows = joined.collect()
    assert [(r.pu_location_id, r.borough, r.zone, r.service_zone) for r in rows] == [(161, None, None, None)]
    both = plans.zone_join(tables.zoned_trips, tables.zones, WINDOW, strategy=strategy).collect()
    assert [(r.borough, r.zone) for r in both] == [("Manhattan", "Midtown")]


def test_output_columns_and_types(tables):
    assert plans.hourly_profile(tables.gps_trips, WINDOW).dtypes == [
        ("hour_of_day", "int"),
        ("Trips", "bigint"),
        ("AvgDurationMin", "double"),
        ("P90HaversineKm", "double"),
        ("hour_str", "string"),
    ]
    assert plans.hourly_profile_histogram(tables.gps_trips, WINDOW).dtypes == (
        plans.hourly_profile(tables.gps_trips, WINDOW).dtypes
    )
    assert plans.top_tip_days(tables.gps_trips, WINDOW).dtypes == [
        ("vendor_id", "int"),
        ("date", "string"),
        ("avg_tip_per_mile", "double"),
    ]
    assert plans.card_tips_sql(tables.zoned_trips, tables.zones, WINDOW).dtypes == [
        ("pickup_borough", "string"),
        ("Trips", "bigint"),
        ("card_share", "double"),
        ("avg_tip_rate_card", "double"),
    ]


def test_null_vendor_is_a_group_of_revenue_but_not_of_tips(spark, tmp_path):
    row = ",2024-01-01 00:30:00,2024-01-01 00:45:00,1,1.0,1,N,161,2,2,8.0,0,0,0.0,0,0,9.5,0.0,0.0,"
    raw = samples.write_all(tmp_path)
    samples.write(tmp_path / "zoned.csv", samples.ZONED_HEADER, [row, *samples.ZONED_ROWS])
    tables = load_tables(spark, **raw, fmt="csv")
    revenue = plans.zone_revenue(tables.zoned_trips, tables.zones, WINDOW).collect()
    assert [r.vendor_id for r in revenue] == [None, 2]
    for report in (plans.top_tip_days, plans.top_tip_days_sql):
        assert [r.vendor_id for r in report(tables.zoned_trips, WINDOW).collect()] == [2]


def test_trips_of_unknown_zones_are_left_out(spark, tmp_path):
    strays = [
        "2,2024-01-01 00:30:00,2024-01-01 00:45:00,1,1.0,1,N,999,2,1,8.0,0,0,1.0,0,0,9.5,0.0,0.0,",
        "2,2024-01-01 00:30:00,2024-01-01 00:45:00,1,1.0,1,N,,161,1,8.0,0,0,1.0,0,0,9.5,0.0,0.0,",
        "2,2024-01-01 00:30:00,2024-01-01 00:45:00,1,1.0,1,N,161,,1,8.0,0,0,4.0,0,0,9.5,,,",
    ]
    raw = samples.write_all(tmp_path)
    samples.write(tmp_path / "zoned.csv", samples.ZONED_HEADER, [*samples.ZONED_ROWS, *strays])
    tables = load_tables(spark, **raw, fmt="csv")
    trips, zones = tables.zoned_trips, tables.zones
    for report in (plans.zone_flows, plans.zone_flows_sql):
        assert [tuple(r) for r in report(trips, zones, WINDOW).collect()] == [("Manhattan", "Queens", 1)]
    for report in (plans.card_tips, plans.card_tips_sql):
        assert [tuple(r) for r in report(trips, zones, WINDOW).collect()] == [("Manhattan", 2, 0.5, 0.5)]
    balance = {r.zone: (r.pickups, r.dropoffs) for r in plans.zone_balance(trips, zones, WINDOW).collect()}
    assert balance == {"Midtown": (2, 1), "Jamaica Bay": (0, 2)}
    assert [r.Trips for r in plans.zone_revenue(trips, zones, WINDOW).collect()] == [2]
