"""Scans, cleaning, sinks and what they do with unclean files."""

from datetime import date, datetime
from pathlib import Path

import pytest
import samples
from farebox.sources import (
    GPS_TRIPS,
    ZONED_TRIPS,
    ZONES,
    TripTables,
    conform,
    convert_tables,
    load_table,
    maybe_cache,
    register_views,
    release,
    scan_csv,
    scan_csv_rows,
    scan_tolerant,
    scratch_path,
    under,
    write_csv_result,
    write_parquet,
)
from farebox.sources.files import load_converted
from pyspark.sql import functions as F


def gps_row(**values):
    cells = dict(zip(samples.GPS_HEADER.split(","), samples.GPS_ROWS[0].split(",")))
    cells.update(values)
    return ",".join(cells.values())


def test_clean_types(spark, tmp_path):
    paths = samples.write_all(tmp_path)
    gps = load_table(spark, paths["gps_trips"], GPS_TRIPS, "csv")
    zoned = load_table(spark, paths["zoned_trips"], ZONED_TRIPS, "csv")
    assert len(gps.columns) == 19 and len(zoned.columns) == 21
    types = dict(zoned.dtypes)
    assert types["pickup_datetime"] == "timestamp_ntz" and types["pickup_date"] == "date"
    assert types["pu_location_id"] == "int" and types["airport_fee"] == "double"
    assert load_table(spark, paths["zones"], ZONES, "csv").dtypes == [
        ("location_id", "int"),
        ("borough", "string"),
        ("zone", "string"),
        ("service_zone", "string"),
    ]


def test_missing_required_columns_are_listed_together(spark):
    df = spark.createDataFrame([(1, "2024-01-01 00:00:00")], ["VendorID", "tpep_pickup_datetime"])
    with pytest.raises(ValueError) as error:
        conform(df, ZONED_TRIPS)
    text = str(error.value)
    assert all(name in text for name in ("dropoff_datetime", "pu_location_id", "do_location_id"))
    assert "vendor_id" not in text


def test_aliases_ignore_case_and_missing_optional_columns_are_null(spark):
    df = spark.createDataFrame([("7", "Queens", "Astoria")], ["locationid", "BOROUGH", "zone"])
    assert [tuple(r) for r in conform(df, ZONES).collect()] == [(7, "Queens", "Astoria", None)]


def test_unknown_format(spark):
    with pytest.raises(ValueError, match="orc"):
        load_table(spark, "/nowhere", ZONES, "orc")


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("2015-01-01 00:00:00", datetime(2015, 1, 1)),
        ("2015-01-01T00:00:00", datetime(2015, 1, 1)),
        (" 2015-01-01T00:00:00.123 ", datetime(2015, 1, 1, microsecond=123000)),
        ("2015-01-01 00:00:00.123456", datetime(2015, 1, 1, microsecond=123456)),
        ("2024-03-10 02:30:00", datetime(2024, 3, 10, 2, 30)),
        ("2015", None),
        ("2015-01-01", None),
        ("2015-01-01 00:00:00Z", None),
        ("2015-02-30 00:00:00", None),
        ("2015-01-01 25:00:00", None),
        ("", None),
    ],
)
def test_timestamps(spark, tmp_path, text, expected):
    path = samples.write(tmp_path / "t.csv", samples.GPS_HEADER, [gps_row(tpep_pickup_datetime=text)])
    assert load_table(spark, path, GPS_TRIPS, "csv").first().pickup_datetime == expected


def test_wall_clock_holds_in_a_zone_with_daylight_saving(spark, tmp_path):
    row = samples.ZONED_ROWS[0].replace("2024-01-01 00:30:00", "2024-03-10 02:30:00")
    paths = samples.write_all(tmp_path)
    samples.write(tmp_path / "zoned.csv", samples.ZONED_HEADER, [row])
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        row = load_table(spark, paths["zoned_trips"], ZONED_TRIPS, "csv").select(
            F.hour("pickup_datetime").alias("hour"), "pickup_date"
        ).first()
        assert (row.hour, row.pickup_date) == (2, date(2024, 3, 10))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


@pytest.mark.parametrize(
    ("text", "expected"), [("3", 3), ("1.0", 1), (" 2 ", 2), ("-4", -4), ("x", None), ("", None), ("9999999999", None)]
)
def test_whole_numbers(spark, tmp_path, text, expected):
    path = samples.write(tmp_path / "t.csv", samples.GPS_HEADER, [gps_row(passenger_count=text)])
    assert load_table(spark, path, GPS_TRIPS, "csv").first().passenger_count == expected


def test_bad_numbers_become_null_and_the_row_stays(spark, tmp_path):
    path = samples.write(tmp_path / "t.csv", samples.GPS_HEADER, [gps_row(fare_amount="ten", pickup_latitude="n/a")])
    row = load_table(spark, path, GPS_TRIPS, "csv").first()
    assert row.fare_amount is None and row.pickup_latitude is None and row.trip_distance == 2.0


NEEDED = ["vendor_id", "pickup_datetime", "pickup_latitude", "trip_distance", "tip_amount"]


def test_tolerant_scan_skips_broken_lines_of_several_files(spark, tmp_path):
    folder = tmp_path / "many"
    samples.write(folder / "a.csv", samples.GPS_HEADER, [*samples.GPS_ROWS, "1,2015-01-01 00:00:00", "junk", ""])
    samples.write(
        folder / "b.csv",
        samples.GPS_HEADER,
        [
            gps_row(trip_distance="NaN"),
            gps_row(trip_distance="Infinity"),
            gps_row(tip_amount=""),
            gps_row(tpep_pickup_datetime="soon"),
            gps_row(pickup_latitude="north"),
            gps_row(store_and_fwd_flag='"a, ""quoted"" flag"'),
            gps_row(extra="broken, but not needed".replace(",", "")),
        ],
    )
    kept = scan_tolerant(spark, str(folder), GPS_TRIPS, NEEDED)
    assert kept.count() == 5
    assert kept.where("store_and_fwd_flag like '%quoted%'").first().store_and_fwd_flag == 'a, "quoted" flag'


def test_scan_with_schema_and_without_header(spark, tmp_path):
    path = tmp_path / "bare.csv"
    path.write_text("\n".join(samples.GPS_ROWS) + "\n")
    df = scan_csv(spark, str(path), schema=GPS_TRIPS.raw_schema, header=False)
    assert df.columns == samples.GPS_HEADER.split(",")
    assert conform(df, GPS_TRIPS).count() == 3


def test_raw_schemas_match_the_raw_files():
    assert [f.name for f in GPS_TRIPS.raw_schema] == samples.GPS_HEADER.split(",")
    assert [f.name for f in ZONED_TRIPS.raw_schema] == samples.ZONED_HEADER.split(",")
    assert [f.name for f in ZONES.raw_schema] == samples.ZONES_HEADER.split(",")


def test_csv_rows_with_limit(spark, tmp_path):
    path = samples.write(tmp_path / "c.csv", "a,b", [f"{n},x" for n in range(30)])
    assert scan_csv_rows(spark, path).count() == 30
    assert scan_csv_rows(spark, path, limit=7).count() == 7
    assert scan_csv_rows(spark, path, limit=70).count() == 30


def test_conversion_round_trip(spark, tmp_path):
    row = samples.ZONED_ROWS[0].replace("2024-01-01 00:30:00", "2024-01-01 00:30:00.123456")
    undated = samples.ZONED_ROWS[0].replace("2024-01-01 00:30:00", "unknown")
    paths = samples.write_all(tmp_path / "raw")
    samples.write(tmp_path / "raw" / "zoned.csv", samples.ZONED_HEADER, [row, undated, *samples.ZONED_ROWS])
    target = str(tmp_path / "converted")
    convert_tables(spark, **paths, target=target)
    assert sorted(p.name for p in Path(under(target, "trip_2024")).glob("pickup_date=*")) == [
        "pickup_date=2024-01-01",
        "pickup_date=__HIVE_DEFAULT_PARTITION__",
    ]
    again = load_converted(spark, target)
    for name, layout in (("gps_trips", GPS_TRIPS), ("zoned_trips", ZONED_TRIPS), ("zones", ZONES)):
        before, after = load_table(spark, paths[name], layout, "csv"), getattr(again, name)
        assert before.dtypes == after.dtypes
        assert sorted(map(repr, before.collect())) == sorted(map(repr, after.collect()))


def test_one_hot_date_is_split_over_several_files(spark, tmp_path):
    """A date with most rows is written by several tasks."""
    settings = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB",
    }
    days = spark.range(0, 120_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, "2024-01-02").otherwise("2024-01-01").cast("date").alias("pickup_date"),
        F.sha2(F.col("id").cast("string"), 256).alias("load"),
    )
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        write_parquet(days, str(tmp_path / "hot"), partition_by=["pickup_date"])
    finally:
        for key, value in before.items():
            spark.conf.set(key, value) if value else spark.conf.unset(key)
    files = {p.name: len(list(p.glob("*.parquet"))) for p in (tmp_path / "hot").glob("pickup_date=*")}
    assert files["pickup_date=2024-01-01"] > 4
    assert spark.read.parquet(str(tmp_path / "hot")).count() == 120_000


def test_save_modes(spark, tmp_path):
    df, path = spark.range(5), str(tmp_path / "modes")
    write_parquet(df, path)
    write_parquet(df, path, mode="append")
    assert spark.read.parquet(path).count() == 10
    write_parquet(df, path)
    assert spark.read.parquet(path).count() == 5


def test_csv_result_is_one_file_with_header(spark, tmp_path):
    df = spark.range(0, 100, 1, 4).selectExpr("id", "id * 2 as twice")
    write_csv_result(df, str(tmp_path / "one"), single_file=True)
    files = list((tmp_path / "one").glob("part-*.csv"))
    assert len(files) == 1 and files[0].read_text().startswith("id,twice\n")
    write_csv_result(df, str(tmp_path / "many"))
    assert len(list((tmp_path / "many").glob("part-*.csv"))) == 4
    assert scan_csv(spark, str(tmp_path / "many")).count() == 100


def test_views_and_cache(spark, tmp_path):
    paths = samples.write_all(tmp_path)
    tables = TripTables(
        load_table(spark, paths["gps_trips"], GPS_TRIPS, "csv"),
        load_table(spark, paths["zoned_trips"], ZONED_TRIPS, "csv"),
        load_table(spark, paths["zones"], ZONES, "csv"),
    )
    register_views(tables)
    counts = spark.sql("SELECT (SELECT count(*) FROM trips2015) a, (SELECT count(*) FROM trips2024) b, "
                       "(SELECT count(*) FROM zones) c").first()
    assert tuple(counts) == (3, 2, 2)
    cached = maybe_cache(tables.zones, True)
    assert cached.storageLevel.useMemory
    cached.unpersist()
    assert not maybe_cache(tables.zones, False).storageLevel.useMemory


def test_paths(spark):
    assert under("hdfs://host:9000/base/", "a", "/b/") == "hdfs://host:9000/base/a/b"
    assert under("base") == "base"
    assert scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_instants_are_read_as_utc_in_any_session_zone(spark, tmp_path):
    path = str(tmp_path / "instants")
    zone = spark.conf.get("spark.sql.session.timeZone")
    found = []
    try:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        stamps = "timestamp'2024-01-01 00:00:07.5' AS pickup_datetime, timestamp'1969-12-31 23:59:59' AS dropoff_datetime"
        spark.sql(f"SELECT 1 AS vendor_id, {stamps}, 3 AS pu_location_id, 4 AS do_location_id").write.parquet(path)
        for name in ("UTC", "America/New_York", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", name)
            trips = load_table(spark, path, ZONED_TRIPS, "parquet")
            found.append(tuple(trips.select(*[F.col(c).cast("string") for c in ("pickup_datetime", "dropoff_datetime", "pickup_date")]).first()))
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert found == [("2024-01-01 00:00:07.5", "1969-12-31 23:59:59", "2024-01-01")] * 3


def test_tolerant_scan_parses_a_stamp_once(spark, tmp_path):
    from joinplans import plan_text

    path = str(tmp_path / "gps")
    spark.createDataFrame([tuple("1" for _ in GPS_TRIPS.fields)], GPS_TRIPS.raw_schema).write.option("header", True).csv(path)
    trips = scan_tolerant(spark, path, GPS_TRIPS, ["pickup_datetime", "dropoff_datetime", "fare_amount"])
    late = trips.where("pickup_datetime < dropoff_datetime AND hour(pickup_datetime) = 3").select("pickup_datetime", "fare_amount")
    assert plan_text(late).count("RLIKE") <= 2


def test_released_tables_leave_storage(spark):
    cached = maybe_cache(spark.range(10), True)
    assert cached.count() == 10 and cached.storageLevel.useMemory
    release(cached)
    assert not cached.storageLevel.useMemory


def test_a_hot_date_fills_several_files_without_adaptive_execution(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("farebox.sources.files.FILE_BYTES", 40_000)
    days = spark.range(6000).select(
        "id", F.when(F.col("id") % 3 > 0, F.lit("2024-01-01")).when(F.col("id") % 50 > 0, F.lit("2024-01-02")).cast("date").alias("pickup_date")
    )
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        write_parquet(days.repartition(7), str(tmp_path / "hot"), partition_by=["pickup_date"])
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    files = {folder.name: len(list(folder.glob("*.parquet"))) for folder in (tmp_path / "hot").iterdir() if folder.is_dir()}
    assert 3 <= files["pickup_date=2024-01-01"] <= 6 and files["pickup_date=2024-01-02"] <= 3
    assert files["pickup_date=__HIVE_DEFAULT_PARTITION__"] == 1
    back = spark.read.parquet(str(tmp_path / "hot"))
    assert back.exceptAll(days).count() == days.exceptAll(back).count() == 0
