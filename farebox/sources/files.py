"""Scans and sinks. Paths may be any URI Hadoop knows (local, hdfs://, s3a://)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farebox.functions import finite
from farebox.operators.joins import has_map, row_bytes
from farebox.operators.projection import evaluated_once, is_derived, with_pickup_date
from farebox.sources.layouts import GPS_TRIPS, ZONED_TRIPS, ZONES, Layout, conform

# Folder names of the converted tables.
GPS_FOLDER = "trip_2015"
ZONED_FOLDER = "trip_2024"
ZONES_FOLDER = "zones"

# Bytes of rows, as measured in memory, that one file of a partitioned write holds.
FILE_BYTES = 256 * 1024 * 1024


@dataclass(frozen=True)
class TripTables:
    gps_trips: DataFrame
    zoned_trips: DataFrame
    zones: DataFrame


def under(base: str, *parts: str) -> str:
    """A path below a base folder or URI."""
    return "/".join([base.rstrip("/"), *(part.strip("/") for part in parts)])


def scan_csv(
    spark: SparkSession, path: str, schema: T.StructType | None = None, header: bool = True
) -> DataFrame:
    """All-text CSV scan, splittable (a record is a line), with doubled quotes.

    Columns go by header name; every file may carry its own header line. An
    explicit schema saves the job that reads the header.
    """
    reader = spark.read.options(header=header, mode="PERMISSIVE", escape='"')
    return (reader.schema(schema) if schema else reader).csv(path)


def scan_csv_rows(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """Any CSV file with a header, cut to ``limit`` rows (which ones is open) if asked."""
    df = spark.read.options(header=True, mode="PERMISSIVE").csv(path)
    return df if limit is None else df.limit(limit)


def scan_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def scan_tolerant(spark: SparkSession, path: str, layout: Layout, needed: Sequence[str]) -> DataFrame:
    """CSV scan that skips short and unparseable lines.

    A line counts as broken when one of the ``needed`` clean columns is missing,
    is no number or time, or is NaN or infinite. Each needed text is parsed once,
    for the filters here and later ones alike.
    """
    needed = list(dict.fromkeys(needed))
    df = conform(scan_csv(spark, path), layout, parse_once=False)
    order, dated = df.columns, layout.dated and is_derived(df, "pickup_date")
    df = evaluated_once(df.drop("pickup_date") if dated else df, *[name for name in needed if not (dated and name == "pickup_date")])
    if dated:
        df = with_pickup_date(df)
    df = df.select(*order)
    kinds = dict(df.dtypes)
    for name in needed:
        df = df.where(finite(F.col(name)) if kinds[name] == "double" else F.col(name).isNotNull())
    return df


def load_table(spark: SparkSession, path: str, layout: Layout, fmt: str) -> DataFrame:
    """Scan + clean of one table, by format name."""
    scans = {"csv": scan_csv, "parquet": scan_parquet}
    if fmt.lower() not in scans:
        raise ValueError(f"unknown table format {fmt!r}; choose from {', '.join(scans)}")
    return conform(scans[fmt.lower()](spark, path), layout)


def load_tables(spark: SparkSession, gps_trips: str, zoned_trips: str, zones: str, fmt: str) -> TripTables:
    return TripTables(
        gps_trips=load_table(spark, gps_trips, GPS_TRIPS, fmt),
        zoned_trips=load_table(spark, zoned_trips, ZONED_TRIPS, fmt),
        zones=load_table(spark, zones, ZONES, fmt),
    )


def register_views(tables: TripTables) -> None:
    """Makes the tables known to SQL as ``trips2015``, ``trips2024`` and ``zones``."""
    tables.gps_trips.createOrReplaceTempView("trips2015")
    tables.zoned_trips.createOrReplaceTempView("trips2024")
    tables.zones.createOrReplaceTempView("zones")


def maybe_cache(df: DataFrame, enabled: bool) -> DataFrame:
    """Optional cache, for a narrow or aggregated input that several results share."""
    return df.cache() if enabled else df


def release(df: DataFrame) -> None:
    """Takes a cached table out of executor storage; anything else is left alone."""
    df.unpersist()


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = ()) -> None:
    """Snappy Parquet, optionally partitioned by columns.

    A partitioned write is rebalanced first: adaptive execution gathers each
    partition value into well-sized files and splits a value that is too large
    for one task, where every task would otherwise open a file per value. With
    adaptive execution off the rows of each value are counted instead, and the
    value is dealt to as many tasks as its size asks for.
    """
    if partition_by:
        adaptive = df.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true"
        df = df.hint("rebalance", *[F.col(name) for name in partition_by]) if adaptive else dealt_to_files(df, partition_by)
    writer = df.write.mode(mode).option("compression", "snappy")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def dealt_to_files(df: DataFrame, partition_by: Sequence[str], file_bytes: int | None = None) -> DataFrame:
    """Rows shuffled so that each partition value fills files of about ``file_bytes`` (``FILE_BYTES``) of its own, as measured.

    One pass sums the bytes of each value, in the tasks first. The sizes, a row a
    partition value, as many as the folders to be written, are joined to the
    rows, of which a hash picks the file.
    """
    spark, names = df.sparkSession, list(partition_by)
    sizes = df.groupBy(*names).agg(F.sum(row_bytes(df.drop(*names))).alias("_bytes"))
    files = sizes.select(*[F.col(name).alias(f"_of_{name}") for name in names], F.ceil(F.col("_bytes") / (file_bytes or FILE_BYTES)).cast("int").alias("_files"))
    counted = files.collect()
    same = reduce(and_, (F.col(name).eqNullSafe(F.col(f"_of_{name}")) for name in names))
    told = df.join(F.broadcast(spark.createDataFrame(counted, files.schema)), same, "left")
    hashable = [name for name in df.columns if name not in names and not has_map(df.schema[name].dataType)]
    file = F.pmod(F.xxhash64(*hashable) if hashable else F.lit(0).cast("long"), F.greatest("_files", F.lit(1)))
    tasks = max(1, sum(row["_files"] or 1 for row in counted))
    return told.withColumn("_file", file).repartition(tasks, *names, "_file").select(*df.columns)


def convert_tables(spark: SparkSession, gps_trips: str, zoned_trips: str, zones: str, target: str) -> None:
    """The three CSV tables as clean Parquet below ``target``; zoned trips by pickup date."""
    tables = load_tables(spark, gps_trips, zoned_trips, zones, "csv")
    write_parquet(tables.gps_trips, under(target, GPS_FOLDER))
    write_parquet(tables.zoned_trips, under(target, ZONED_FOLDER), partition_by=["pickup_date"])
    write_parquet(tables.zones, under(target, ZONES_FOLDER))


def load_converted(spark: SparkSession, target: str) -> TripTables:
    """The tables ``convert_tables`` wrote."""
    paths = (under(target, folder) for folder in (GPS_FOLDER, ZONED_FOLDER, ZONES_FOLDER))
    return load_tables(spark, *paths, fmt="parquet")


def write_csv_result(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV with header. One file is for a report of few rows, as a single task writes it."""
    if single_file:
        df = df.coalesce(1)
    df.write.mode("overwrite").option("header", True).csv(path)
