"""Times the conversion and every report on CSV and Parquet; prints one JSON line.

What is timed is planning and running the action, with the DataFrame built
beforehand, but for the entries on the large copy, which build it too. Results go to the ``noop`` sink, which computes every column and
row; a ``count()`` would let the optimizer drop percentiles, sums and the UDF.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from farebox import ReportWindow, plans  # noqa: E402
from farebox.driver_queries import write_raw_tables  # noqa: E402
from farebox.plans import HOURLY_NEEDS, TIP_NEEDS  # noqa: E402
from farebox.plans.event_trips import event_trips, nation_zones  # noqa: E402
from farebox.sources import (  # noqa: E402
    GPS_TRIPS,
    TripTables,
    convert_tables,
    load_tables,
    scan_tolerant,
    scratch_path,
)
from farebox.sources.files import load_converted  # noqa: E402

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
COPIES = int(os.environ.get("BENCH_COPIES", "50"))
REPEATS = int(os.environ.get("BENCH_REPEATS", "3"))
WINDOW = ReportWindow.from_id(600)


def reports(spark: SparkSession, raw: dict[str, str], converted: str) -> dict[str, DataFrame]:
    """Each report on CSV, on converted Parquet and on the driver tables themselves."""
    events = event_trips(spark, FOLDER)
    sources = {
        "csv": load_tables(spark, **raw, fmt="csv"),
        "parquet": load_converted(spark, converted),
        "events": TripTables(events, events, nation_zones(spark, FOLDER)),
    }
    sound_hourly = scan_tolerant(spark, raw["gps_trips"], GPS_TRIPS, HOURLY_NEEDS)
    sound_tips = scan_tolerant(spark, raw["gps_trips"], GPS_TRIPS, TIP_NEEDS)
    runs = {
        "q1_text_csv": plans.hourly_profile_histogram(sound_hourly, WINDOW),
        "q2_text_csv": plans.top_tip_days(sound_tips, WINDOW),
    }
    for source, tables in sources.items():
        gps, zoned, zones = tables.gps_trips, tables.zoned_trips, tables.zones
        runs |= {
            f"q1_df_{source}": plans.hourly_profile(gps, WINDOW),
            f"q1_udf_{source}": plans.hourly_profile_arrow(gps, WINDOW),
            f"q1_histogram_{source}": plans.hourly_profile_histogram(gps, WINDOW),
            f"q2_df_{source}": plans.top_tip_days(gps, WINDOW),
            f"q2_sql_{source}": plans.top_tip_days_sql(gps, WINDOW),
            f"q3_df_{source}": plans.zone_flows(zoned, zones, WINDOW),
            f"q3_sql_{source}": plans.zone_flows_sql(zoned, zones, WINDOW),
            f"q4_df_{source}": plans.card_tips(zoned, zones, WINDOW),
            f"q4_sql_{source}": plans.card_tips_sql(zoned, zones, WINDOW),
            f"q5_{source}": plans.zone_balance(zoned, zones, WINDOW),
            f"q5_merge_{source}": plans.zone_balance(zoned, zones, WINDOW, strategy="merge"),
            f"q6_{source}": plans.zone_revenue(zoned, zones, WINDOW),
            f"join_auto_{source}": plans.zone_join(zoned, zones, WINDOW),
            f"join_merge_{source}": plans.zone_join(zoned, zones, WINDOW, strategy="merge"),
        }
    return runs


def large_copy(spark: SparkSession) -> str:
    """The tables of the trip view with every event ``COPIES`` times, for times that are work rather than job start."""
    target = scratch_path(spark, "bench-large")
    events = spark.read.parquet(f"{FOLDER}/events.parquet").withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(COPIES))))
    events.drop("copy").repartition(32).write.parquet(f"{target}/events.parquet")
    for name in ("nation", "region"):
        spark.read.parquet(f"{FOLDER}/{name}.parquet").write.parquet(f"{target}/{name}.parquet")
    return target


def large_reports(spark: SparkSession, folder: str) -> dict[str, Callable[[], DataFrame]]:
    """Reports on the large copy, planned anew in every run."""

    def trips() -> DataFrame:
        return event_trips(spark, folder)

    def both() -> tuple[DataFrame, DataFrame]:
        return trips(), nation_zones(spark, folder)

    return {
        "q1_df_large": lambda: plans.hourly_profile(trips(), WINDOW),
        "q1_histogram_large": lambda: plans.hourly_profile_histogram(trips(), WINDOW),
        "q2_df_large": lambda: plans.top_tip_days(trips(), WINDOW),
        "q3_df_large": lambda: plans.zone_flows(*both(), WINDOW),
        "q4_sql_large": lambda: plans.card_tips_sql(*both(), WINDOW),
        "q5_large": lambda: plans.zone_balance(*both(), WINDOW),
        "q6_large": lambda: plans.zone_revenue(*both(), WINDOW),
        "join_broadcast_large": lambda: plans.zone_join(*both(), WINDOW, strategy="broadcast"),
    }


def seconds(action: Callable[[], None]) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("farebox-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    raw = write_raw_tables(spark, FOLDER)
    targets = iter([scratch_path(spark, "bench") for _ in range(REPEATS + 1)])
    converted = next(targets)
    convert_tables(spark, **raw, target=converted)

    times = {
        "convert": statistics.median(
            seconds(lambda: convert_tables(spark, **raw, target=next(targets))) for _ in range(REPEATS)
        )
    }
    runs = {name: lambda report=report: report for name, report in reports(spark, raw, converted).items()}
    for name, build in (runs | large_reports(spark, large_copy(spark))).items():

        def run(build=build) -> None:
            build().write.format("noop").mode("overwrite").save()

        run()  # warm-up
        times[name] = statistics.median(seconds(run) for _ in range(REPEATS))
    print(
        json.dumps(
            {
                "metric": "total seconds, median per report, noop sink",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": {name: round(value, 4) for name, value in times.items()},
                "sf": Path(FOLDER).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
