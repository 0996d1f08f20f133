"""Runs the conversion or one report from the command line.

    python -m farebox convert --fmt csv --gps-trips IN --zoned-trips IN --zones IN --out OUT
    python -m farebox q1 --variant histogram --id 600 --fmt parquet --gps-trips IN ... --out OUT

The session comes from ``spark-submit`` or the Spark defaults as it is.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from farebox import ReportWindow, plans
from farebox.operators.joins import STRATEGIES
from farebox.plans.zone_join import ZONES_TAKEN
from farebox.sources import (
    GPS_TRIPS,
    ZONED_TRIPS,
    ZONES,
    convert_tables,
    load_table,
    scan_tolerant,
    write_csv_result,
)


class Inputs:
    """The tables of the command line, each loaded when a report asks for it."""

    def __init__(self, spark: SparkSession, options: argparse.Namespace, fail: Callable[[str], None]):
        self.spark, self.options, self.fail = spark, options, fail

    def path(self, name: str) -> str:
        if (found := getattr(self.options, name)) is None:
            self.fail(f"{self.options.job} needs --{name.replace('_', '-')}")
        return found

    def gps_trips(self) -> DataFrame:
        return load_table(self.spark, self.path("gps_trips"), GPS_TRIPS, self.options.fmt)

    def zoned(self) -> tuple[DataFrame, DataFrame]:
        loaded = (("zoned_trips", ZONED_TRIPS), ("zones", ZONES))
        trips, zones = (load_table(self.spark, self.path(name), layout, self.options.fmt) for name, layout in loaded)
        return trips, zones

    def sound_gps_trips(self, needed: Sequence[str]) -> DataFrame:
        if self.options.fmt != "csv":
            self.fail("the text variant reads CSV")
        return scan_tolerant(self.spark, self.path("gps_trips"), GPS_TRIPS, needed)


Report = Callable[[Inputs, ReportWindow, argparse.Namespace], DataFrame]

# Report and variant -> how it is built; the first variant of a report is its default.
REPORTS: dict[str, dict[str, Report]] = {
    "q1": {
        "df": lambda t, w, a: plans.hourly_profile(t.gps_trips(), w),
        "arrow": lambda t, w, a: plans.hourly_profile_arrow(t.gps_trips(), w),
        "histogram": lambda t, w, a: plans.hourly_profile_histogram(t.gps_trips(), w),
        "text": lambda t, w, a: plans.hourly_profile_histogram(t.sound_gps_trips(plans.HOURLY_NEEDS), w),
    },
    "q2": {
        "df": lambda t, w, a: plans.top_tip_days(t.gps_trips(), w),
        "sql": lambda t, w, a: plans.top_tip_days_sql(t.gps_trips(), w),
        "text": lambda t, w, a: plans.top_tip_days(t.sound_gps_trips(plans.TIP_NEEDS), w),
    },
    "q3": {
        "df": lambda t, w, a: plans.zone_flows(*t.zoned(), w),
        "sql": lambda t, w, a: plans.zone_flows_sql(*t.zoned(), w),
    },
    "q4": {
        "sql": lambda t, w, a: plans.card_tips_sql(*t.zoned(), w),
        "df": lambda t, w, a: plans.card_tips(*t.zoned(), w),
    },
    "q5": {"df": lambda t, w, a: plans.zone_balance(*t.zoned(), w, a.limit, a.strategy)},
    "q6": {"df": lambda t, w, a: plans.zone_revenue(*t.zoned(), w)},
    "join-study": {
        "df": lambda t, w, a: plans.zone_join(*t.zoned(), w, ZONES_TAKEN if a.limit is None else a.limit, a.strategy)
    },
}


def main(arguments: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="farebox", description="Trip reports on Spark")
    parser.add_argument("job", choices=["convert", *REPORTS])
    parser.add_argument("--fmt", choices=["csv", "parquet"], default="parquet")
    parser.add_argument("--gps-trips", help="read by convert, q1 and q2")
    parser.add_argument("--zoned-trips", help="read by all others")
    parser.add_argument("--zones", help="read by all others")
    parser.add_argument("--out", required=True, help="folder or URI to write to")
    parser.add_argument("--id", type=int, help="number the hours, days and K of a report derive from")
    parser.add_argument("--variant", help="form of the report; all give the same rows but for the q1 histogram; text skips broken lines")
    parser.add_argument("--limit", type=int, help="K of q5, number of zones of join-study")
    parser.add_argument("--strategy", choices=STRATEGIES, default="auto", help="join of q5 and join-study")
    options = parser.parse_args(arguments)
    spark = SparkSession.builder.appName(f"farebox {options.job}").getOrCreate()
    inputs = Inputs(spark, options, parser.error)

    if options.job == "convert":
        paths = {name: inputs.path(name) for name in ("gps_trips", "zoned_trips", "zones")}
        convert_tables(spark, **paths, target=options.out)
        return
    if options.id is None:
        parser.error("a report needs --id")
    variants = REPORTS[options.job]
    variant = options.variant or next(iter(variants))
    if variant not in variants:
        parser.error(f"{options.job} has the variants {', '.join(variants)}")
    result = variants[variant](inputs, ReportWindow.from_id(options.id), options)
    write_csv_result(result, options.out, single_file=options.job != "join-study")
    print(f"{options.job} {variant}: rows in {options.out}")


if __name__ == "__main__":
    main()
