"""Shape of the physical plans: what reaches the scan, what is shuffled, what is not."""

import contextlib
import io
import re
import threading

import pytest
import samples
from farebox import ReportWindow, plans
from farebox.driver_queries import QUERIES
from farebox.operators.joins import join_with_strategy
from farebox.plans.event_trips import event_trips, nation_zones
from farebox.sources import convert_tables, load_tables
from farebox.sources.files import load_converted
from joinplans import strategy_labels
from pyspark.sql import functions as F

WINDOW = ReportWindow.from_id(600)


def plan_of(df, mode: str = "formatted") -> str:
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain(mode)
    return text.getvalue().split("== Initial Plan ==")[0]


def scans_of(plan: str, table: str) -> list[str]:
    blocks = plan.split("\n\n")
    return [b for b in blocks if "Scan parquet" in b and f"/{table}" in b and "ReadSchema" in b]


@pytest.mark.parametrize(
    ("name", "columns"),
    [
        ("q1_hourly_df", {"event_id", "ts", "value"}),
        ("q2_top_days_df", {"event_id", "ts", "value"}),
        ("q3_flows_df", {"event_id", "ts", "user_id"}),
        ("q5_imbalance", {"event_id", "ts", "user_id"}),
        ("q6_revenue", {"event_id", "ts", "user_id", "value"}),
        ("agg_count_by_key", {"ts"}),
    ],
)
def test_one_narrow_scan_of_the_facts(spark, data, name, columns):
    plan = plan_of(QUERIES[name](spark, data))
    (scan,) = scans_of(plan, "events.parquet")
    read = re.search(r"ReadSchema: struct<(.*)>", scan).group(1)
    assert {part.split(":")[0] for part in read.split(",")} == columns


@pytest.mark.parametrize("name", ["q3_flows_df", "q3_flows_sql", "q4_card_share", "q5_imbalance", "q6_revenue"])
def test_dates_are_pushed_into_the_scan(spark, data, name):
    (scan,) = scans_of(plan_of(QUERIES[name](spark, data)), "events.parquet")
    assert re.search(r"PushedFilters: .*(GreaterThanOrEqual|Or)\(", scan)


@pytest.mark.parametrize(
    "name", ["q3_flows_df", "q3_flows_sql", "q4_card_share", "q4_card_share_df", "q5_imbalance", "q6_revenue"]
)
def test_facts_are_aggregated_before_they_are_joined(spark, data, name):
    """Between the fact scan and the first join above it lies an aggregate with its shuffle."""
    plan = plan_of(QUERIES[name](spark, data)).split("\n\n")[0]
    lines = plan.splitlines()
    facts = next(n for n, line in enumerate(lines) if "Scan parquet" in line and "(1)" in line)
    depth = lines[facts].index("Scan")
    above = []
    for line in reversed(lines[:facts]):
        bare = re.search(r"[A-Z]\w+", line)
        if bare and bare.start() < depth:
            depth = bare.start()
            above.append(bare.group(0))
    first_join = next(n for n, operator in enumerate(above) if operator.endswith("Join"))
    assert above[:first_join].count("HashAggregate") == 2 and "Exchange" in above[:first_join]


def test_top_k_is_cut_before_the_shuffle(spark, data):
    for name in ("q2_top_days_df", "q2_top_days_sql", "win_topk_row_number"):
        assert plan_of(QUERIES[name](spark, data)).count("WindowGroupLimit") >= 2
    assert "TakeOrderedAndProject" in plan_of(QUERIES["q3_flows_df"](spark, data))


def test_converted_trips_are_pruned_by_date(spark, tmp_path):
    convert_tables(spark, **samples.write_all(tmp_path / "raw"), target=str(tmp_path / "converted"))
    tables = load_converted(spark, str(tmp_path / "converted"))
    for report in (plans.zone_flows, plans.zone_flows_sql, plans.card_tips_sql, plans.zone_balance, plans.zone_revenue):
        (scan,) = scans_of(plan_of(report(tables.zoned_trips, tables.zones, WINDOW)), "trip_2024")
        assert re.search(r"PartitionFilters: \[.*pickup_date#\d+L? IN", scan)
    profile = plan_of(plans.hourly_profile(tables.gps_trips, WINDOW))
    (scan,) = scans_of(profile, "trip_2015")
    assert "GreaterThanOrEqual(pickup_latitude,-90.0)" in scan


def test_the_udf_variant_filters_before_python(spark, data):
    plan = plan_of(QUERIES["q1_hourly_udf"](spark, data)).split("\n\n")[0]
    assert plan.index("ArrowEvalPython") < plan.index("Filter")
    assert "ArrowEvalPython" not in plan_of(QUERIES["q1_hourly_df"](spark, data))


def test_no_report_needs_a_nested_loop(spark, data):
    for name, query in QUERIES.items():
        if name.startswith(("q", "join", "agg", "win", "sort", "flt", "prj")) and "text" not in name:
            plan = plan_of(query(spark, data))
            assert "NestedLoop" not in plan and "Cartesian" not in plan, name


def test_a_lookup_with_required_attributes_is_an_inner_join(spark, data):
    assert "LeftOuter" not in plan_of(QUERIES["join_left_notnull"](spark, data), "simple")
    assert "LeftOuter" in plan_of(QUERIES["join_role_playing"](spark, data), "simple")


def test_join_study_changes_the_plan_and_nothing_else(spark, data):
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")
    before = [spark.conf.get(name) for name in names]
    trips, zones = event_trips(spark, data), nation_zones(spark, data)
    results = {}
    for strategy, label in (("auto", "BROADCAST"), ("merge", "MERGE"), ("shuffle_hash", "SHUFFLE_HASH")):
        df = plans.zone_join(trips, zones, WINDOW, zone_count=10, strategy=strategy)
        results[strategy] = sorted(map(repr, df.collect()))
        assert label in strategy_labels(df)
    assert results["auto"] == results["merge"] == results["shuffle_hash"]
    assert before == [spark.conf.get(name) for name in names]


@pytest.mark.parametrize("strategy", ["merge", "shuffle_hash"])
def test_salt_spreads_one_hot_key(spark, strategy):
    """All rows share one key: without a salt one task gets them all."""
    hot = spark.range(4000).select("id", (F.col("id") * 0 + 7).cast("int").alias("k"))
    dim = spark.createDataFrame([(7, "seven")], "k int, name string")

    def largest_task(salt_by) -> int:
        joined = join_with_strategy(hot, dim, "k", strategy=strategy, salt_by=salt_by)
        per_task = joined.groupBy(F.spark_partition_id().alias("task"), "name").count().collect()
        assert sum(r["count"] for r in per_task if r["name"] == "seven") == 4000
        return max(r["count"] for r in per_task)

    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert largest_task([]) == 4000
        assert largest_task(["id"]) < 2000
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_adaptive_execution_splits_a_hot_key_without_a_salt(spark):
    """A left join reads a hot key's map output in several tasks."""
    hot = spark.range(0, 40_000, 1, 16).select(
        F.when(F.col("id") % 3 > 0, 7).otherwise((F.col("id") % 1000).cast("int")).alias("k"),
        F.sha2(F.col("id").cast("string"), 256).alias("load"),
    )
    dim = spark.range(1000).select(F.col("id").cast("int").alias("k"), F.concat(F.lit("n"), "id").alias("name"))
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        joined = join_with_strategy(hot, dim, "k", strategy="merge")
        rows = joined.collect()
        assert len(rows) == 40_000 and all(r.name == f"n{r.k}" for r in rows)
        assert "SortMergeJoin(skew=true)" in plan_of(joined, "simple")
    finally:
        for key in settings:
            spark.conf.unset(key)


def test_percentiles_keep_the_scan_as_it_is(spark, data):
    for name in ("q1_hourly_df", "q1_hourly_udf", "agg_percentile_approx"):
        assert "Coalesce " not in plan_of(QUERIES[name](spark, data), "simple"), name


def test_derived_dates_reach_a_plain_parquet_scan(spark, data):
    plan = plan_of(QUERIES["src_parquet_unpartitioned"](spark, data))
    assert "GreaterThanOrEqual(pickup_datetime" in plan and "LessThan(pickup_datetime" in plan


def test_csv_stamps_are_parsed_once(spark, tmp_path):
    """Whatever the number of dates, the filter compares a stamp that was parsed below it."""
    tables = load_tables(spark, **samples.write_all(tmp_path / "raw"), fmt="csv")
    window = ReportWindow.from_id(600)
    assert len(window.date_spans) > 3
    reports = [
        plans.zone_flows(tables.zoned_trips, tables.zones, window),
        plans.zone_flows_sql(tables.zoned_trips, tables.zones, window),
        plans.card_tips(tables.zoned_trips, tables.zones, window),
        plans.card_tips_sql(tables.zoned_trips, tables.zones, window),
        plans.zone_balance(tables.zoned_trips, tables.zones, window),
        plans.zone_revenue(tables.zoned_trips, tables.zones, window),
        plans.zone_join(tables.zoned_trips, tables.zones, window),
    ]
    for report in reports:
        plan = report._jdf.queryExecution().optimizedPlan().toString()
        stamps = 1 + ("dropoff_datetime" in report.columns)
        assert plan.count("d{4}-") == stamps, plan  # the pattern of a stamp


def test_the_histogram_computes_a_distance_once(spark, data):
    plan = QUERIES["q1_histogram_p90"](spark, data)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.upper().count("ASIN(") + plan.upper().count("ATAN2(") == 1, plan


def test_a_skewed_merge_does_not_make_every_pair(spark, tmp_path):
    """90 billion pairs share the hot key; the jobs are ended should they take two minutes."""
    n = 300_000
    spark.range(n).selectExpr("id * 5 AS o_orderkey", "7 + 40 * id AS o_custkey").write.parquet(str(tmp_path / "orders.parquet"))
    spark.range(n).selectExpr("id * 3 AS c_custkey").write.parquet(str(tmp_path / "customer.parquet"))
    limit = threading.Timer(120, spark.sparkContext.cancelAllJobs)
    limit.start()
    try:
        (row,) = QUERIES["join_full_outer_skewed"](spark, str(tmp_path)).collect()
    finally:
        limit.cancel()
    mixed = sum(o * 5 % 13 for o in range(n)) * sum(c * 3 % 17 for c in range(n))
    assert row.asDict() == {"k": 7, "rows": n * n, "orders": n * n, "customers": n * n, "mixed": mixed}
