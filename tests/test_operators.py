"""Operators against brute force in plain Python on small random tables."""

import math
import random
from collections import defaultdict

import pytest
from farebox.functions import finite, great_circle_km, great_circle_km_arrow, ratio
from farebox.operators.aggregates import (
    exact_percentile_by,
    first_run_mean,
    histogram,
    histogram_percentile,
    imbalance,
    mean_ratio,
    min_avg_max,
    percentile_by,
    share,
    sum_or_zero,
)
from farebox.operators.filters import moment_in, valid_point
from farebox.operators.joins import (
    first_rows,
    hot_keys,
    join_with_strategy,
    lookup,
    measured_bytes,
    merge_all,
    merge_all_folded,
    merge_all_skewed,
)
from farebox.operators.projection import evaluated_once, in_role, text_keys, with_defaults, with_revenue_defaults
from farebox.operators.ranking import running_total, running_total_sliced, top_overall, top_per_group
from farebox.params import ReportWindow
from farebox.plans import hourly_profile, hourly_profile_arrow
from joinplans import strategy_labels
from pyspark.sql import functions as F


@pytest.mark.parametrize("count", [1, 3, 100])
def test_top_per_group_with_ties_nulls_and_large_k(spark, count):
    rng = random.Random(count)
    rows = [(rng.randint(1, 3), n, rng.choice([None, 1.0, 2.0, 3.0])) for n in range(60)]
    df = spark.createDataFrame(rows, "g int, id int, v double").repartition(5)
    got = top_per_group(df, ["g"], [F.col("v").desc_nulls_last(), F.col("id")], count, rank="place")
    want = []
    for g in (1, 2, 3):
        members = sorted((r for r in rows if r[0] == g), key=lambda r: (r[2] is None, -(r[2] or 0), r[1]))
        want += [(*r, place) for place, r in enumerate(members[:count], 1)]
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_top_overall_and_first_rows(spark):
    df = spark.createDataFrame([(n, n % 4) for n in range(20)], "id int, v int").repartition(3)
    assert [r.id for r in top_overall(df, [F.col("v").desc(), F.col("id")], 3).collect()] == [3, 7, 11]
    assert sorted(r.id for r in first_rows(df, "id", 5).collect()) == [0, 1, 2, 3, 4]
    assert first_rows(df, "id", 50).count() == 20


def test_histogram_edges_and_overflow(spark):
    outside = [None, float("nan"), float("inf"), float("-inf"), -1e300, -500_000.0, -3.0, -1e-9]
    values = [0.0, 0.4999, 0.5, 0.9999, 499.9, 500.0, 777.0, 20000.0, 1e300, -0.0, *outside]
    df = spark.createDataFrame([(1, v) for v in values] + [(2, v) for v in outside], "k int, v double")
    bins = {(r.k, r.bin): r.rows for r in histogram(df, ["k"], "v").collect()}
    assert bins == {(1, 0): 3, (1, 1): 2, (1, 999): 1, (1, 1000): 4}
    row = histogram_percentile(histogram(df, ["k"], "v"), ["k"]).first()
    assert (row.rows, row.percentile) == (10, 500.0)


@pytest.mark.parametrize("seed", range(4))
def test_histogram_percentile(spark, seed):
    rng = random.Random(seed)
    rows = [(rng.randint(0, 3), rng.expovariate(1 / 40)) for _ in range(300)]
    df = spark.createDataFrame(rows, "k int, v double").repartition(4)
    got = {r.k: (r.rows, r.percentile) for r in histogram_percentile(histogram(df, ["k"], "v"), ["k"]).collect()}
    groups = defaultdict(list)
    for key, value in rows:
        groups[key].append(value)
    for key, members in groups.items():
        nth = sorted(members)[math.ceil(0.9 * len(members)) - 1]
        assert got[key] == (len(members), min(math.floor(nth / 0.5), 1000) * 0.5)


@pytest.mark.parametrize("parts", [1, 40])
def test_percentile_is_a_value_of_nearly_the_right_rank(spark, parts):
    """Nearly all rows are in one group; many tasks share the salts."""
    n = 60_000
    key, value = F.when(F.col("id") % 100 == 0, 1).otherwise(0).alias("k"), (F.col("id") * 7919 % n).cast("double").alias("v")
    df = spark.range(0, n, 1, parts).select(key, value)
    counted = percentile_by(df, ["k"], "v", "p", n=(F.count("v"), F.sum("n")))
    for row in counted.collect():
        values = sorted(i * 7919 % n for i in range(n) if (i % 100 == 0) == row.k)
        off = abs(values.index(row.p) + 1 - math.ceil(0.9 * len(values)))
        assert row.n == len(values) and off <= (0 if len(values) < 8192 else 0.001 * len(values))


def test_percentile_of_groups_without_values(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, 5.0), (2, None), (None, 7.0)], "k int, v double")
    assert {r.k: r.p for r in percentile_by(df, ["k"], "v", "p").collect()} == {1: None, 2: 5.0, None: 7.0}


@pytest.mark.parametrize("most", [1_000_000, 40])
@pytest.mark.parametrize("fraction", [0.0, 0.5, 0.9, 1.0])
def test_percentile_by_is_exact(spark, monkeypatch, most, fraction):
    """more rows a group than a sketch holds; 40: brackets are narrowed again and again."""
    monkeypatch.setattr("farebox.operators.aggregates.WINDOW_ROWS", most)
    rng = random.Random(11)
    rows = [("big", rng.gauss(0, 100)) for _ in range(30_000)] + [("ties", float(rng.randrange(5))) for _ in range(20_000)]
    rows += [("one", 4.5), ("none", None), ("none", float("nan")), (None, 1.0), (None, float("inf"))]
    df = spark.createDataFrame(rows, "k string, v double").repartition(6)
    found = {r.k: r for r in percentile_by(df, ["k"], "v", "p", fraction, n=(F.count(F.lit(1)), F.sum("n"))).collect()}
    assert found["none"].p is None and len(found) == 5
    for key, row in found.items():
        values = sorted(v for k, v in rows if k == key) if key != "none" else [None, None]
        assert row.n == len(values), key
        assert key == "none" or row.p == values[max(math.ceil(len(values) * fraction), 1) - 1], key


def test_percentile_by_of_many_groups_and_of_none(spark, monkeypatch):
    """Brackets of many groups stay off the driver; without keys all rows are one group."""
    df = spark.range(20_000).select((F.col("id") % 50).alias("k"), (F.col("id") * 7919 % 20_000).cast("double").alias("v"))
    (row,) = percentile_by(df, [], "v", "p").collect()
    assert row.p == 17_999.0 and percentile_by(df.limit(0), ["k"], "v", "p").count() == 0
    monkeypatch.setattr("farebox.operators.aggregates.FEW_GROUPS", 5)
    values = {k: sorted(n * 7919 % 20_000 for n in range(k, 20_000, 50)) for k in range(50)}
    assert {r.k: r.p for r in percentile_by(df, ["k"], "v", "p").collect()} == {k: v[359] for k, v in values.items()}


def test_hourly_profile_of_large_hours_is_exact(spark):
    """every trip of an hour has a distance of its own, and there are more than a sketch holds."""
    at = F.lit("2024-01-01 01:00:00").cast("timestamp_ntz")
    trips = spark.range(0, 400_000, 1, 4).select(
        at.alias("pickup_datetime"), F.timestamp_add("SECOND", F.lit(60), at).alias("dropoff_datetime"),
        F.lit(40.5).alias("pickup_latitude"), F.lit(-74.0).alias("pickup_longitude"),
        (40.5 + (F.col("id") * 7919 % 400_000) / 800_000).alias("dropoff_latitude"), F.lit(-74.0).alias("dropoff_longitude"),
    )
    right = 6371.0 * math.radians(359_999 / 800_000)
    for profile in (hourly_profile, hourly_profile_arrow):
        (row,) = profile(trips, ReportWindow.from_id(600)).collect()
        assert row.Trips == 400_000 and row.AvgDurationMin == 1.0 and abs(row.P90HaversineKm - right) < 1e-6


def test_running_total(spark):
    df = spark.createDataFrame([("a", 2, 5), ("a", 1, 3), ("b", 9, 7)], "k string, at int, n int")
    got = running_total(df, ["k"], "at", "n", "reached", total="in_all").collect()
    assert sorted(map(tuple, got)) == [("a", 1, 3, 3, 8), ("a", 2, 5, 8, 8), ("b", 9, 7, 7, 7)]


def test_shares_ratios_and_sums(spark):
    rows = [("a", 1, 2.0, 10.0), ("a", 2, 9.0, 10.0), ("a", None, 1.0, None), ("a", 1, 5.0, 0.0), ("b", 2, None, 4.0)]
    got = (
        spark.createDataFrame(rows, "k string, pay int, tip double, fare double")
        .groupBy("k")
        .agg(
            share(F.col("pay") == 1).alias("share"),
            mean_ratio(F.col("tip"), F.col("fare"), F.col("pay") == 1).alias("rate"),
            sum_or_zero(F.col("fare")).alias("fares"),
            sum_or_zero(F.col("fare"), F.col("tip")).alias("both"),
        )
        .orderBy("k")
    )
    assert [tuple(r) for r in got.collect()] == [("a", 0.5, 0.2, 20.0, 37.0), ("b", 0.0, None, 4.0, 4.0)]
    assert dict(got.dtypes)["share"] == "double"


def test_guarded_ratio_never_raises(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 0.0), (1.0, -2.0), (1.0, None)], "a double, b double")
    assert [r[0] for r in df.select(ratio(F.col("a"), F.col("b"))).collect()] == [0.5, None, None, None]


@pytest.mark.parametrize(("p", "d", "expected"), [(6, 3, 2.0), (3, 6, 2.0), (5, 0, 5.0), (0, 1, 1.0), (4, 4, 1.0)])
def test_imbalance(spark, p, d, expected):
    df = spark.createDataFrame([(p, d)], "p bigint, d bigint")
    assert df.select(imbalance(F.col("p"), F.col("d"))).first()[0] == expected


def test_min_avg_max_text(spark):
    df = spark.createDataFrame([("q", 48.07575), ("r", 1.0), ("r", 2.0), ("s", None), ("t", -0.00005)], "k string, v double")
    got = {r.k: (r.min_s, r.avg_s, r.max_s, r.stats) for r in min_avg_max(df, ["k"], "v").collect()}
    half = math.floor(48.07575 * 10000 + 0.5) / 10000
    assert got["q"][3] == f"min={half:.4f}s avg={half:.4f}s max={half:.4f}s"
    assert got["r"] == (1.0, 1.5, 2.0, "min=1.0000s avg=1.5000s max=2.0000s")
    assert got["s"] == (None, None, None, None)


def test_first_run_mean(spark):
    rows = [("a", 1, 2.0), ("a", 1, 4.0), ("a", 2, 90.0), ("b", 2, 1.0), ("c", 1, None)]
    df = spark.createDataFrame(rows, "label string, run int, s double")
    assert sorted(map(tuple, first_run_mean(df, "label", "s", "run").collect())) == [("a", 3.0, 2), ("c", None, 1)]


def test_distance_forms_agree_and_survive_extremes(spark):
    rng = random.Random(5)
    rows = [tuple(rng.uniform(-b, b) for b in (90, 180, 90, 180)) for _ in range(200)]
    rows += [(0.0, 0.0, 0.0, 180.0), (90.0, 0.0, -90.0, 0.0), (1.5, 2.5, 1.5, 2.5), (None, 1.0, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    points = [F.col(name) for name in "abcd"]
    got = df.select(great_circle_km(*points).alias("km"), great_circle_km_arrow(*points).alias("arrow")).collect()
    for (a, b, c, d), row in zip(rows, got):
        if a is None:
            assert row.km is None and row.arrow is None
            continue
        x = [math.cos(math.radians(p)) * math.cos(math.radians(q)) for p, q in ((a, b), (c, d))]
        y = [math.cos(math.radians(p)) * math.sin(math.radians(q)) for p, q in ((a, b), (c, d))]
        z = [math.sin(math.radians(p)) for p in (a, c)]
        chord = math.dist((x[0], y[0], z[0]), (x[1], y[1], z[1]))
        assert row.km == pytest.approx(2 * 6371.0 * math.asin(min(1.0, chord / 2)), abs=1e-3)
        assert row.arrow == pytest.approx(row.km, abs=1e-6)


@pytest.mark.parametrize(
    ("lat", "lon", "valid"),
    [
        (40.0, -74.0, True),
        (-90.0, 180.0, True),
        (0.0, 10.0, False),
        (10.0, 0.0, False),
        (90.1, 10.0, False),
        (10.0, -180.5, False),
        (None, 10.0, False),
        (10.0, None, False),
        (float("nan"), 10.0, False),
    ],
)
def test_valid_point(spark, lat, lon, valid):
    df = spark.createDataFrame([(lat, lon)], "lat double, lon double")
    assert df.where(valid_point(F.col("lat"), F.col("lon"))).count() == int(valid)


def test_finite(spark):
    df = spark.createDataFrame([(1.0,), (None,), (float("nan"),), (float("inf"),), (float("-inf"),)], "v double")
    assert [r[0] for r in df.where(finite(F.col("v"))).collect()] == [1.0]


@pytest.mark.parametrize("day", [1, 25, 27, 28])
def test_span_filter_equals_date_membership(spark, day):
    window = ReportWindow(0, day, 10)
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    df = spark.range(0, 366 * 8).select(F.timestamp_add("HOUR", F.col("id").cast("int") * 3, start).alias("t"))
    spans = df.where(moment_in("t", window.date_spans))
    members = df.where(F.to_date("t").isin(window.dates))
    assert spans.count() == members.count() > 0
    assert spans.exceptAll(members).count() == 0


def test_defaults_fill_only_absent_columns(spark):
    df = spark.createDataFrame([(None,)], "total_amount double")
    out = with_revenue_defaults(df).first().asDict()
    assert len(out) == 8 and out.pop("total_amount") is None and set(out.values()) == {0.0}
    assert with_defaults(df, ["x"], 2.5).first().x == 2.5


def test_text_keys(spark):
    left, right = spark.createDataFrame([(1,)], "a int"), spark.createDataFrame([("1",)], "b string")
    cast_left, cast_right = text_keys(left, right, "a", "b")
    assert cast_left.dtypes == [("a", "string")] and cast_right.dtypes == [("b", "string")]
    assert cast_left.join(cast_right, F.col("a") == F.col("b")).count() == 1
    assert text_keys(left, right, "missing", "b")[0].dtypes == [("a", "int")]


FACT = [(n, None if n % 11 == 0 else n % 5) for n in range(60)]
DIM = [(0, "zero"), (1, "one"), (2, None), (9, "nine")]


def brute_force_left(keep_unmatched):
    names = dict(DIM)
    rows = [(n, k, names.get(k)) for n, k in FACT if keep_unmatched or k in names]
    return sorted(rows, key=repr)


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize(
    ("strategy", "salt_by", "label"),
    [
        ("auto", (), "BROADCAST"),
        ("broadcast", (), "BROADCAST"),
        ("merge", (), "MERGE"),
        ("merge", ("n",), "MERGE"),
        ("shuffle_hash", (), "SHUFFLE_HASH"),
        ("shuffle_hash", ("n",), "SHUFFLE_HASH"),
    ],
)
def test_join_strategies(spark, how, strategy, salt_by, label):
    fact = spark.createDataFrame(FACT, "n int, k int").repartition(3)
    dim = spark.createDataFrame(DIM, "k int, name string")
    joined = join_with_strategy(fact, dim, "k", how=how, strategy=strategy, salt_by=salt_by, salts=4)
    rows = joined.collect()
    assert joined.columns == ["n", "k", "name"]
    assert sorted(map(tuple, rows), key=repr) == brute_force_left(how == "left")
    if strategy != "auto":
        others = {"BROADCAST"} if salt_by else set()  # the small table of hot keys
        assert label in strategy_labels(joined) and set(strategy_labels(joined)) <= {label} | others


def test_broadcast_beyond_the_limit_is_an_error(spark, monkeypatch):
    fact = spark.createDataFrame(FACT, "n int, k int")
    dim = spark.createDataFrame(DIM, "k int, name string")
    size = measured_bytes(dim)
    assert 4 * 8 < size < 1000
    assert measured_bytes(dim.where("k > 100")) == 0
    monkeypatch.setattr("farebox.operators.joins.BROADCAST_LIMIT_BYTES", size - 1)
    with pytest.raises(ValueError, match=f"{size} bytes.*limit of {size - 1}"):
        join_with_strategy(fact, dim, "k", strategy="broadcast")


def test_every_type_is_measured(spark):
    wide = "k int, b binary, a array<string>, m map<string,binary>, s struct<x: string, y: array<int>>, d decimal(20,2)"
    rows = [(1, b"x" * 100_000, ["y" * 50] * 1000, {"z": b"w" * 10_000}, ("v" * 5000, [1, 2]), None), (2, *[None] * 5)]
    df = spark.createDataFrame(rows, wide)
    assert 165_000 < measured_bytes(df) < 200_000


def test_join_arguments_are_checked(spark):
    df = spark.createDataFrame([(1, 2)], "k int, v int")
    with pytest.raises(ValueError, match="strategy"):
        join_with_strategy(df, df, "k", strategy="cartesian")
    with pytest.raises(ValueError, match="join type"):
        join_with_strategy(df, df, "k", how="full")


def test_strategy_labels_of_joins_without_equal_keys(spark):
    """The vocabulary also names the two nested-loop operators, when some plan holds them."""
    a, b = spark.createDataFrame([(1,)], "x int"), spark.createDataFrame([(2,)], "y int")
    assert strategy_labels(a.join(F.broadcast(b), F.col("x") < F.col("y"))) == ["BROADCAST_NL"]
    assert strategy_labels(a.join(b.hint("shuffle_replicate_nl"), F.col("x") < F.col("y"))) == ["SHUFFLE_REPLICATE_NL"]
    assert strategy_labels(a) == []


def test_lookup_drops_rows_without_required_attributes(spark):
    fact = spark.createDataFrame(FACT, "n int, k int")
    dim = spark.createDataFrame(DIM, "k int, name string")
    assert lookup(fact, dim, "k").count() == len(FACT)
    assert lookup(fact, dim, "k", required=["name"]).count() == sum(1 for _, k in FACT if k in (0, 1))
    roles = in_role(dim, {"k": "origin", "name": "origin_name"})
    assert roles.columns == ["origin", "origin_name"]


def test_merge_all_never_matches_null_keys(spark):
    left = spark.createDataFrame([(1, "a", 5), (None, None, 6)], "k int, z string, p int")
    right = spark.createDataFrame([(1, "a", 7), (2, "b", 8), (None, None, 9)], "k int, z string, d int")
    got = sorted(map(tuple, merge_all(left, right, ["k", "z"]).collect()), key=repr)
    assert got == sorted([(1, "a", 5, 7), (2, "b", None, 8), (None, None, 6, None), (None, None, None, 9)], key=repr)


SKEWED = [(n, None if n % 3 == 0 else 7 if n % 3 == 1 else n) for n in range(600)]


def test_hot_keys_are_few_and_counted(spark):
    found = {r.k: (r.rows, r.parts) for r in hot_keys(spark.createDataFrame(SKEWED, "n int, k int"), ["k"]).collect()}
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = -(-200 * 2 * partitions // 600)
    assert found == {None: (200, parts), 7: (200, parts)}
    assert hot_keys(spark.createDataFrame([], "k int"), ["k"]).count() == 0


@pytest.mark.parametrize("required", [(), ("name",)])
def test_lookup_with_unmatched_keys_split_off(spark, required):
    """A third of the keys is NULL, a third is a key that the dimension lacks."""
    fact = spark.createDataFrame(SKEWED, "n int, k int")
    dim = spark.createDataFrame([(n, f"name{n}") for n in range(0, 600, 5)] + [(8, None)], "k int, name string")
    plain = sorted(map(tuple, lookup(fact, dim, "k", required).select("n", "k", "name").collect()), key=repr)
    split = lookup(fact, dim, "k", required, split_unmatched=True)
    assert sorted(split.columns) == ["k", "n", "name"]
    assert sorted(map(tuple, split.select("n", "k", "name").collect()), key=repr) == plain


def test_rows_that_match_nothing_meet_in_no_task(spark):
    """Without adaptive execution or a broadcast: the largest task has its even share of the rest."""
    fact = spark.createDataFrame(SKEWED, "n int, k int").repartition(8)
    dim = spark.createDataFrame([(n, f"name{n}") for n in range(0, 600, 5)], "k int, name string")
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        def largest(joined):
            return max(r["count"] for r in joined.groupBy(F.spark_partition_id().alias("task")).count().collect())

        assert largest(lookup(fact, dim, "k")) >= 200
        assert largest(lookup(fact, dim, "k", split_unmatched=True)) < 100
    finally:
        for key in settings:
            spark.conf.unset(key)


SIDES = {
    "hot on both": ([7] * 300 + list(range(40)), [7] * 90 + list(range(20, 60))),
    "hot on one": ([7] * 300 + [1, 2], [1, 3, None]),
    "hot on the other": ([1, None, None], [7] * 300 + [1, 1]),
    "NULL": ([None] * 200 + [1], [None] * 100 + [1, 2]),
    "empty": ([], [1, 2, 2]),
    "no hot key": (list(range(50)), list(range(25, 75))),
}


@pytest.mark.parametrize("name", list(SIDES))
def test_full_outer_merge_of_skewed_sides(spark, name):
    left, right = SIDES[name]
    a = spark.createDataFrame([(k, "z", n) for n, k in enumerate(left)], "k int, z string, p int").repartition(3)
    b = spark.createDataFrame([(k, "z", n) for n, k in enumerate(right)], "k int, z string, d int").repartition(2)
    merged, plain = merge_all_skewed(a, b, ["k", "z"]), merge_all(a, b, ["k", "z"])
    assert merged.columns == plain.columns
    assert sorted(map(tuple, merged.collect()), key=repr) == sorted(map(tuple, plain.collect()), key=repr)


def test_a_key_hot_on_both_sides_meets_in_many_tasks(spark):
    a = spark.range(400).select((F.col("id") * 0).alias("k"), F.col("id").alias("p"))
    b = spark.range(300).select((F.col("id") * 0).alias("k"), F.col("id").alias("d"))
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        tasks = merge_all_skewed(a, b, ["k"]).groupBy(F.spark_partition_id().alias("task")).count().collect()
        assert sum(r["count"] for r in tasks) == 400 * 300
        assert max(r["count"] for r in tasks) < 400 * 300 / 3
    finally:
        for key in settings:
            spark.conf.unset(key)


def test_the_grid_is_dealt_to_tasks_by_its_pairs(spark):
    """sides of few bytes, each in one task, with adaptive execution and broadcasts as they are by default."""
    a = spark.range(0, 400, 1, 1).select((F.col("id") * 0).alias("k"), F.col("id").alias("p"))
    b = spark.range(0, 300, 1, 1).select((F.col("id") * 0).alias("k"), F.col("id").alias("d"))
    tasks = merge_all_skewed(a, b, ["k"]).groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert sum(r["count"] for r in tasks) == 400 * 300
    assert max(r["count"] for r in tasks) < 400 * 300 / 3


@pytest.mark.parametrize("name", list(SIDES))
def test_full_outer_merge_of_folded_sides(spark, name):
    """each distinct row of the plain merge once, with how often it stands there."""
    left, right = SIDES[name]
    a = spark.createDataFrame([(k, n % 3 or None) for n, k in enumerate(left)], "k int, p int").repartition(3)
    b = spark.createDataFrame([(k, n % 2) for n, k in enumerate(right)], "k int, d int").repartition(2)
    folded, plain = merge_all_folded(a, b, ["k"]).collect(), merge_all(a, b, ["k"])
    counted = plain.groupBy("k", "p", "d").count().collect()
    totals = defaultdict(int)
    for row in folded:
        totals[row.k, row.p, row.d] += row.times
    assert totals == {(r.k, r.p, r.d): r["count"] for r in counted}
    assert len(folded) <= 3 * 2 * len({*left, *right})


def test_only_hot_keys_of_the_dimension_are_repeated(spark):
    """1,000 shuffle partitions and one hot key: the other rows of the dimension stay single."""
    fact = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")).alias("k"))
    dim = spark.range(2000).select(F.col("id").alias("k"), F.concat(F.lit("n"), "id").alias("name"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1000")
    try:
        joined = join_with_strategy(fact, dim, "k", strategy="merge", salt_by=["id"])
        parts = hot_keys(fact, ["k"]).collect()
        assert [(r.k, r.rows) for r in parts] == [(5, 1001)] and parts[0].parts <= 1000
        spark.conf.set("spark.sql.shuffle.partitions", before)
        rows = {r.id: (r.k, r.name) for r in joined.collect()}
        assert rows == {n: ((k := 5 if n % 3 == 0 else n), f"n{k}" if k < 2000 else None) for n in range(3000)}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def plain_running(rows):
    reached, out = defaultdict(int), []
    for g, t, n in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2])):
        reached[g] += n
        out.append((g, t, n, reached[g]))
    return sorted([(*r, reached[r[0]]) for r in out], key=repr)


@pytest.mark.parametrize("slices", [1, 2, 7, None])
def test_running_total_in_slices(spark, slices):
    rng = random.Random(7)
    rows = [(rng.choice(["a", "a", "b", None]), rng.choice([None, *range(40)]), rng.randint(1, 9) * 100 + n % 100) for n in range(400)]
    rows = list({(g, t, n): None for g, t, n in rows})
    df = spark.createDataFrame(rows, "g string, t int, n long").repartition(5)
    out = running_total_sliced(df, ["g"], "t", "n", "reached", total="in_all", slices=slices)
    assert sorted(map(tuple, out.select("g", "t", "n", "reached", "in_all").collect()), key=repr) == plain_running(rows)
    assert running_total_sliced(df.limit(0), ["g"], "t", "n", "reached").count() == 0


def test_running_total_of_one_group_is_spread(spark):
    df = spark.range(4000).select(F.lit(1).alias("g"), F.col("id").alias("t"))
    settings = {"spark.sql.adaptive.enabled": "false"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        out = running_total_sliced(df, ["g"], "t", "t", "reached", slices=16)
        tasks = out.groupBy(F.spark_partition_id().alias("task")).count().collect()
        assert sum(r["count"] for r in tasks) == 4000 and max(r["count"] for r in tasks) < 2000
    finally:
        for key in settings:
            spark.conf.unset(key)


@pytest.mark.parametrize("kind", ["date", "timestamp", "timestamp_ntz", "double", "decimal(20,3)"])
def test_running_total_along_other_types(spark, kind):
    df = spark.range(50).select(F.lit("a").alias("g"), "id", (F.lit("2024-01-01").cast("timestamp") + F.make_interval(days=F.col("id").cast("int"))).alias("m"))
    along = F.col("m").cast(kind) if kind.startswith(("date", "time")) else F.col("id").cast(kind)
    out = running_total_sliced(df.select("g", "id", along.alias("t")), ["g"], "t", "id", "reached", slices=5)
    assert {r.id: r.reached for r in out.collect()} == {n: n * (n + 1) // 2 for n in range(50)}
    with pytest.raises(ValueError, match="number, date or time"):
        running_total_sliced(df, ["g"], "g", "id", "reached")


@pytest.mark.parametrize("fraction", [0.0, 0.001, 0.5, 0.9, 1.0])
def test_exact_percentile_of_large_groups(spark, fraction):
    """More rows per group than a sketch holds; one group of a single value, one of NULL and NaN, and infinite values."""
    rng = random.Random(9)
    rows = [("big", rng.gauss(0, 100)) for _ in range(30_000)] + [("ties", float(rng.randrange(5))) for _ in range(20_000)]
    rows += [("one", 4.5), ("none", None), ("none", float("nan")), ("ends", float("-inf")), ("ends", 1.0), ("ends", float("inf"))]
    out = exact_percentile_by(spark.createDataFrame(rows, "k string, v double").repartition(6), ["k"], "v", "p", fraction)
    got = {r.k: r.p for r in out.collect()}
    for key in ("big", "ties", "one", "ends"):
        values = sorted(v for k, v in rows if k == key)
        assert got[key] == values[max(math.ceil(len(values) * fraction), 1) - 1], key
    assert got["none"] is None and len(got) == 5


def test_approximate_percentile_of_a_large_group_is_near(spark):
    rng = random.Random(10)
    values = sorted(rng.random() for _ in range(60_000))
    df = spark.createDataFrame([(1, v) for v in values], "k int, v double").repartition(8)
    (row,) = percentile_by(df, ["k"], "v", "p").collect()
    assert abs(sum(v <= row.p for v in values) / len(values) - 0.9) < 0.001


def test_a_costly_column_is_computed_once(spark):
    df = spark.range(10).select("id", F.sqrt(F.col("id") * 2.0 + 1).alias("v"))
    once = evaluated_once(df, "v")
    tested = once.where((F.col("v") > 1) & (F.col("v") < 4) & (F.col("v") != 2)).select("id", (F.col("v") * 2).alias("w"), "v")
    plan = tested._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("SQRT") == 1 and once.columns == ["id", "v"]
    assert tested.count() == sum(1 < math.sqrt(2 * n + 1) < 4 for n in range(10))
