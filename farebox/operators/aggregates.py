"""Aggregate columns, histograms and percentiles.

Everything here is made of built-in aggregates with a partial step before the
shuffle, so a group holding most of the rows costs one small record per task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from farebox.functions import finite, or_zero, ratio
from farebox.operators.projection import evaluated_once
from farebox.operators.ranking import running_total, running_total_sliced

# Distance histogram of the hourly report.
BIN_KM = 0.5
BIN_COUNT = 1000
TAIL_FRACTION = 0.9

# Size of the percentile sketches. A rank is off by at most about 0.05 % of the rows, and by nothing while a group has
# no more rows than this.
SKETCH_SIZE = 8192

# Part of the rows on either side of a percentile that an exact one is sought in: ten times the error of a sketch.
BRACKET = 0.005

# Values of a group that one task orders for its percentile, and groups whose brackets may come to the driver.
WINDOW_ROWS = 1_000_000
FEW_GROUPS = 10_000


def row_count() -> Column:
    return F.count(F.lit(1))


def percentile_by(
    df: DataFrame, keys: Sequence[str], value: str, name: str, fraction: float = TAIL_FRACTION, **extra: tuple[Column, Column]
) -> DataFrame:
    """Exact discrete percentile per key: the least value that at least ``fraction`` of the group's values do not exceed.

    NULL and NaN are left out; a group without any other value gives NULL. The
    groups may be of any size. Sketches bracket each group's percentile at once,
    before the result is asked for; the result is then one pass that counts the
    values inside the bracket, combined in the tasks, and orders them. Brackets
    of large groups are narrowed until ``WINDOW_ROWS`` values at most are
    ordered. They come to the driver, a row a group; those of more than
    ``FEW_GROUPS`` groups stay on the executors, as wide as the first sketch
    leaves them. Were a percentile outside its bracket, that would be an error,
    never a wrong value. ``extra`` gives for a further column the aggregate of
    the rows and the one that joins its parts, which are known by the column's
    name.
    """
    usable = df.withColumn("_v", F.nanvl(F.col(value).cast("double"), F.lit(None).cast("double")))
    told = _beside_brackets(usable, keys, _brackets(usable.select(*keys, "_v"), keys, fraction))
    side = F.when(F.col("_v") < F.col("_low"), -1).when(F.col("_v") > F.col("_high"), 1).when(F.col("_v").isNotNull(), 0)
    cells = told.withColumn("_side", side).groupBy(*keys, "_side", F.when(F.col("_side") == 0, F.col("_v")).alias("_cell")).agg(
        F.count("_v").alias("_rows"), *[rows.alias(column) for column, (rows, _) in extra.items()]
    )
    group = Window.partitionBy(*keys)
    upto = group.orderBy("_side", "_cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = cells.withColumn("_reached", F.sum("_rows").over(upto)).withColumn("_all", F.sum("_rows").over(group))
    rank = F.greatest(F.ceil(F.col("_all") * F.lit(fraction)), F.lit(1))
    sure = F.when(F.col("_side") != 0, F.raise_error(F.lit("a percentile lies outside its bracket")).cast("double")).otherwise(F.col("_cell"))
    holds = (F.col("_reached") >= rank) & (F.col("_reached") - F.col("_rows") < rank)
    return placed.groupBy(*keys).agg(
        *[joined.alias(column) for column, (_, joined) in extra.items()], F.max(F.when(holds, sure)).alias(name)
    )


def _beside_brackets(usable: DataFrame, keys: Sequence[str], brackets: DataFrame) -> DataFrame:
    """Every row with the bracket of its group."""
    named = brackets.select(*[F.col(key).alias(f"_of_{key}") for key in keys], "_low", "_high")
    same = reduce(and_, (F.col(key).eqNullSafe(F.col(f"_of_{key}")) for key in keys), F.lit(True))
    return usable.join(named, same, "left")


def _brackets(usable: DataFrame, keys: Sequence[str], fraction: float) -> DataFrame:
    """(keys, _low, _high): two values of each group that its percentile lies between."""
    spark = usable.sparkSession
    found = _narrowed(usable.withColumns({"_low": F.lit(float("-inf")), "_high": F.lit(float("inf"))}), keys, fraction)
    rows = found.limit(FEW_GROUPS + 1).collect()
    if len(rows) > FEW_GROUPS:
        return found
    while True:
        brackets = F.broadcast(spark.createDataFrame(rows, found.schema))
        left = max((row["_inside"] for row in rows), default=0) * 4 * BRACKET
        if left <= WINDOW_ROWS:
            return brackets
        before, rows = rows, _narrowed(_beside_brackets(usable, keys, brackets), keys, fraction).collect()
        if sum(row["_inside"] for row in rows) >= sum(row["_inside"] for row in before):
            return brackets  # nothing but ties is left


def _narrowed(told: DataFrame, keys: Sequence[str], fraction: float) -> DataFrame:
    """(keys, _inside, _low, _high): the values in each group's bracket, and a bracket inside it, from a sketch of these values.

    Sketches are merged on two levels, first those of the tasks that share a
    salt, then one for each salt, so no task merges the sketches of all tasks.
    The salt is that of the task, which thus sends one sketch per key.
    """
    salts = int(told.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = told.withColumn("_salt", F.spark_partition_id() % salts).groupBy(*keys, "_salt").agg(
        F.kll_sketch_agg_double(F.when(F.col("_v").between(F.col("_low"), F.col("_high")), F.col("_v")), F.lit(SKETCH_SIZE)).alias("_sketch"),
        F.count("_v").alias("_all"),
        F.count_if(F.col("_v") < F.col("_low")).alias("_below"),
    )
    merged = parts.groupBy(*keys).agg(
        F.kll_merge_agg_double("_sketch", F.lit(SKETCH_SIZE)).alias("_sketch"), F.sum("_all").alias("_all"), F.sum("_below").alias("_below")
    )
    inside = F.coalesce(F.kll_sketch_get_n_double("_sketch"), F.lit(0))
    # The function takes fixed places alone, so a group picks its edges from a list of them.
    steps = round(1 / BRACKET)
    values = F.kll_sketch_get_quantile_double("_sketch", F.array(*[F.lit(step / steps) for step in range(steps + 1)]))
    place = steps * (F.greatest(F.ceil(F.col("_all") * F.lit(fraction)), F.lit(1)) - F.col("_below")) / F.nullif(inside, F.lit(0))
    low, high = F.greatest(F.floor(place) - 1, F.lit(0)), F.least(F.ceil(place) + 1, F.lit(steps))
    known = merged.select(*keys, inside.alias("_inside"), F.when(inside > 0, values).alias("_values"), low.cast("int").alias("_l"), high.cast("int").alias("_h"))
    return known.select(*keys, "_inside", F.get("_values", F.col("_l")).alias("_low"), F.get("_values", F.col("_h")).alias("_high"))


def exact_percentile_by(df: DataFrame, keys: Sequence[str], value: str, name: str, fraction: float = TAIL_FRACTION) -> DataFrame:
    """Exact discrete percentile per key: the least value that at least ``fraction`` of the group's values do not exceed.

    NULL and NaN are left out; a group without any other value gives NULL. Two
    passes: a sketch brackets each group's percentile between two of its values,
    ``BRACKET`` of the rows to either side, ten times what the sketch may be off.
    The second pass counts the values inside the bracket, about 1 % of the rows,
    and how many lie below it, all combined in the tasks; the running total over
    them is spread over tasks too. Were a percentile outside its bracket, that
    would be an error, never a wrong value.
    """
    salts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    usable = df.select(*keys, F.nanvl(F.col(value).cast("double"), F.lit(None).cast("double")).alias("_v"))
    parts = usable.withColumn("_salt", F.spark_partition_id() % salts).groupBy(*keys, "_salt")
    sketches = parts.agg(F.kll_sketch_agg_double("_v", F.lit(SKETCH_SIZE)).alias("_sketch")).groupBy(*keys)
    merged = sketches.agg(F.kll_merge_agg_double("_sketch", F.lit(SKETCH_SIZE)).alias("_sketch"))
    count = F.kll_sketch_get_n_double("_sketch")

    def edge(shift: float) -> Column:
        place = min(max(fraction + shift, 0.0), 1.0)
        return F.when(count > 0, F.kll_sketch_get_quantile_double("_sketch", F.lit(place)))

    rank = F.greatest(F.ceil(count * F.lit(fraction)), F.lit(1))
    brackets = merged.select(*[F.col(k).alias(f"_of_{k}") for k in keys], rank.alias("_rank"), edge(-BRACKET).alias("_low"), edge(BRACKET).alias("_high"))
    same = reduce(and_, (F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys))
    beside = float("inf")
    cell = F.when(F.col("_v") < F.col("_low"), -beside).when(F.col("_v") > F.col("_high"), beside).otherwise(F.col("_v"))
    told = usable.join(brackets, same, "left").select(*keys, "_rank", cell.alias("_cell"), (F.col("_v") < F.col("_low")).alias("_below"), (F.col("_v") > F.col("_high")).alias("_above"))
    cells = told.groupBy(*keys, "_cell", "_below", "_above").agg(F.count("_cell").alias("_rows"), F.first("_rank").alias("_rank"))
    reached = running_total_sliced(cells, by=keys, along="_cell", value="_rows", name="_reached")
    outside = F.coalesce(F.col("_below") | F.col("_above"), F.lit(False))
    sure = F.when(outside, F.raise_error(F.lit("a percentile lies outside its bracket")).cast("double")).otherwise(F.col("_cell"))
    holds = (F.col("_reached") >= F.col("_rank")) & (F.col("_reached") - F.col("_rows") < F.col("_rank"))
    return reached.groupBy(*keys).agg(F.max(F.when(holds, sure)).alias(name))


def share(condition: Column) -> Column:
    """Part of the rows meeting the condition (unknown counts as not met), a double."""
    return F.avg(F.when(condition, 1.0).otherwise(0.0))


def mean_ratio(part: Column, whole: Column, condition: Column) -> Column:
    """Mean of part / whole over rows meeting the condition with whole above zero."""
    return F.avg(F.when(condition, ratio(part, whole)))


def sum_or_zero(*values: Column) -> Column:
    """Sum of the values of all rows, NULL as zero."""
    return F.sum(sum((or_zero(value) for value in values[1:]), or_zero(values[0])))


def imbalance(one: Column, other: Column) -> Column:
    """How many times the larger count exceeds the smaller; a zero counts as one."""
    larger = F.greatest(one, other).cast("double")
    smaller = F.greatest(F.least(one, other), F.lit(1)).cast("double")
    return larger / smaller


def histogram(
    df: DataFrame, keys: Sequence[str], value: str, width: float = BIN_KM, bins: int = BIN_COUNT, **extra: Column
) -> DataFrame:
    """Rows per key and bin; the last bin holds all that lies beyond. Only finite values from zero on are counted.

    At most ``bins + 1`` rows per key leave any task. ``extra`` aggregates over the counted rows ride along in the same
    pass. The value is computed once a row, then tested and binned.
    """
    known = evaluated_once(df, value)
    inside = known.where((F.col(value) >= 0) & finite(F.col(value)))
    bin_index = F.floor(F.least(F.col(value) / width, F.lit(float(bins)))).cast("int").alias("bin")
    return inside.groupBy(*keys, bin_index).agg(
        row_count().alias("rows"), *[column.alias(name) for name, column in extra.items()]
    )


def histogram_percentile(
    counted: DataFrame, keys: Sequence[str], fraction: float = TAIL_FRACTION, width: float = BIN_KM, **extra: Column
) -> DataFrame:
    """Lower edge of the first bin whose running count reaches the fraction.

    Takes the output of ``histogram``; the window sees bins, never rows.
    """
    running = running_total(counted, by=keys, along="bin", value="rows", name="reached", total="in_all")
    edge = F.min(F.when(F.col("reached") >= F.ceil(F.col("in_all") * fraction), F.col("bin"))) * F.lit(width)
    return running.groupBy(*keys).agg(
        F.sum("rows").alias("rows"), edge.alias("percentile"), *[c.alias(n) for n, c in extra.items()]
    )


def _four_digits(value: Column) -> Column:
    """Rounded in plain double arithmetic, which any engine repeats exactly."""
    return F.floor(value * 10000 + 0.5) / 10000


def min_avg_max(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Spread of a measure in seconds per key, with a text form; NULL for a key without values."""
    spread = df.groupBy(*keys).agg(
        F.min(value).alias("min_s"), F.avg(value).alias("avg_s"), F.max(value).alias("max_s")
    )
    # Fixed value: text form of the spread.
    text = F.format_string("min=%.4fs avg=%.4fs max=%.4fs", *[_four_digits(F.col(c)) for c in ("min_s", "avg_s", "max_s")])
    return spread.withColumn("stats", F.when(F.col("min_s").isNotNull(), text))


def first_run_mean(df: DataFrame, label: str, value: str, run: str, first: int = 1) -> DataFrame:
    """Mean of a measure and number of records per label, over the records of the first run."""
    return df.where(F.col(run) == first).groupBy(label).agg(F.avg(value).alias("avg_s"), row_count().alias("runs"))
