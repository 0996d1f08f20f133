"""Top-K per group, top-K overall and running totals."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def top_per_group(
    df: DataFrame, by: Sequence[str], order: Sequence[Column], count: int, rank: str | None = None
) -> DataFrame:
    """The first ``count`` rows of each group.

    Spark cuts every map partition to ``count`` rows per group before the
    shuffle (WindowGroupLimit), so a hot group stays small. ``order`` should end
    in a tie-breaker.
    """
    position = rank or "_position"
    window = Window.partitionBy(*by).orderBy(*order)
    kept = df.withColumn(position, F.row_number().over(window)).where(F.col(position) <= count)
    return kept if rank else kept.drop(position)


def top_overall(df: DataFrame, order: Sequence[Column], count: int) -> DataFrame:
    """The first ``count`` rows of all; each task keeps ``count`` (TakeOrderedAndProject)."""
    return df.orderBy(*order).limit(count)


def in_order(df: DataFrame, *order: str | Column) -> DataFrame:
    """A result with a fixed small number of rows (one per hour of day) in global order.

    One partition is ordered by a plain sort. The range shuffle of an ``orderBy``,
    right for any result that may grow, first samples its input and so finishes
    the aggregates below it twice, which is costly for percentile sketches.
    """
    return df.repartition(1).orderBy(*order)


def running_total(
    df: DataFrame, by: Sequence[str], along: str, value: str, name: str, total: str | None = None
) -> DataFrame:
    """Running sum inside each group, and the group's total if asked.

    The groups must be bounded (histogram bins, dates): a window holds a whole
    group in one task. ``running_total_sliced`` is for groups that are not.
    """
    group = Window.partitionBy(*by)
    upto = group.orderBy(along).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = df.withColumn(name, F.sum(value).over(upto))
    return out.withColumn(total, F.sum(value).over(group)) if total else out


def running_total_sliced(
    df: DataFrame, by: Sequence[str], along: str, value: str, name: str, total: str | None = None, slices: int | None = None
) -> DataFrame:
    """``running_total`` for groups of any size: a prefix sum over slices of ``along``, a number, a date or a time.

    Measured quantiles of ``along`` cut all rows into ``slices`` stretches (one
    per shuffle partition unless told otherwise), so a group that holds every
    row is spread over as many tasks. A window runs inside each stretch of a
    group; stretch totals, at most ``slices`` a group, are summed up before and
    added. Rows of one group with equal ``along`` share a stretch and are
    ordered by their other columns. NULL comes first, as in an ascending sort.
    """
    slices = slices or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    position = _as_number(df, along)
    places = [k / slices for k in range(1, slices)]
    cuts = sorted(set(df.select(position.alias("_at")).approxQuantile("_at", places, 1 / (4 * slices)))) if places else []
    edges = F.array(*[F.lit(cut) for cut in cuts]) if cuts else F.array().cast("array<double>")
    at = F.size(F.filter(edges, lambda cut: cut <= F.col("_at")))
    stretch = F.when(F.col("_at").isNull(), -1).otherwise(at).alias("_stretch")
    cut = df.select("*", position.alias("_at")).select(*df.columns, stretch)

    group = Window.partitionBy(*by, "_stretch")
    ties = [F.col(column) for column in df.columns if column not in (*by, along)]
    inside = group.orderBy(F.col(along), *ties).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = cut.groupBy(*by, "_stretch").agg(F.sum(value).alias("_sum"))
    stretches = Window.partitionBy(*by)
    earlier = stretches.orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    offsets = summed.select(*by, "_stretch", F.sum("_sum").over(earlier).alias("_before"), F.sum("_sum").over(stretches).alias("_all"))

    own = cut.withColumn("_own", F.sum(value).over(inside))
    keys = {column: f"_key_{column}" for column in (*by, "_stretch")}
    offsets = offsets.select(*[F.col(column).alias(alias) for column, alias in keys.items()], "_before", "_all")
    same = reduce(and_, (own[column].eqNullSafe(offsets[alias]) for column, alias in keys.items()))
    joined = own.join(offsets, same, "left")
    reached = F.when(F.col("_before").isNull(), F.col("_own")).otherwise(F.col("_before") + F.coalesce("_own", F.lit(0)))
    extra = [F.col("_all").alias(total)] if total else []
    return joined.select(*df.columns, reached.alias(name), *extra)


def _as_number(df: DataFrame, name: str) -> Column:
    """Position of a number, date or time on one axis; its order, but for ties of very close values, is that of the column."""
    kind = df.schema[name].dataType
    column = F.col(name)
    if isinstance(kind, T.TimestampNTZType):
        column = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), column)
    elif isinstance(kind, T.TimestampType):
        column = F.unix_micros(column)
    elif isinstance(kind, T.DateType):
        column = F.unix_date(column)
    elif not isinstance(kind, T.NumericType):
        raise ValueError(f"a running total needs a number, date or time to run along, not {kind.simpleString()}")
    return column.cast("double")
