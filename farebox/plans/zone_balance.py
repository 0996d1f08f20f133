"""Q5: the K zones where pickups and dropoffs are furthest apart."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farebox.operators.aggregates import imbalance
from farebox.operators.filters import in_report_window
from farebox.operators.joins import join_with_strategy
from farebox.operators.ranking import top_overall
from farebox.params import ReportWindow


def visits_per_zone(trips: DataFrame) -> DataFrame:
    """Pickups and dropoffs per zone id from one scan.

    Each trip becomes two visits, which the partial aggregate folds to one row
    per zone id and task before the only shuffle; counting the roles apart would
    scan the trips twice and need a full outer join.
    """

    def visit(column: str, is_pickup: int) -> F.Column:
        return F.struct(F.col(column).alias("location_id"), F.lit(is_pickup).alias("is_pickup"))

    visits = trips.select(F.inline(F.array(visit("pu_location_id", 1), visit("do_location_id", 0))))
    return (
        visits.where(F.col("location_id").isNotNull())
        .groupBy("location_id")
        .agg(
            F.sum("is_pickup").alias("pickups"),
            F.sum(1 - F.col("is_pickup")).alias("dropoffs"),
        )
    )


def zone_balance(
    trips: DataFrame, zones: DataFrame, window: ReportWindow, limit: int | None = None, strategy: str = "auto"
) -> DataFrame:
    """``limit`` replaces K; ``strategy`` says how the zones are joined."""
    visits = visits_per_zone(trips.where(in_report_window(trips, window)))
    named = join_with_strategy(
        visits,
        zones.select("location_id", "borough", "zone").where(F.col("borough").isNotNull() & F.col("zone").isNotNull()),
        key="location_id",
        how="inner",
        strategy=strategy,
    )
    scored = named.select(
        "borough", "zone", "pickups", "dropoffs", imbalance(F.col("pickups"), F.col("dropoffs")).alias("imbalance")
    )
    order = [F.col("imbalance").desc(), "borough", "zone"]
    return top_overall(scored, order, window.top_k if limit is None else limit)
