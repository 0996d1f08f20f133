"""Columns added to, or normalised in, a trip table."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farebox.functions import hour_label, whole_seconds

# Amounts the revenue report may find missing in a raw table.
REVENUE_COLUMNS = (
    "fare_amount",
    "tip_amount",
    "tolls_amount",
    "extra",
    "mta_tax",
    "congestion_surcharge",
    "airport_fee",
    "total_amount",
)

# Key in the metadata of a column that follows from others.
DERIVED = "farebox_derived"


def with_defaults(df: DataFrame, names: Iterable[str], value: float = 0.0) -> DataFrame:
    """Adds the named double columns that the table lacks; existing ones stay."""
    present = set(df.columns)
    return df.withColumns({name: F.lit(value).cast("double") for name in names if name not in present})


def with_revenue_defaults(df: DataFrame) -> DataFrame:
    return with_defaults(df, REVENUE_COLUMNS)


def with_duration(
    df: DataFrame, start: str = "pickup_datetime", end: str = "dropoff_datetime", name: str = "duration_seconds"
) -> DataFrame:
    return df.withColumn(name, whole_seconds(F.col(start), F.col(end)))


def with_hour_label(df: DataFrame, hour: str = "hour_of_day", name: str = "hour_str") -> DataFrame:
    return df.withColumn(name, hour_label(F.col(hour)))


def with_pickup_date(df: DataFrame) -> DataFrame:
    """Adds ``pickup_date`` (a date) unless the table carries one."""
    if "pickup_date" in df.columns:
        return df
    day = F.to_date("pickup_datetime").alias("pickup_date", metadata={DERIVED: True})
    return df.select("*", day)


def evaluated_once(df: DataFrame, *names: str) -> DataFrame:
    """The same rows and columns; the named ones are computed here, once a row, whatever is built on them.

    They pass through a one-row array. Catalyst pushes no filter on them below it and copies their expressions into none,
    as it otherwise does for every place that uses a column. For what is costly to compute and tested often.
    """
    others = [F.col(f"`{name}`") for name in df.columns if name not in names]
    settled = df.select(*others, F.inline(F.array(F.struct(*[F.col(f"`{name}`") for name in names]))))
    return settled.select(*[F.col(f"`{field.name}`").alias(field.name, metadata=field.metadata) for field in df.schema.fields])


def is_derived(df: DataFrame, name: str) -> bool:
    """Whether a column was added by this library rather than read."""
    return bool(df.schema[name].metadata.get(DERIVED))


def in_role(dimension: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """The dimension under the names of one role: old name -> new name.

    Only the listed columns survive, which keeps the joined side narrow.
    """
    return dimension.select(*[F.col(old).alias(new) for old, new in columns.items()])


def text_keys(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> tuple[DataFrame, DataFrame]:
    """Both sides with their join key as text, for keys stored in unlike types."""

    def as_text(df: DataFrame, key: str) -> DataFrame:
        return df.withColumn(key, F.col(key).cast("string")) if key in df.columns else df

    return as_text(left, left_key), as_text(right, right_key)
