"""Dimension lookups, full outer merges and joins with a chosen strategy.

A strategy is a hint on one DataFrame. Session settings are never touched, so
other queries of the session keep their plans.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farebox.operators.filters import present

STRATEGIES = ("auto", "broadcast", "merge", "shuffle_hash")

# Largest side that may be sent whole to every executor.
BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024


def lookup(
    fact: DataFrame, dimension: DataFrame, key: str, required: Sequence[str] = (), split_unmatched: bool = False
) -> DataFrame:
    """Left lookup of dimension attributes.

    Rows whose ``required`` attributes stay NULL are dropped, and Catalyst then
    plans the lookup as an inner join. Without hints the size check is
    Catalyst's own: broadcast below its threshold, shuffled beyond it.

    ``split_unmatched`` is for facts whose keys are often NULL or unknown to a
    dimension too large to broadcast. Such rows, which would all meet in the
    task of their key, go to no shuffle: NULL keys and frequent keys that the
    dimension lacks are split off before, and come back with NULL attributes.
    """
    if split_unmatched:
        return _lookup_of_known(fact, dimension, key, required)
    joined = fact.join(dimension, on=key, how="left")
    return joined.where(present(*required)) if required else joined


def _lookup_of_known(fact: DataFrame, dimension: DataFrame, key: str, required: Sequence[str]) -> DataFrame:
    hot = hot_keys(fact.where(present(key)), [key])
    # At most two frequent keys a partition, so the table of those that match nothing is bounded, and so is its broadcast.
    lost = hot.join(dimension.select(key), on=key, how="left_anti").select(F.col(key).alias("_lost"))
    marked = fact.join(F.broadcast(lost), fact[key] == F.col("_lost"), "left")
    apart = F.col(key).isNull() | F.col("_lost").isNotNull()
    joined = marked.where(~apart).drop("_lost").join(dimension, on=key, how="left")
    if required:
        return joined.where(present(*required))
    return joined.unionByName(marked.where(apart).drop("_lost"), allowMissingColumns=True)


def hot_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, rows, parts): the keys with more rows than half a partition's even share, and the parts to cut them into.

    They are found at once, by jobs that read the keys alone and count them in
    the tasks before they shuffle. At most two keys a shuffle partition can be
    hot, so the result is a small local table, whatever the size of ``df``.
    """
    spark = df.sparkSession
    most = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    narrow = df.select(*keys)
    even = max(narrow.count() / most, 1.0)
    counted = narrow.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > even)
    hot = counted.withColumn("parts", F.ceil(F.col("rows") / even).cast("int"))
    return spark.createDataFrame(hot.orderBy(F.desc("rows")).limit(most).collect(), hot.schema)


def merge_all(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full outer join on ``keys``; NULL keys never match.

    Meant for sides aggregated to one row per key: a full outer join cannot be
    split on a hot key. ``merge_all_skewed`` is for raw sides.
    """
    return left.join(right, on=list(keys), how="full_outer")


def merge_all_skewed(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full outer join of sides that may hold hot or NULL keys.

    For a key on both sides a full outer join is an inner join; for a key on
    one side it is that side's rows. So keys that are hot on either side leave
    the outer join: those on both sides are joined on a grid, the left rows cut
    into parts that are repeated for each part of the right ones and the other
    way round; those on one side, and NULL keys, are passed on without a shuffle.
    The grid is dealt to all shuffle partitions: its sides have few bytes and
    many pairs, so neither a broadcast nor merged partitions may gather them.
    """
    keys = list(keys)
    hot = _hot_on_either(left, right, keys)
    sides = {}
    for name, df, across in (("left", left, "right"), ("right", right, "left")):
        tagged = df.join(F.broadcast(hot), on=keys, how="left")
        whole = present(*keys)
        alone = ~whole | (F.col(f"_{across}_parts") == 0)
        sides[name] = {
            "cold": tagged.where(whole & F.col("_left_parts").isNull()).select(*df.columns),
            "alone": tagged.where(alone).select(*df.columns),
            "grid": _on_grid(tagged.where(whole & (F.col("_left_parts") > 0) & (F.col("_right_parts") > 0)), df.columns, keys, name, across),
        }
    cold = sides["left"]["cold"].join(sides["right"]["cold"], on=keys, how="full_outer")
    met = sides["left"]["grid"].join(sides["right"]["grid"], on=[*keys, "_left", "_right"]).drop("_left", "_right")
    merged = cold.unionByName(met)
    for name in ("left", "right"):
        merged = merged.unionByName(sides[name]["alone"], allowMissingColumns=True)
    return merged


def merge_all_folded(left: DataFrame, right: DataFrame, keys: Sequence[str], times: str = "times") -> DataFrame:
    """Full outer join of raw sides with equal rows folded: each distinct row once, and in ``times`` how often it stands there.

    A key with many rows on both sides has as many rows in a full outer join as
    the product of the two. An aggregate over them needs only the columns that
    it reads: a side cut to these folds to few rows, in the tasks that read it,
    and aggregates weighted by ``times`` give what the raw rows would. NULL keys
    and keys of one side are as in ``merge_all_skewed``, which joins the folded
    sides. Columns of maps, which cannot be grouped, are not supported.
    """
    def folded(df: DataFrame, count: str) -> DataFrame:
        return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias(count))

    merged = merge_all_skewed(folded(left, "_left_times"), folded(right, "_right_times"), keys)
    product = F.coalesce("_left_times", F.lit(1)) * F.coalesce("_right_times", F.lit(1))
    return merged.withColumn(times, product).drop("_left_times", "_right_times")


def _hot_on_either(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, _left_parts, _right_parts) of keys hot on a side; 0 parts where a side lacks the key."""
    found = []
    for own, other, side, across in ((left, right, "left", "right"), (right, left, "right", "left")):
        hot = hot_keys(own.where(present(*keys)), keys).select(*keys, F.col("parts").alias(f"_{side}_parts"))
        counted = other.join(F.broadcast(hot.select(*keys)), on=keys, how="left_semi").groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
        both = hot.join(F.broadcast(counted), on=keys, how="left")
        found.append(both.select(*keys, f"_{side}_parts", F.when(F.col("_n") > 0, 1).otherwise(0).alias(f"_{across}_parts")))
    either = found[0].unionByName(found[1])
    return either.groupBy(*keys).agg(*[F.max(f"_{side}_parts").alias(f"_{side}_parts") for side in ("left", "right")])


def _on_grid(df: DataFrame, columns: Sequence[str], keys: list[str], side: str, across: str) -> DataFrame:
    """A side's own part by a hash of the row, and a copy for each part of the other side."""
    others = [name for name in columns if name not in keys and not has_map(df.schema[name].dataType)]
    own = F.pmod(F.xxhash64(*others) if others else F.lit(0).cast("long"), F.col(f"_{side}_parts")).cast("int")
    copies = F.explode(F.sequence(F.lit(0), F.col(f"_{across}_parts") - 1))
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.select(*columns, own.alias(f"_{side}"), copies.alias(f"_{across}")).repartition(partitions, *keys, "_left", "_right")


def has_map(kind: T.DataType) -> bool:
    """Whether a value holds a map, which has no hash."""
    inner = [field.dataType for field in kind.fields] if isinstance(kind, T.StructType) else [kind.elementType] if isinstance(kind, T.ArrayType) else []
    return isinstance(kind, T.MapType | T.VariantType) or any(map(has_map, inner))


def first_rows(dimension: DataFrame, key: str, count: int) -> DataFrame:
    return dimension.orderBy(key).limit(count)


def _width(field: T.StructField) -> Column:
    """Bytes of one value: its own length for text and binary, that of its JSON form for nested values."""
    value = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.StringType | T.BinaryType):
        length = F.octet_length(value)
    elif isinstance(field.dataType, T.ArrayType | T.MapType | T.StructType | T.VariantType):
        length = F.octet_length(F.to_json(F.struct(value)))
    else:
        length = F.lit(16)
    return F.coalesce(length, F.lit(0)).cast("long")


def row_bytes(df: DataFrame) -> Column:
    """Estimated bytes of a row in memory."""
    row_overhead = 32
    return sum((_width(field) for field in df.schema.fields), F.lit(row_overhead).cast("long"))


def measured_bytes(df: DataFrame) -> int:
    """Estimated in-memory size of a table, summed on the executors in one job."""
    return df.agg(F.coalesce(F.sum(row_bytes(df)), F.lit(0)).alias("bytes")).first()["bytes"]


def join_with_strategy(
    left: DataFrame,
    right: DataFrame,
    key: str,
    how: str = "left",
    strategy: str = "auto",
    salt_by: Sequence[str] = (),
    salts: int | None = None,
) -> DataFrame:
    """Equi-join (inner or left) by the chosen strategy.

    ``broadcast`` measures the right side first and raises beyond
    ``BROADCAST_LIMIT_BYTES``; the caller then chooses another strategy. The
    shuffled strategies spread hot keys when ``salt_by`` names left columns to
    derive the salt from: a count of the left keys tells which are hot and into
    how many parts each is cut (``salts`` at most), and the right side is
    repeated for those alone, once a part. NULL keys, which match nothing, are
    spread likewise. The salt is a hash, so a task that runs again sends each
    row to the same place. Without ``salt_by`` a hot key is left to adaptive
    execution, which splits it.
    """
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown join strategy {strategy!r}; choose from {', '.join(STRATEGIES)}")
    if how not in ("left", "inner"):
        raise ValueError(f"join type must be 'left' or 'inner', not {how!r}")

    columns = [*left.columns, *(name for name in right.columns if name != key)]
    if strategy == "auto":
        return left.join(right, on=key, how=how).select(*columns)
    if strategy == "broadcast":
        size = measured_bytes(right)
        if size > BROADCAST_LIMIT_BYTES:
            raise ValueError(f"the side to broadcast has {size} bytes, more than the limit of {BROADCAST_LIMIT_BYTES}")
        return left.join(F.broadcast(right), on=key, how=how).select(*columns)
    if not salt_by:
        return left.join(right.hint(strategy), on=key, how=how).select(*columns)

    parts = F.least("parts", F.lit(salts)) if salts else F.col("parts")
    hot = F.broadcast(hot_keys(left, [key]).select(F.col(key).alias("_hot"), parts.alias("_parts")))
    part = F.pmod(F.xxhash64(*salt_by), F.col("_parts")).cast("int")
    salted = left.join(hot, left[key].eqNullSafe(F.col("_hot")), "left").withColumn("_salt", F.coalesce(part, F.lit(0)))
    copies = F.sequence(F.lit(0), F.coalesce(F.col("_parts") - 1, F.lit(0)))
    repeated = right.join(hot, right[key] == F.col("_hot"), "left").select(*right.columns, F.explode(copies).alias("_salt"))
    return salted.join(repeated.hint(strategy), on=[key, "_salt"], how=how).select(*columns)
