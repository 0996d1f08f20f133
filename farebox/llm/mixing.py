"""Mixes sources to target weights: capped water-filling of a word budget, then whole and fractional repetitions.

Every source gets the share ``budget * weight / sum of weights``, but at most ``max_epochs`` times its own size; what a
source cannot take is shared again by weight among the others, until none is above its cap. That fixed point is found in one
pass: with the sources in order of cap to weight, the level after the first k are full is (budget - their caps) / (weights
of the others), and the right k is the first whose next source stays below its cap at that level.

A document is repeated ``floor(target / size of source)`` times, and once more if it is drawn for the fraction left.
Documents are drawn in a seeded order (md5 of seed, id and text) within small buckets of a source, as long as the middle of
their words lies within the fraction of the bucket's words, so each source misses its target by little,
no window holds a whole source, and a rerun draws the same documents.

Nulls: a NULL source is a source of its own, a NULL text or one without words has size 0 and is repeated like others.
Sources without words get the target 0, and so does all if there is nothing to take. Repeated rows (same id and text) are
drawn each by itself. A source without a weight gets nothing. Source statistics are one row per source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
BUCKET_ROWS = 512


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def cycled_weights(sources: DataFrame, weights: tuple[float, ...] = (5.0, 2.0, 1.0), source: str = "source") -> DataFrame:
    """Gives the distinct sources, by code point and NULL last, the weights in turn."""
    order = Window.orderBy(F.col(source).asc_nulls_last())
    turn = F.array(*map(F.lit, weights))[((F.row_number().over(order) - 1) % len(weights)).cast("int")]
    return sources.select(source).distinct().withColumn("weight", turn)


def water_fill(sizes: DataFrame, weights: DataFrame, budget_ratio: float, max_epochs: float, source: str = "source") -> DataFrame:
    """Targets per source from (source, source_size) and (source, weight)."""
    joined = sizes.join(weights.withColumnRenamed(source, "__w"), F.col(source).eqNullSafe(F.col("__w")), "left").drop("__w")
    joined = joined.withColumn("weight", F.greatest(F.coalesce("weight", F.lit(0.0)), F.lit(0.0)))
    joined = joined.withColumn("cap", F.when(F.col("weight") > 0, F.col("source_size") * float(max_epochs)).otherwise(0.0))
    fill = F.when(F.col("weight") > 0, F.col("cap") / F.col("weight")).otherwise(0.0)
    everything = Window.partitionBy()
    before = Window.orderBy("fill", F.col(source).asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    rest = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    left = F.sum("source_size").over(everything) * float(budget_ratio) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    level = F.when(F.col("weight") > 0, F.greatest(left, F.lit(0.0)) / rest)
    # Where a source's cap reaches the level of its place, all before it are full and the rest is not. From there on the level
    # only falls, so the largest of these levels is that of the first such place.
    filled = joined.withColumn("fill", fill).withColumn("level", level)
    final = F.max(F.when(F.col("fill") >= F.col("level"), F.col("level"))).over(everything)
    return filled.select(
        source,
        "source_size",
        F.coalesce(F.least(F.col("cap"), final * F.col("weight")), F.col("cap")).alias("target"),
    )


def mix_sources(
    docs: DataFrame,
    weights: DataFrame | None = None,
    budget_ratio: float = 1.5,
    max_epochs: float = 2.0,
    seed: int = 17,
    source: str = "source",
) -> DataFrame:
    """``docs`` (doc_id, text, source, ...) with size, source_size, target and the number of ``copies`` to take.

    ``weights`` has a row (source, weight) per source; by default the weights 5, 2, 1 go around. Columns of these
    names in ``docs`` are replaced.
    """
    own = ("__size", "__order", "__bucket")
    docs = docs.drop("source_size", "target", "copies", "size", *own)
    key = F.md5(F.concat_ws("|", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.md5(F.coalesce("text", F.lit("")))))
    sized = docs.withColumn("__size", word_count(F.col("text"))).withColumn("__order", key)
    sizes = sized.groupBy(source).agg(F.sum("__size").alias("source_size"), F.count("*").alias("rows"))
    filled = water_fill(sizes.drop("rows"), weights or cycled_weights(docs), budget_ratio, max_epochs, source)
    plan = filled.withColumnRenamed(source, "__s").join(
        sizes.select(F.col(source).alias("__s2"), "rows"), F.col("__s").eqNullSafe(F.col("__s2"))
    )
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    plan = plan.select("__s", "source_size", "target", rate.alias("__rate"), F.ceil(F.col("rows") / BUCKET_ROWS).alias("__buckets"))
    joined = sized.join(plan, F.col(source).eqNullSafe(F.col("__s")))
    number = F.conv(F.substring("__order", 1, 8), 16, 10).cast("long")
    joined = joined.withColumn("__bucket", number % F.col("__buckets"))
    group = Window.partitionBy("__s", "__bucket")
    before = F.coalesce(F.sum("__size").over(group.orderBy("__order").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    middle = before + F.col("__size") / 2
    whole = F.floor("__rate")
    drawn = middle < (F.col("__rate") - whole) * F.sum("__size").over(group)
    copies = (whole + drawn.cast("int")).cast("int")
    return joined.select(*docs.columns, F.col("__size").alias("size"), "source_size", "target", copies.alias("copies"))


MIX_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5('17|' || coalesce(doc_id::VARCHAR, '') || '|' || md5(coalesce(text, ''))) AS place
  FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, ceil(count(*) / 512.0)::BIGINT AS buckets,
         [5.0, 2.0, 1.0][1 + (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3]::DOUBLE AS weight
  FROM sized GROUP BY source),
levels AS (
  SELECT *, 2.0::DOUBLE * source_size AS cap, 2.0::DOUBLE * source_size / weight AS fill,
         greatest(1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(2.0::DOUBLE * source_size) OVER earlier, 0), 0)
           / (sum(weight) OVER () - coalesce(sum(weight) OVER earlier, 0)) AS level
  FROM sources
  WINDOW earlier AS (ORDER BY 2.0::DOUBLE * source_size / weight, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
  SELECT *, coalesce(least(cap, (max(CASE WHEN fill >= level THEN level END) OVER ()) * weight), cap) AS target FROM levels),
rated AS (
  SELECT d.*, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
         ('0x' || substr(d.place, 1, 8))::BIGINT % t.buckets AS bucket
  FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source),
drawn AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source, bucket ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
              + size / 2.0 < (rate - floor(rate)) * sum(size) OVER (PARTITION BY source, bucket) AS more
  FROM rated)
SELECT doc_id, size, source_size, target, (size * (floor(rate)::BIGINT + more::BIGINT))::BIGINT AS taken FROM drawn
"""
