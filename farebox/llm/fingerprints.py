"""Document fingerprints: bottom-k sketches of word shingle hashes.

The fingerprint of a text is the sorted list of the ``k`` smallest 64-bit hashes of its distinct five-word shingles
(words are lower-cased; a shorter text is one shingle of all its words). Sketches of parts merge into that of the whole by
keeping the k smallest of both, so they can be built in any order. Two sketches estimate resemblance and containment by the
hashes they share among the k smallest of their union, one sketch estimates the number of distinct shingles by how close
together its hashes lie; all three are exact for texts of fewer than k shingles.

Only DataFrame functions. A sketch is made within its row; nothing is grouped by shingle.

Nulls, empty texts and texts without words have the empty sketch, which is like another empty one (1.0) and unlike any
other (0.0). Equal texts have equal sketches, so ties and repeated rows need no rule.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from farebox.llm.scratch import Steps

K = 128
WORDS = 5
BLANKS = " \t\n\x0b\f\r"
BUCKET_BITS, LEVEL_BITS, TOP_BITS = 6, 16, 10


def word_hashes(text: Column) -> Column:
    words = F.split(F.btrim(F.lower(text), F.lit(BLANKS)), r"[\x20\x09-\x0D]+")
    return F.when(F.btrim(text, F.lit(BLANKS)) == "", F.array().cast("array<bigint>")).otherwise(F.transform(words, lambda x: F.xxhash64(x)))


def smallest(hashes: Column, k: int) -> Column:
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def bottom_k(words: Column, k: int = K) -> Column:
    """Sketch from the array of a text's word hashes; give it as a column of its own, as it is used many times."""
    n = F.size(words)
    runs = F.transform(F.sequence(F.lit(0), n - WORDS), lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(WORDS)]))
    whole = F.array(F.xxhash64(words))
    return F.when(n == 0, F.array().cast("array<bigint>")).when(n < WORDS, whole).otherwise(smallest(runs, k))


def merge(left: Column, right: Column, k: int = K) -> Column:
    """Sketch of two parts together. Shingles across their border belong to neither."""
    return F.slice(F.sort_array(F.array_union(left, right)), 1, k)


def _shared(left: Column, right: Column, k: int) -> tuple[Column, Column]:
    union = merge(left, right, k)
    return F.size(F.array_intersect(F.array_intersect(union, left), right)), F.size(union)


def resemblance(left: Column, right: Column, k: int = K) -> Column:
    """Estimated intersection over union, 0 to 1."""
    both, union = _shared(left, right, k)
    return F.when(union == 0, 1.0).otherwise(both / union)


def distinct_shingles(sketch: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles."""
    reach = (F.element_at(sketch, -1) / 2.0**64) + 0.5
    return F.when(F.size(sketch) < k, F.size(sketch).cast("double")).otherwise((k - 1) / reach)


def containment(part: Column, whole: Column, k: int = K) -> Column:
    """Estimated part of the first text's shingles that are in the second, 0 to 1."""
    both = resemblance(part, whole, k) * distinct_shingles(merge(part, whole, k), k)
    return F.when(F.size(part) == 0, 1.0).otherwise(F.least(F.lit(1.0), both / distinct_shingles(part, k)))


def as_text(sketch: Column) -> Column:
    return F.array_join(F.transform(sketch, lambda x: F.lpad(F.hex(x), 16, "0")), "")


def with_fingerprint(docs: DataFrame, name: str = "fingerprint", text: str = "text", k: int = K) -> DataFrame:
    """``docs`` with the sketch of each whole text as an array of longs."""
    hashed = docs.withColumn("__words", word_hashes(F.coalesce(F.col(text).cast("string"), F.lit(""))))
    return hashed.withColumn(name, bottom_k(F.col("__words"), k)).drop("__words")


def following(groups: DataFrame, bits: int) -> DataFrame:
    """(late, g, next_late, next_g) for distinct groups: the one after it in the order late, g descending; the first after the last.

    Groups are ranked within 2 ** LEVEL_BITS neighbours at a time, so no window holds all of them.
    """
    if bits <= TOP_BITS:
        order = Window.orderBy("late", F.desc("g"))
        pair = F.struct("late", "g")
        after = F.coalesce(F.lead(pair).over(order), F.first(pair).over(order.rowsBetween(Window.unboundedPreceding, 0)))
        return groups.withColumn("after", after).select("late", "g", F.col("after.late").alias("next_late"), F.col("after.g").alias("next_g"))
    parent = groups.withColumn("p", F.shiftright("g", LEVEL_BITS))
    inside = parent.withColumn("next", F.lead("g").over(Window.partitionBy("late", "p").orderBy(F.desc("g"))))
    heads = parent.groupBy("late", "p").agg(F.max("g").alias("head"))
    up = following(heads.select("late", F.col("p").alias("g")), bits - LEVEL_BITS)
    to = heads.select(F.col("late").alias("next_late"), F.col("p").alias("next_g"), "head")
    jump = up.join(to, ["next_late", "next_g"]).select("late", F.col("g").alias("p"), "next_late", "head")
    joined = inside.join(jump, ["late", "p"])
    own = F.col("next").isNotNull()
    return joined.select("late", "g", F.when(own, F.col("late")).otherwise(F.col("next_late")).alias("next_late"), F.coalesce("next", "head").alias("next_g"))


def with_next(docs: DataFrame, columns: tuple[str, ...], steps: Steps, doc_id: str = "doc_id") -> DataFrame:
    """Adds ``next`` with ``columns`` of the row after it, by descending id, the first after the last.

    Rows with a NULL id come last, by a hash of the text; rows of one id follow each other by that hash too.
    Rows are ordered within small ranges of ids; the first row of a range is copied to the end of the range before it.
    """
    tie = F.xxhash64("text")
    keyed = docs.withColumn("late", F.col(doc_id).isNull()).withColumn("tie", tie)
    keyed = keyed.withColumn("key", F.coalesce(F.col(doc_id).cast("long"), "tie")).withColumn("g", F.shiftright("key", BUCKET_BITS))
    bare = docs.select(F.col(doc_id).isNull().alias("late"), F.coalesce(F.col(doc_id).cast("long"), tie).alias("key"))
    groups = steps.keep(bare.groupBy("late", F.shiftright("key", BUCKET_BITS).alias("g")).agg(F.max("key").alias("head")), "ranges")
    after = following(groups.select("late", "g"), 64 - BUCKET_BITS)
    before = after.select(F.col("next_late").alias("late"), F.col("next_g").alias("g"), F.col("late").alias("to_late"), F.col("g").alias("to_g"))
    heads = steps.keep(before.join(groups, ["late", "g"]), "heads")
    led = keyed.join(heads.withColumnRenamed("late", "l2").withColumnRenamed("g", "g2"), (F.col("late") == F.col("l2")) & (F.col("key") == F.col("head")), "left")
    here = F.struct(F.lit(False).alias("copy"), F.col("late").alias("late"), F.col("g").alias("g"))
    there = F.struct(F.lit(True).alias("copy"), F.col("to_late").alias("late"), F.col("to_g").alias("g"))
    placed = led.withColumn("at", F.explode(F.when(F.col("head").isNotNull(), F.array(here, there)).otherwise(F.array(here))))
    order = Window.partitionBy("at.late", "at.g").orderBy("at.copy", F.desc("key"), "tie")
    found = placed.withColumn("next", F.lead(F.struct(*columns)).over(order)).filter(~F.col("at.copy"))
    return found.select(*docs.columns, "next")


def fingerprint_edits(docs: DataFrame, k: int = K) -> DataFrame:
    """Sketches of ``docs`` (doc_id, text) and of their edited texts, whose last half is the start of the next document."""
    steps = Steps(docs.sparkSession)
    bare = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    paired = with_next(with_fingerprint(bare, "sketch", k=k), ("text", "sketch"), steps)
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring("next.text", F.lit(1), half))
    made = with_fingerprint(paired.withColumn("n_chars", n.cast("long")).withColumn("edited", edited), "edited_sketch", "edited", k)
    return made.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_text(F.col("sketch")).alias("fingerprint"),
        as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        resemblance(F.col("sketch"), F.col("edited_sketch"), k).alias("near_edited"),
        resemblance(F.col("sketch"), F.col("next.sketch"), k).alias("near_next"),
    )
