"""Removes repeated passages: lines (or paragraphs) that an earlier document, or an earlier place, already holds.

A text is cut into units at a separator (line feeds by default). A unit of at least ``min_words`` words is normalised
(lower case, blanks collapsed and trimmed) and hashed with MD5. A longest run of neighbouring shorter units, which an empty
or a long unit ends, is joined by blanks and hashed as one if it has ``min_words`` words together; so passages wrapped into short lines are
found, and lone headings and standard phrases stay. ``short_runs=False`` never touches short units. Over all documents the occurrence of the lowest rank keeps the unit: smallest id, then text hash, then
place in the text. All others are removed, and ``removed`` retains their places in the original text, as (start, end)
in characters, in order.

Digests are combined before they shuffle; the joins by digest and by document are ones that Spark can split where
a digest or a document is frequent. Only the documents' own lists of removed places are gathered.

Nulls: a NULL text stays NULL with nothing removed; NULL ids rank last. Repeated rows (same id and text) are one document: both
keep or lose the same units. Texts that lose all units become empty. Other columns stay; clashing ones are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farebox.llm.scratch import Steps

MIN_WORDS = 20


def normalised(unit: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(unit), r"[\x20\x09-\x0D]+", " "))


def units_of(pieces: Column, min_words: int) -> Column:
    """Per text (pos, stop, unit) of every long piece and every run of short ones, empty pieces and long ones standing between runs."""
    norm = F.transform(pieces, normalised)

    def words(unit: Column) -> Column:
        return F.size(F.split(unit, " "))

    long = F.filter(F.transform(norm, lambda x, i: F.struct(i.alias("pos"), (i + 1).alias("stop"), x.alias("unit"))), lambda x: words(x.unit) >= min_words)
    ends = F.filter(F.transform(norm, lambda x, i: F.when((x == "") | (words(x) >= min_words), i)), lambda i: i.isNotNull())
    ends = F.concat(F.array(F.lit(-1)), ends, F.array(F.size(pieces)))
    spans = F.zip_with(F.slice(ends, F.lit(1), F.size(ends) - 1), F.slice(ends, F.lit(2), F.size(ends) - 1), lambda a, b: F.struct((a + 1).alias("pos"), b.alias("stop")))

    def joined(x: Column) -> Column:
        return F.struct(x.pos.alias("pos"), x.stop.alias("stop"), F.array_join(F.slice(norm, x.pos + 1, x.stop - x.pos), " ").alias("unit"))

    runs = F.transform(F.filter(spans, lambda x: x.stop - x.pos > 1), joined)
    return F.concat(long, F.filter(runs, lambda x: words(x.unit) >= min_words))


def remove_repeats(docs: DataFrame, separator: str = "\n", min_words: int = MIN_WORDS, doc_id: str = "doc_id", short_runs: bool = True) -> DataFrame:
    """``docs`` (doc_id, text, ...) with repeated units cut out of ``text``, their old places in ``removed``."""
    steps = Steps(docs.sparkSession)
    pieces = F.split("text", f"\\Q{separator}\\E", -1)
    who = [F.col(doc_id).alias("id"), F.md5("text").alias("version")]
    known = docs.filter(F.col("text").isNotNull())
    if short_runs:
        units = known.select(*who, F.inline(units_of(pieces, min_words)))
    else:
        units = known.select(*who, F.posexplode(pieces).alias("pos", "unit")).withColumn("stop", F.col("pos") + 1)
        units = units.withColumn("unit", normalised(F.col("unit"))).filter(F.size(F.split("unit", " ")) >= min_words)
    rank = F.struct(F.col("id").isNull().alias("late"), "id", "version", "pos")
    hashed = steps.keep(units.select(F.unhex(F.md5("unit")).alias("digest"), rank.alias("rank"), "stop"), "units")
    first = hashed.groupBy("digest").agg(F.min("rank").alias("first"), F.count("*").alias("found")).filter("found > 1")
    repeats = hashed.join(steps.keep(first.select("digest", "first"), "first"), "digest").filter("NOT rank <=> first")
    gone = repeats.groupBy("rank.id", "rank.version").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.sequence("rank.pos", F.col("stop") - 1))))).alias("__gone"))
    gone = steps.keep(gone.withColumnsRenamed({"id": "__id", "version": "__version"}), "gone")
    names = [c for c in docs.columns if c not in ("removed", "n_removed")]
    # Texts meet their lists by a shuffle at any size; where few lists exist a broadcast would only seem to make that free.
    joined = docs.select(*names).join(gone.hint("merge"), F.col(doc_id).eqNullSafe(F.col("__id")) & (F.md5("text") == F.col("__version")), "left")
    kept = F.array_join(F.filter(pieces, lambda x, i: ~F.array_contains(F.col("__gone"), i)), separator)
    cut = joined.withColumn("__pieces", pieces).withColumn("__new", F.when(F.col("__gone").isNull(), F.col("text")).otherwise(kept))

    def span(pos: Column) -> Column:
        before = F.slice("__pieces", F.lit(1), pos)
        start = F.aggregate(before, F.lit(0), lambda total, x: total + F.length(x) + len(separator))
        return F.struct(start.alias("start"), (start + F.length(F.get("__pieces", pos))).alias("end"))

    spans = F.coalesce(F.transform("__gone", span), F.array().cast("array<struct<start:int,end:int>>"))
    out = cut.withColumn("removed", spans)
    return out.select(*[F.col("__new").alias("text") if c == "text" else F.col(c) for c in names], "removed", F.size("removed").alias("n_removed"))

