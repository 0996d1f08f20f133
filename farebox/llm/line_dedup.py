"""Drops boilerplate lines: those found on a larger part of a host's pages than a ratio.

A line is what stands between line feeds, compared without blanks at its ends; its identity is a 64-bit hash and its
length. Pages of a host with the same text count as one page, so that a text copied many times is not taken for boilerplate.
A line goes, wherever it stands on the host, if it is on at least ``min_pages`` different pages of the host and on more than
``max_ratio`` of them. Lines of blanks only are never boilerplate.

Only DataFrame functions. Lines shuffle as hashes, combined before the shuffle; texts themselves move only if the
table of boilerplate lines is too large for Spark to broadcast by its own size check, and then Spark can split a large host.

Nulls: a NULL text stays NULL; pages with a NULL host form one host. Empty texts have no lines that count. The rows, their order
of lines and the other columns stay as they are, repeated rows included; a text that consists of boilerplate becomes empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farebox.llm.scratch import Steps

MAX_RATIO = 0.1
MIN_PAGES = 10


def line_key(line: Column) -> Column:
    line = F.trim(line)
    return F.xxhash64(line, F.length(line))


def boilerplate_lines(pages: DataFrame, host: str = "source", max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """Per host the hashes (``lines``) of its boilerplate lines. Hosts without any are left out."""
    known = pages.filter(F.col("text").isNotNull()).select(F.col(host).alias("host"), "text")
    page = F.struct(F.xxhash64("text").alias("hash"), F.length("text").alias("size"))
    lines = F.array_distinct(F.transform(F.filter(F.split("text", "\n", -1), lambda x: F.trim(x) != ""), line_key))
    hosts = known.select("host", page.alias("page")).distinct().groupBy("host").agg(F.count("*").alias("pages"))
    found = known.select("host", page.alias("page"), lines.alias("lines")).select("host", "page", F.explode("lines").alias("line")).distinct()
    counted = found.groupBy("host", "line").agg(F.count("*").alias("found")).filter(F.col("found") >= min_pages)
    often = counted.withColumnRenamed("host", "__h").join(hosts, F.col("__h").eqNullSafe(F.col("host")))
    often = often.filter(F.col("found") > max_ratio * F.col("pages"))
    return often.groupBy("host").agg(F.collect_set("line").alias("lines"))


def drop_boilerplate(pages: DataFrame, host: str = "source", max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """``pages`` (text, host, ...) with the boilerplate lines cut out of ``text``, and their number in ``n_dropped``."""
    often = boilerplate_lines(pages, host, max_ratio, min_pages).select(F.col("host").alias("__host"), F.col("lines").alias("__lines"))
    # Written first, so that Spark knows its size before it decides whether texts must move to meet it.
    often = Steps(pages.sparkSession).keep(often, "often")
    joined = pages.join(often, F.col(host).eqNullSafe(F.col("__host")), "left")
    split = F.split("text", "\n", -1)
    kept = F.filter(split, lambda x: ~F.array_contains(F.col("__lines"), line_key(x)))
    hit = F.col("__lines").isNotNull() & F.col("text").isNotNull()
    text = F.when(hit, F.array_join(kept, "\n")).otherwise(F.col("text"))
    dropped = F.when(hit, F.size(split) - F.size(kept)).otherwise(0).cast("int")
    names = [c for c in pages.columns if c != "n_dropped"]
    return joined.select(*[text.alias("text") if c == "text" else F.col(c) for c in names], dropped.alias("n_dropped"))


LINES_SQL = """
WITH split AS (
  SELECT DISTINCT source, text, trim(line) AS line
  FROM (SELECT source, text, unnest(string_split(text, chr(10))) AS line FROM documents WHERE text IS NOT NULL) WHERE trim(line) <> ''),
hosts AS (SELECT source, count(DISTINCT text) AS pages FROM documents WHERE text IS NOT NULL GROUP BY source),
often AS (
  SELECT s.source, s.line FROM split s JOIN hosts h ON s.source IS NOT DISTINCT FROM h.source
  GROUP BY s.source, s.line, h.pages HAVING count(*) >= 10 AND count(*) > 0.1 * h.pages),
lists AS (SELECT source, list(line) AS lines FROM often GROUP BY source),
kept AS (
  SELECT d.doc_id, d.text, CASE WHEN l.lines IS NULL THEN string_split(d.text, chr(10))
                   ELSE list_filter(string_split(d.text, chr(10)), lambda x: NOT list_contains(l.lines, trim(x))) END AS lines
  FROM documents d LEFT JOIN lists l ON d.source IS NOT DISTINCT FROM l.source)
SELECT doc_id, array_to_string(lines, chr(10)) AS text, coalesce(len(string_split(text, chr(10))) - len(lines), 0)::INTEGER AS n_dropped FROM kept
"""
