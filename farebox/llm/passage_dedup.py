"""Removes repeated passages by hashes of sentence-bounded units, wherever they begin and end in a line.

A text is cut into pieces after each run of ``.``, ``!``, ``?`` and line feeds. From every piece on, the shortest stretch of whole pieces with
``min_words`` words or more is a unit: a small paragraph. Units are normalised (lower case, blanks collapsed and trimmed, blank pieces passed over) and hashed
with MD5. Over all documents the occurrence of the lowest rank keeps a unit: smallest id, then text hash, then place. All other
occurrences go; ``removed`` retains their places in the original text, as (start, end) in characters, neighbouring ones joined. Units overlap, so a long passage goes
from its first whole piece to its last, while what fewer words repeat (a heading, a standard phrase) stays.

Texts are packed into slices, one row each, in a table bucketed by slice. Slices first learn, a bit for each, which of their 64-bit
unit hashes stand elsewhere too; rows are made for those alone. What stands earlier in its own slice goes at once, so a slice sends a unit once, however
frequent it is. First occurrences are combined in the tasks before they shuffle, and Spark can split the join of the others.

Nulls: a NULL text stays NULL with nothing removed; NULL ids rank last. Repeated rows (same id and text) are one document: both keep or lose the same
passages. Texts that lose all pieces become empty. A text that repeats one sentence over and over keeps its first unit's beginning. Other columns stay;
clashing ones (``removed``, ``n_removed``) are replaced.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farebox.llm.scratch import Steps
from farebox.llm.suffix_dedup import PART_BYTES, Slice, pack_slices, shared_values, slice_rows

MIN_WORDS = 15
PIECES = re.compile(r"[^.!?\n]*[.!?\n]+|[^.!?\n]+").findall
BLANKS = re.compile(r"[\x20\x09-\x0D]+")
UNIT_SQL = "digest binary, late boolean, id long, version long, start long, stop long, slice long, place int"


def units_of(text: str, min_words: int) -> Iterator[tuple[int, int, bytes]]:
    """Start, end and digest of every unit of a text."""
    ends, norms, words, at = [], [], [], 0
    for piece in PIECES(text):
        at += len(piece)
        norm = BLANKS.sub(" ", piece.lower()).strip(" ")
        ends.append((at - len(piece), at))
        norms.append(norm)
        words.append(norm.count(" ") + 1 if norm else 0)
    stop, total = 0, 0
    for first, norm in enumerate(norms):
        while stop < len(norms) and total < min_words:
            total += words[stop]
            stop += 1
        if total < min_words:
            return
        if norm:
            unit = " ".join([x for x in norms[first:stop] if x])
            yield ends[first][0], ends[stop - 1][1], hashlib.md5(unit.encode()).digest()
        total -= words[first]


class PassageSlice(Slice):
    """The texts of one packed row, and the units of each; ``length`` is the least number of words."""

    def texts(self) -> list[str]:
        raw = self.data.tobytes()
        return [raw[a:b].decode() for a, b in zip(self.offsets[:-1].tolist(), self.offsets[1:].tolist(), strict=True)]

    def runs(self) -> None:
        units = [(place, *unit) for place, text in enumerate(self.texts()) for unit in units_of(text, self.length)]
        self.place, self.start, self.stop = np.array([u[:3] for u in units], np.int64).reshape(-1, 3).T
        self.digests = [u[3] for u in units]
        self.value = np.frombuffer(b"".join([d[:8] for d in self.digests]), np.uint64)
        self.known, self.of = np.unique(self.value, return_inverse=True)
        self.count = np.ones(len(self.value), np.int64) - (self.length - 1)  # a unit counts as one byte


def repeated_units(slices: DataFrame, parts: int, min_words: int) -> DataFrame:
    """UNIT rows of all units whose hash stands twice; ``slices`` with ``marks``, the bits of their hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in slice_rows(batches):
            one = PassageSlice(row, min_words)
            one.runs()
            again = np.bincount(one.of, minlength=len(one.known)) > 1
            split = one.parts(parts) if row["marks"] else {}
            for mark in row["marks"] or []:
                where = split[mark["part"]]
                again[where] |= np.unpackbits(np.frombuffer(mark["shared"], np.uint8), count=len(where)).astype(bool)
            kept = np.flatnonzero(again[one.of]) if len(one.of) else np.zeros(0, np.int64)
            place = one.place[kept]
            kept = kept[np.lexsort((one.start[kept], one.versions[place], one.ids[place], one.late[place]))]
            place = one.place[kept]
            columns = [
                pa.array(first_digests(one, kept), pa.binary()),
                pa.array(one.late[place]),
                *[pa.array(x, pa.int64()) for x in (one.ids[place], one.versions[place], one.start[kept], one.stop[kept], np.full(len(kept), one.number))],
                pa.array(place, pa.int32()),
            ]
            yield pa.record_batch(columns, ["digest", "late", "id", "version", "start", "stop", "slice", "place"])

    return slices.mapInArrow(run, UNIT_SQL)


def first_digests(one: PassageSlice, kept: np.ndarray) -> list[bytes | None]:
    """Digests of ranked units; None for one that stands earlier in the slice, so it goes whatever other slices hold."""
    who = list(zip(one.late[one.place[kept]].tolist(), one.ids[one.place[kept]].tolist(), one.versions[one.place[kept]].tolist(), one.start[kept].tolist(), strict=True))
    seen: dict[bytes, tuple] = {}
    digests = [one.digests[k] for k in kept.tolist()]
    return [d if seen.setdefault(d, w) == w else None for d, w in zip(digests, who, strict=True)]


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, stop in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(stop, out[-1][1]))
        else:
            out.append((start, stop))
    return out


def repeated_places(docs: DataFrame, min_words: int, doc_id: str) -> DataFrame:
    """(__id, __version, __gone): per document that loses something the merged places, in characters."""
    spark, steps = docs.sparkSession, Steps(docs.sparkSession)
    text = F.col("text").cast("string")
    texts = docs.select(F.col(doc_id).cast("long").alias("id"), F.xxhash64(text).alias("version"), text.alias("text"))
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), size // PART_BYTES)
    slices = steps.bucketed(pack_slices(texts), "slices", "slice", parts)
    marks = shared_values(slices, parts, min_words, 1 << 62, PassageSlice)
    marks = marks.groupBy("slice").agg(F.collect_list(F.struct("part", "shared")).alias("marks"))
    units = steps.keep(repeated_units(slices.join(marks.hint("shuffle_hash"), "slice", "left"), parts, min_words), "units")
    ranked = units.withColumn("rank", F.struct("late", "id", "version", "start"))
    sent = ranked.filter(F.col("digest").isNotNull())
    first = steps.keep(sent.groupBy("digest").agg(F.min("rank").alias("first")), "first")
    later = sent.join(first.hint("merge"), "digest").filter("rank > first").drop("first")
    later = later.unionByName(ranked.filter(F.col("digest").isNull()))
    # Of repeated rows one stands for all: their units have equal ranks, and so the same places go.
    spans = later.groupBy("late", "id", "version").agg(F.collect_set(F.struct("start", "stop")).alias("spans"))

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = pa.array([None if late else i for late, i in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)], pa.int64())
            gone = [[{"start": a, "end": b} for a, b in merged([(s["start"], s["stop"]) for s in cell])] for cell in batch.column(3).to_pylist()]
            kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
            yield pa.record_batch([ids, batch.column(2), pa.array(gone, kind)], ["__id", "__version", "__gone"])

    return spans.mapInArrow(join, "__id long, __version long, __gone array<struct<start:int,end:int>>")


def remove_passages(docs: DataFrame, min_words: int = MIN_WORDS, doc_id: str = "doc_id") -> DataFrame:
    """``docs`` (doc_id, text, ...) with repeated passages cut out of ``text``, their old places in ``removed``, and ``n_removed`` of them."""
    gone = Steps(docs.sparkSession).keep(repeated_places(docs, min_words, doc_id), "gone")
    names = [c for c in docs.columns if c not in ("removed", "n_removed")]
    text = F.col("text").cast("string")
    # Texts meet their lists by a shuffle at any size; where few lists exist a broadcast would only seem to make that free.
    same = F.col(doc_id).cast("long").eqNullSafe(F.col("__id")) & (F.xxhash64(text) == F.col("__version"))
    joined = docs.select(*names).join(gone.hint("merge"), same, "left")
    schema = T.StructType([*[docs.schema[c] for c in names if c != "text"], T.StructField("text", T.StringType()), T.StructField("removed", T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])))])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, gone = batch.column(len(batch.columns) - 2).to_pylist(), batch.column(len(batch.columns) - 1)
            for k, spans in enumerate(gone.to_pylist()):
                if spans:
                    edges = [0, *[x for s in spans for x in (s["start"], s["end"])], len(texts[k])]
                    texts[k] = "".join([texts[k][a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)])
            yield pa.record_batch([*batch.columns[:-2], pa.array(texts, pa.string()), pa.array([x or [] for x in gone.to_pylist()], gone.type)], schema.names)

    out = joined.select(*[c for c in names if c != "text"], text.alias("text"), "__gone").mapInArrow(cut, schema)
    return out.select(*names, "removed", F.size("removed").alias("n_removed"))


PASSAGES_SQL = r"""
WITH docs AS (SELECT DISTINCT doc_id, text, md5(text) AS version, regexp_extract_all(text, '[^.!?\n]*[.!?\n]+|[^.!?\n]+') AS pieces FROM documents WHERE text IS NOT NULL),
cut AS (SELECT doc_id, version, pieces, unnest(range(1, len(pieces) + 1)) AS pos FROM docs),
norms AS (SELECT doc_id, version, pos, length(pieces[pos]) AS size, trim(regexp_replace(lower(pieces[pos]), '[\x20\x09-\x0D]+', ' ', 'g'), ' ') AS norm FROM cut),
pieces AS (
  SELECT *, sum(words) OVER upto AS reached, sum(size) OVER upto AS stop
  FROM (SELECT *, CASE WHEN norm = '' THEN 0 ELSE len(string_split(norm, ' ')) END AS words FROM norms)
  WINDOW upto AS (PARTITION BY doc_id, version ORDER BY pos)),
ends AS (
  SELECT a.doc_id, a.version, a.pos, min(b.pos) AS last
  FROM pieces a JOIN pieces b ON a.doc_id IS NOT DISTINCT FROM b.doc_id AND a.version = b.version AND b.pos >= a.pos AND b.reached - a.reached + a.words >= 15
  WHERE a.norm <> '' GROUP BY a.doc_id, a.version, a.pos),
lists AS (SELECT doc_id, version, list(norm ORDER BY pos) AS norms FROM pieces GROUP BY doc_id, version),
units AS (
  SELECT e.*, array_to_string(list_filter(norms[e.pos:e.last], lambda x: x <> ''), ' ') AS unit
  FROM ends e JOIN lists l ON e.doc_id IS NOT DISTINCT FROM l.doc_id AND e.version = l.version),
later AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY unit ORDER BY doc_id NULLS LAST, version, pos) AS place FROM units) WHERE place > 1),
gone AS (
  SELECT p.doc_id, p.version, p.pos, p.stop - p.size AS start, p.stop,
         p.pos - row_number() OVER (PARTITION BY p.doc_id, p.version ORDER BY p.pos) AS run
  FROM pieces p WHERE EXISTS (SELECT 1 FROM later l WHERE l.doc_id IS NOT DISTINCT FROM p.doc_id AND l.version = p.version AND p.pos BETWEEN l.pos AND l.last)),
runs AS (SELECT doc_id, version, min(start) AS start, max(stop) AS stop FROM gone GROUP BY doc_id, version, run),
spans AS (SELECT doc_id, version, count(*) AS n, string_agg(start || '-' || stop, ',' ORDER BY start) AS removed FROM runs GROUP BY doc_id, version),
kept AS (
  SELECT p.doc_id, p.version, string_agg(d.pieces[p.pos], '' ORDER BY p.pos) AS text
  FROM pieces p JOIN docs d ON p.doc_id IS NOT DISTINCT FROM d.doc_id AND p.version = d.version
  WHERE NOT EXISTS (SELECT 1 FROM gone g WHERE g.doc_id IS NOT DISTINCT FROM p.doc_id AND g.version = p.version AND g.pos = p.pos) GROUP BY p.doc_id, p.version)
SELECT d.doc_id, coalesce(s.n, 0)::INTEGER AS n_removed, CASE WHEN s.n IS NULL THEN d.text ELSE coalesce(k.text, '') END AS text, coalesce(s.removed, '') AS removed
FROM documents d
LEFT JOIN spans s ON d.doc_id IS NOT DISTINCT FROM s.doc_id AND md5(d.text) = s.version
LEFT JOIN kept k ON d.doc_id IS NOT DISTINCT FROM k.doc_id AND md5(d.text) = k.version
"""
