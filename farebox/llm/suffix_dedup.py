"""Removes every byte covered by a string of ``length`` bytes that also starts earlier, found in suffix arrays.

"Earlier" is a smaller id, or the same document and an earlier start. All strings are judged on the input. A match never crosses documents.

1. Texts are packed into slices of about ``SLICE_BYTES``, one row each, in a table bucketed by slice. So what is found about a slice comes back to its texts
   by a join that shuffles the findings only.
2. Windows are told apart by their least gram hash: equal windows have equal ones. Neighbouring windows of one hash make a run, whose stretch of text
   is as long as its windows reach. Slices send the hashes of their runs, packed by a part of the hash, and get back, a bit for each, which
   stand in another slice too. Everything else occurs once and is done with.
3. The stretches of those runs meet in buckets by hash, about ``BUCKET_BYTES`` each. In a bucket the suffixes that begin a window are sorted in two stages (see
   ``suffix_order``): directly where smaller than their successor, by bucket scans the rest. Adjacent common prefixes of ``length`` bytes
   make classes of equal windows; all windows but the earliest of a class go.
4. Copies of a stretch within a slice go at once; only the first is sent. A hash with more than ``HOT_BYTES`` of stretches (a line that a third of all documents hold,
   in ever new surroundings) is split further: each of its windows is a row, first occurrences are combined in the tasks before
   they shuffle, and the others join them.

Places to remove are gathered per slice, so no list is longer than a slice's texts allow.

NULL texts are empty. NULL ids rank last; among rows of one id the hash of the text decides. Repeated rows (same id and text) are one document: both keep or
lose the same bytes. Kept bytes may end within a character, so they are binary. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farebox.llm.buffers import mix, pieces_of, text_bytes
from farebox.llm.scratch import Steps
from farebox.llm.suffix_array import anchored_runs, equal_windows

LENGTH = 100
SLICE_BYTES = 4 << 20
BUCKET_BYTES = 2 << 20
HOT_BYTES = 4 << 20
PART_BYTES = 64 << 20
MOST_WINDOWS = 4096
CONTEXT, WINDOW, REMOVED = 0, 1, 2

PLACE = [("late", pa.bool_()), ("id", pa.int64()), ("version", pa.int64()), ("start", pa.int64()), ("slice", pa.int64()), ("place", pa.int32()), ("size", pa.int64())]
STRETCH = pa.schema([("kind", pa.int32()), ("value", pa.int64()), ("digest", pa.binary()), ("text", pa.binary()), *PLACE])
STRETCH_SQL = "kind int, value long, digest binary, text binary, late boolean, id long, version long, start long, slice long, place int, size long"
SPAN_SQL = "slice long, place int, start long, stop long"


def pack_slices(texts: DataFrame) -> DataFrame:
    """(slice, ids, versions, sizes, raw, blob) from (id, version, text)."""

    def pack(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held).combine_chunks()
        data, offsets = text_bytes(rows.column(2).combine_chunks() if len(held) > 1 else rows.column(2).chunk(0))
        lists = [[rows.column(0).to_pylist()], [rows.column(1).to_pylist()], [np.diff(offsets)]]
        blob = pa.compress(data.tobytes(), codec="zstd", asbytes=True) if len(data) else b""
        values = [pa.array([uuid.uuid4().int >> 65]), *[pa.array(x, pa.list_(pa.int64())) for x in lists], pa.array([len(data)]), pa.array([blob], pa.binary())]
        return pa.record_batch(values, ["slice", "ids", "versions", "sizes", "raw", "blob"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for piece in pieces_of(batch, 2, SLICE_BYTES):
                held.append(piece)
                size += len(text_bytes(piece.column(2))[0])
                if size >= SLICE_BYTES:
                    yield pack(held)
                    held, size = [], 0
        if held:
            yield pack(held)

    return texts.mapInArrow(run, "slice long, ids array<long>, versions array<long>, sizes array<long>, raw long, blob binary")


class Slice:
    """The texts of one row of packed slices, and their runs of windows."""

    def __init__(self, row: dict, length: int):
        self.number, self.length = row["slice"], length
        self.data = np.frombuffer(pa.decompress(row["blob"], row["raw"], "zstd") if row["raw"] else b"", np.uint8)
        self.offsets = np.r_[0, np.cumsum(np.array(row["sizes"], np.int64))]
        self.late = np.array([x is None for x in row["ids"]], bool)
        self.ids, self.versions = np.array([x or 0 for x in row["ids"]], np.int64), np.array(row["versions"], np.int64)

    def runs(self) -> None:
        self.first, self.count, self.value, self.again = anchored_runs(self.data, self.offsets, self.length, max(1, self.length * 8 // 25), MOST_WINDOWS)
        self.known, self.of = np.unique(self.value, return_inverse=True)

    def parts(self, parts: int) -> dict[int, np.ndarray]:
        """Places of the known values by part (those that have any), in the same order whenever it is asked for."""
        part = (mix(self.known) % np.uint64(parts)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        used, first = np.unique(part[order], return_index=True)
        return dict(zip(used.tolist(), np.split(order, first[1:]), strict=True)) if len(used) else {}


def slice_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for k in range(len(batch)):
            yield batch.slice(k, 1).to_pylist()[0]


def shared_values(slices: DataFrame, parts: int, length: int, hot_bytes: int, kind: type[Slice] = Slice) -> DataFrame:
    """(slice, part, shared, hot): bits for a slice's values of a part, whether they stand in other slices and are hot."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in slice_rows(batches):
            one = kind(row, length)
            one.runs()
            sizes = np.bincount(one.of, one.count + length - 1, minlength=len(one.known))
            split = list(one.parts(parts).items())
            cells = [[p for p, _ in split], [one.number] * len(split), [one.known[x].tobytes() for _, x in split], [sizes[x].astype("<f4").tobytes() for _, x in split]]
            yield pa.record_batch([pa.array(x, t) for x, t in zip(cells, (pa.int32(), pa.int64(), pa.binary(), pa.binary()), strict=True)], ["part", "slice", "values", "sizes"])

    def count(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        values = [np.frombuffer(x.as_py(), np.uint64) for x in table["values"]]
        whole, which, times = np.unique(np.concatenate(values), return_inverse=True, return_counts=True)
        total = np.bincount(which, np.concatenate([np.frombuffer(x.as_py(), "<f4") for x in table["sizes"]]))
        bits = [np.split((x)[which], np.cumsum([len(v) for v in values])[:-1]) for x in (times > 1, total > hot_bytes)]
        rows = [(s.as_py(), np.packbits(a).tobytes(), np.packbits(b).tobytes()) for s, a, b in zip(table["slice"], *bits, strict=True) if a.any() or b.any()]
        return pa.table([pa.array([r[0] for r in rows], pa.int64()), pa.array([key[0].as_py()] * len(rows), pa.int32()), *[pa.array([r[k] for r in rows], pa.binary()) for k in (1, 2)]], ["slice", "part", "shared", "hot"])

    packs = slices.mapInArrow(send, "part int, slice long, values binary, sizes binary")
    return packs.groupBy("part").applyInArrow(count, "slice long, part int, shared binary, hot binary")


def stretches(slices: DataFrame, parts: int, length: int) -> DataFrame:
    """STRETCH rows of all runs that may repeat; ``slices`` with ``marks``, the bits of their values."""

    def rows_of(one: Slice, kind: np.ndarray, first: np.ndarray, size: np.ndarray, value: np.ndarray) -> Iterator[pa.RecordBatch]:
        place = np.searchsorted(one.offsets, first, "right") - 1
        start = first - one.offsets[place]
        order = np.lexsort((start, one.versions[place], one.ids[place], one.late[place]))
        place, start, kind, size, value = place[order], start[order], kind[order], size[order], value[order]
        raw, seen, digests, texts = one.data.tobytes(), {}, [], []
        for k, (at, n) in enumerate(zip(first[order].tolist(), size.tolist(), strict=True)):
            text = raw[at : at + n]
            digest = hashlib.md5(text).digest()
            who = (place[k], start[k])
            leader = seen.setdefault((digest, int(kind[k])), who)
            same = leader == who or (start[k] == leader[1] and one.late[place[k]] == one.late[leader[0]] and one.ids[place[k]] == one.ids[leader[0]] and one.versions[place[k]] == one.versions[leader[0]])
            digests.append(digest if same else None)
            texts.append(text if same and kind[k] == CONTEXT else None)
            if not same:
                kind[k] = REMOVED
        columns = [kind, value.view(np.int64), digests, texts, one.late[place], one.ids[place], one.versions[place], start, np.full(len(place), one.number), place, size]
        batch = pa.record_batch([pa.array(x, f.type) for x, f in zip(columns, STRETCH, strict=True)], schema=STRETCH)
        for at in range(0, len(batch), 20_000):
            yield batch.slice(at, 20_000)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in slice_rows(batches):
            one = Slice(row, length)
            one.runs()
            shared, hot = np.zeros(len(one.known), bool), np.zeros(len(one.known), bool)
            split = one.parts(parts) if row["marks"] else {}
            for mark in row["marks"] or []:
                where = split[mark["part"]]
                for out, bits in ((shared, mark["shared"]), (hot, mark["hot"])):
                    out[where] = np.unpackbits(np.frombuffer(bits, np.uint8), count=len(where)).astype(bool)
            shared |= np.bincount(one.of, minlength=len(one.known)) > 1
            kept = shared[one.of] | one.again
            wide = kept & hot[one.of]
            kept &= ~wide
            windows = np.repeat(one.first[wide], one.count[wide]) + np.arange(one.count[wide].sum()) - np.repeat(np.cumsum(one.count[wide]) - one.count[wide], one.count[wide])
            first, size = np.r_[one.first[kept], windows], np.r_[one.count[kept] + length - 1, np.full(len(windows), length)]
            kind = np.r_[np.full(kept.sum(), CONTEXT), np.full(len(windows), WINDOW)]
            yield from rows_of(one, kind, first, size, np.r_[one.value[kept], np.zeros(len(windows), np.uint64)])

    return slices.mapInArrow(run, STRETCH_SQL)


def later_windows(found: DataFrame, buckets: int, length: int) -> DataFrame:
    """SPAN rows of what goes of the stretches in ``found``, by one suffix array a bucket."""

    def decide(table: pa.Table) -> pa.Table:
        late, ids, versions, starts, slices, places, sizes = (table[c].to_numpy() for c, _ in PLACE)
        order = np.lexsort((starts, versions, ids, late))
        who = np.c_[late, ids, versions][order]
        document = np.zeros(len(order), np.int64)
        document[order] = np.r_[0, np.cumsum((who[1:] != who[:-1]).any(1))]
        rank = (document << 40) + starts
        digest = np.frombuffer(b"".join(table["digest"].to_pylist()), np.uint64).reshape(-1, 2)
        order = np.lexsort((rank, digest[:, 1], digest[:, 0]))
        fresh = np.r_[True, (digest[order][1:] != digest[order][:-1]).any(1)]
        leader = order[fresh]
        string = np.zeros(len(order), np.int64)
        string[order] = np.cumsum(fresh) - 1
        first = rank == rank[leader][string]
        text = table["text"].combine_chunks().take(pa.array(leader)).to_pylist()
        of, at, group = equal_windows(text, length)
        spans = [(slices[~first], places[~first], starts[~first], starts[~first] + sizes[~first])]
        if len(of):
            key = rank[leader][of] + at
            cuts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
            later = key > np.repeat(np.minimum.reduceat(key, cuts), np.diff(np.r_[cuts, len(key)]))
            of, at = of[later], at[later]
            order = np.lexsort((at, of))
            of, at = of[order], at[order]
            opens = np.r_[True, (of[1:] != of[:-1]) | (at[1:] > at[:-1] + length)][: len(of)]
            closes = np.r_[opens[1:], True][: len(of)]
            begin, stop = at[opens], at[closes] + length
            owner = of[opens]
            for k in np.flatnonzero(first)[np.isin(string[first], owner)].tolist():  # repeated rows share a leader
                low, high = np.searchsorted(owner, [string[k], string[k] + 1])
                spans.append((np.full(high - low, slices[k]), np.full(high - low, places[k]), starts[k] + begin[low:high], starts[k] + stop[low:high]))
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64())
        return pa.table([pa.array(np.concatenate(x), t) for x, t in zip(zip(*spans), kinds, strict=True)], ["slice", "place", "start", "stop"])

    contexts = found.filter(F.col("kind") == CONTEXT).withColumn("bucket", F.pmod(F.xxhash64("value"), F.lit(buckets)))
    names = ["bucket", "digest", "text", *[c for c, _ in PLACE]]
    return contexts.select(*names).groupBy("bucket").applyInArrow(decide, SPAN_SQL)


def later_hot_windows(found: DataFrame) -> DataFrame:
    """SPAN rows of the windows of hot values that are not the earliest; first occurrences are combined before they shuffle."""
    hot = found.filter(F.col("kind") == WINDOW).withColumn("rank", F.struct("late", "id", "version", "start"))
    first = hot.groupBy("digest").agg(F.min("rank").alias("first"))
    later = hot.join(first.hint("merge"), "digest").filter("rank > first")
    return later.select("slice", "place", "start", (F.col("start") + F.col("size")).alias("stop"))


def remove_repeated_substrings(docs: DataFrame, length: int = LENGTH, doc_id: str = "doc_id", text: str = "text", hot_bytes: int = HOT_BYTES) -> DataFrame:
    """(doc_id, n_bytes, kept: the bytes that stay, spans: maximal removed runs as (start, stop) in bytes)."""
    spark, steps = docs.sparkSession, Steps(docs.sparkSession)
    texts = docs.select(F.col(doc_id).cast("long").alias("id"), F.xxhash64(F.col(text).cast("string")).alias("version"), F.col(text).cast("string").alias("text"))
    size = docs.agg(F.sum(F.octet_length(F.col(text).cast("string")))).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), size // PART_BYTES)
    slices = steps.bucketed(pack_slices(texts), "slices", "slice", parts)
    marks = shared_values(slices, parts, length, hot_bytes)
    marks = marks.groupBy("slice").agg(F.collect_list(F.struct("part", "shared", "hot")).alias("marks"))
    found = steps.keep(stretches(slices.join(marks.hint("shuffle_hash"), "slice", "left"), parts, length), "stretches")
    kinds = {r["kind"]: r["bytes"] for r in found.groupBy("kind").agg(F.sum("size").alias("bytes")).collect()}
    spans = found.filter(F.col("kind") == REMOVED).select("slice", "place", "start", (F.col("start") + F.col("size")).alias("stop"))
    if CONTEXT in kinds:
        spans = spans.union(later_windows(found, max(parts, kinds[CONTEXT] // BUCKET_BYTES), length))
    if WINDOW in kinds:
        spans = spans.union(later_hot_windows(found))
    gone = spans.groupBy("slice").agg(F.collect_list(F.struct("place", "start", "stop")).alias("gone"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in slice_rows(batches):
            one = Slice(row, length)
            step = np.zeros(len(one.data) + 1, np.int64)
            if row["gone"]:
                place, start, stop = np.array([tuple(x.values()) for x in row["gone"]], np.int64).T
                step += np.bincount(one.offsets[place] + start, minlength=len(step)) - np.bincount(one.offsets[place] + stop, minlength=len(step))
            removed = np.cumsum(step[:-1]) > 0
            edge = np.zeros(len(removed) + 1, bool)
            edge[one.offsets] = True
            opens = np.flatnonzero(removed & (edge[:-1] | ~np.r_[False, removed[:-1]]))
            closes = np.flatnonzero(removed & (edge[1:] | ~np.r_[removed[1:], False])) + 1
            owner = np.searchsorted(one.offsets, opens, "right") - 1
            kept = np.r_[0, np.cumsum(~removed)][one.offsets].astype(np.int32)
            pairs = pa.StructArray.from_arrays([pa.array(x - one.offsets[owner], pa.int64()) for x in (opens, closes)], ["start", "stop"])
            columns = [
                pa.array(one.ids, mask=one.late),
                pa.array(np.diff(one.offsets), pa.int64()),
                pa.Array.from_buffers(pa.binary(), len(one.ids), [None, pa.py_buffer(kept), pa.py_buffer(one.data[~removed])]),
                pa.ListArray.from_arrays(pa.array(np.searchsorted(owner, np.arange(len(one.ids) + 1)), pa.int32()), pairs),
            ]
            yield pa.record_batch(columns, ["id", "n_bytes", "kept", "spans"])

    out = slices.join(gone.hint("shuffle_hash"), "slice", "left").mapInArrow(cut, "id long, n_bytes long, kept binary, spans array<struct<start:long,stop:long>>")
    return out.withColumnRenamed("id", doc_id)
