"""Ranked lexical search turned round: the items are the index, the documents are what streams through it.

Terms are the maximal runs of ASCII letters and digits and of all characters beyond ASCII, with A-Z lower-cased. A document scores
for an item the sum, over the item's terms with repeats, of ``w * ((1000000000 * tf) div (1000 * tf + 12 * m))``, all in 64-bit integers; ``w`` falls with the
number of documents that hold the term, ``m`` rises with the document's length (see ``Corpus``). The ``k`` best documents above 0 are
returned for every item, equal scores by ascending id.

1. Items are dealt by a hash to packs of about ``PACK_BYTES`` of text, as many as their measured size asks for. One pack at a time
   goes through the driver, and its inverted index (term -> items) is broadcast; so what is broadcast is bounded, whatever the number of items.
2. One pass over the documents takes from each whole text its length and how often it holds each term of the pack; these counts are
   written. Document frequencies are summed from them, in the tasks first.
3. The counts stream through the index. Every task keeps a heap of ``k`` documents per item, whose lowest score is the bar for the next ones.
4. The heaps are merged, first those of one slot (a hash of the document), then the slots, so no task meets the heaps of all tasks.

Nulls: a NULL text has no term; an item without terms, or with terms that no document holds, gets no row. NULL document ids rank last among
equals. Repeated rows of ``docs`` are documents of their own; equal (id, text) rows of ``items`` are one item, and different texts
under one id are ranked each for itself. Other columns are not read. Weights are computed in doubles; where a
document's length times the corpus would leave 64 bits, or a sum the exact doubles, plain integers are used.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import floor, log

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farebox.llm.buffers import lower_ascii, slices, text_bytes
from farebox.llm.scratch import Steps

BEST = 20
PACK_BYTES = 16 << 20
CELLS = 1 << 21  # scores that a task holds at once
SLOTS = 64
_TERM = np.ones(256, bool)
_TERM[:128] = False
_TERM[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True


def terms_in(column: pa.Array) -> Iterator[tuple[int, int, pa.Array, np.ndarray]]:
    """For slices of a batch: first and last row, every term in order as lower-cased UTF-8, and the row of each."""
    data, offsets = text_bytes(column)
    for start, stop in slices(offsets):
        part, at = lower_ascii(data[offsets[start] : offsets[stop]]), offsets[start : stop + 1] - offsets[start]
        inside = _TERM[part]
        opens = inside.copy()
        opens[1:] &= ~inside[:-1]
        firsts = at[:-1][at[:-1] < len(part)]
        opens[firsts] = inside[firsts]  # a term ends with its text
        begins = np.flatnonzero(opens)
        before = np.r_[0, np.cumsum(inside)]
        bounds = np.r_[before[begins], before[-1]].astype(np.int64)
        terms = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(begins), [None, pa.py_buffer(bounds), pa.py_buffer(part[inside])])
        yield start, stop, terms, np.searchsorted(at, begins, "right") - 1


@dataclass
class ItemIndex:
    """Terms of a pack of items, and for each term the items that hold it and how often."""

    ids: pa.Array
    terms: pa.Array
    first: np.ndarray
    items: np.ndarray
    times: np.ndarray


def index_items(ids: pa.Array, texts: pa.Array) -> ItemIndex:
    found = list(terms_in(texts))
    whole = pa.chunked_array([x[2] for x in found], pa.large_binary()).combine_chunks().dictionary_encode()
    owner = np.concatenate([np.zeros(0, np.int64), *[rows + start for start, _, _, rows in found]])
    term = whole.indices.to_numpy().astype(np.int64)
    pairs, times = np.unique(term * max(len(ids), 1) + owner, return_counts=True)
    first = np.searchsorted(pairs, np.arange(len(whole.dictionary) + 1) * max(len(ids), 1))
    return ItemIndex(ids, whole.dictionary, first, pairs % max(len(ids), 1), times)


@dataclass
class Corpus:
    """What scores need of all documents: how many have terms, how many terms, and each indexed term's weight."""

    documents: int
    terms: int
    weights: np.ndarray

    @staticmethod
    def of(documents: int, terms: int, holding: np.ndarray) -> Corpus:
        return Corpus(documents, terms, np.array([floor(1000 * log((2 * documents + 2) / (2 * df + 1))) for df in holding.tolist()], np.int64))

    def m(self, lengths: np.ndarray) -> np.ndarray:
        if 25 * int(lengths.max(initial=0)) * self.documents < 1 << 63:
            return 75 + 25 * lengths * self.documents // max(self.terms, 1)
        return np.array([75 + 25 * n * self.documents // max(self.terms, 1) for n in lengths.tolist()], np.int64)


class Heaps:
    """The ``k`` best documents of each item, by score and then id, NULL ids last."""

    def __init__(self, items: int, k: int):
        self.k, self.bar = k, np.ones(items, np.int64)
        self.held = [np.zeros((0, 4), np.int64)]  # item, score, whether the id is NULL, id
        self.most, self.rows = max(CELLS // 2, 2 * k * items), 0

    def offer(self, item: np.ndarray, score: np.ndarray, missing: np.ndarray, doc: np.ndarray) -> None:
        self.held.append(np.column_stack([item, score, missing, doc]))
        self.rows += len(item)
        if self.rows > self.most:
            self.trim()

    def trim(self) -> np.ndarray:
        rows = np.concatenate(self.held)
        rows = rows[np.lexsort((rows[:, 3], rows[:, 2], -rows[:, 1], rows[:, 0]))]
        begins = np.searchsorted(rows[:, 0], np.arange(len(self.bar)))
        place = np.arange(len(rows)) - begins[rows[:, 0]]
        last = place == self.k - 1
        self.bar[rows[last, 0]] = rows[last, 1]
        self.held, self.rows = [rows[place < self.k]], 0
        return self.held[0]


def score_counts(index: ItemIndex, corpus: Corpus, heaps: Heaps, batch: pa.RecordBatch) -> None:
    """Streams documents (id, length, terms, times) through the index into the heaps."""
    lengths = batch.column(1).to_numpy()
    ids, missing = batch.column(0).fill_null(0).to_numpy(), batch.column(0).is_null().to_numpy(zero_copy_only=False)
    sizes = pc.binary_length(batch.column(2)).to_numpy() // 4
    term = np.frombuffer(b"".join(batch.column(2).to_pylist()), "<i4").astype(np.int64)
    tf = np.frombuffer(b"".join(batch.column(3).to_pylist()), "<i4").astype(np.int64)
    part = corpus.weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 12 * np.repeat(corpus.m(lengths), sizes)))
    width = len(heaps.bar)
    fan = index.first[term + 1] - index.first[term]
    at = np.r_[0, np.cumsum(sizes)]
    load = np.cumsum(np.r_[0, np.add.reduceat(np.r_[fan, 0], at[:-1]) * (sizes > 0) + width]) if len(sizes) else np.zeros(1, np.int64)
    exact = int(corpus.weights.max(initial=0)) * 1_000_000 * int(index.times.sum()) < 1 << 52
    for start, stop in slices(load, CELLS):
        low, high = at[start], at[stop]
        each = fan[low:high]
        place = np.repeat(index.first[term[low:high]] - (np.cumsum(each) - each), each) + np.arange(each.sum())
        cell = np.repeat(np.repeat(np.arange(stop - start), sizes[start:stop]), each) * width + index.items[place]
        gain = np.repeat(part[low:high], each) * index.times[place]
        if exact:
            total = np.bincount(cell, gain, minlength=(stop - start) * width).astype(np.int64)
        else:
            total = np.zeros((stop - start) * width, np.int64)
            np.add.at(total, cell, gain)
        good = np.flatnonzero(total >= np.tile(heaps.bar, stop - start))
        doc = start + good // width
        heaps.offer(good % width, total[good], missing[doc], ids[doc])


def search_documents(docs: DataFrame, items: DataFrame, k: int = BEST, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text", pack_bytes: int = PACK_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best of ``docs`` for each of ``items``."""
    steps, kind = Steps(docs.sparkSession), items.schema[item_id].dataType
    asked = items.select(F.col(item_id).alias("item_id"), F.col(text).cast("string").alias("text")).filter(F.length("text") > 0).distinct()
    packs = -(-(asked.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 1) // pack_bytes)
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    heaps = [search_pack(texts, asked.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(packs)) == n), steps, n, k, kind) for n in range(packs)]
    held = heaps[0]
    for more in heaps[1:]:
        held = held.union(more)

    def best(df: DataFrame, *group: str) -> DataFrame:
        order = Window.partitionBy("pack", "item", *group).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        return df.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)

    merged = best(best(held.withColumn("slot", F.pmod(F.xxhash64("doc_id"), F.lit(SLOTS))), "slot").drop("rank"))
    return merged.select(F.col("item_id").alias(item_id), "rank", F.col("doc_id").alias(doc_id), "score")


def search_pack(texts: DataFrame, asked: DataFrame, steps: Steps, number: int, k: int, kind: T.DataType) -> DataFrame:
    """(pack, item, item_id, doc_id, score): the heaps of all tasks for one pack of items."""
    spark = texts.sparkSession
    rows = asked.toArrow()  # a pack, so bounded
    index = index_items(rows.column("item_id").combine_chunks(), rows.column("text").combine_chunks())
    sent = spark.sparkContext.broadcast(index)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value.terms
        for batch in batches:
            for start, stop, terms, owner in terms_in(batch.column(1)):
                lengths = np.bincount(owner, minlength=stop - start)
                term = pc.index_in(terms, value_set=known)
                met = term.is_valid().to_numpy(zero_copy_only=False)
                pairs, times = np.unique(owner[met] * max(len(known), 1) + term.drop_null().to_numpy(), return_counts=True)
                cuts = pa.py_buffer((4 * np.searchsorted(pairs, np.arange(stop - start + 1) * max(len(known), 1))).astype(np.int32))
                lists = [pa.Array.from_buffers(pa.binary(), stop - start, [None, cuts, pa.py_buffer(x.astype("<i4"))]) for x in (pairs % max(len(known), 1), times)]
                yield pa.record_batch([batch.column(0).slice(start, stop - start), pa.array(lengths, pa.int64()), *lists], ["doc_id", "n", "terms", "times"]).filter(pa.array(lengths > 0))

    counts = steps.keep(texts.mapInArrow(count, "doc_id long, n long, terms binary, times binary"), f"counts-{number}")

    def holding(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(sent.value.terms), np.int64)
        for batch in batches:
            total += np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), "<i4"), minlength=len(total))
        met = np.flatnonzero(total)
        yield pa.record_batch([pa.array(met, pa.int64()), pa.array(total[met], pa.int64())], ["term", "df"])

    whole = counts.agg(F.count("*").alias("documents"), F.sum("n").alias("terms")).first()
    sums = counts.select("terms").mapInArrow(holding, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).toArrow()
    found = np.zeros(len(index.terms), np.int64)
    found[sums.column("term").to_numpy()] = sums.column("df").to_numpy()
    corpus = spark.sparkContext.broadcast(Corpus.of(whole["documents"], whole["terms"] or 0, found))
    schema = T.StructType([T.StructField("pack", T.IntegerType()), T.StructField("item", T.LongType()), T.StructField("item_id", kind), T.StructField("doc_id", T.LongType()), T.StructField("score", T.LongType())])

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, heaps = sent.value, Heaps(len(sent.value.ids), k)
        for batch in batches:
            score_counts(index, corpus.value, heaps, batch)
        best = heaps.trim()
        columns = [pa.array(np.full(len(best), number), pa.int32()), pa.array(best[:, 0]), index.ids.take(pa.array(best[:, 0])), pa.array(best[:, 3], mask=best[:, 2] > 0), pa.array(best[:, 1])]
        yield pa.record_batch(columns, schema.names)

    return counts.mapInArrow(stream, schema)


LEXICAL_SQL = r"""
WITH cut AS (
  SELECT row_number() OVER () AS place, doc_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS words
  FROM documents),
docs AS (SELECT * FROM cut WHERE len(words) > 0),
whole AS (SELECT count(*)::BIGINT AS n_docs, sum(len(words))::BIGINT AS n_terms FROM docs),
counts AS (
  SELECT place, doc_id, n, term, count(*)::BIGINT AS tf
  FROM (SELECT place, doc_id, len(words)::BIGINT AS n, unnest(words) AS term FROM docs) GROUP BY place, doc_id, n, term),
asked AS (
  SELECT item_id, text, term, count(*)::BIGINT AS times
  FROM (SELECT item_id, text, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
        FROM (SELECT DISTINCT item_id, text FROM benchmark)) GROUP BY item_id, text, term),
weights AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM counts, whole GROUP BY term, n_docs),
scores AS (
  SELECT a.item_id, a.text, c.place, c.doc_id,
         sum(a.times * w.w * ((1000000000 * c.tf) // (1000 * c.tf + 12 * (75 + (25 * c.n * n_docs) // n_terms))))::BIGINT AS score
  FROM asked a JOIN counts c USING (term) JOIN weights w USING (term), whole GROUP BY a.item_id, a.text, c.place, c.doc_id),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
"""
