"""Toxicity by two Kneser-Ney models: how much likelier the toxic texts' model finds a text than the ordinary texts' model.

Both are interpolated Kneser-Ney models over the bytes of lower-cased words, of order ``ORDER`` with the word's start and end as
bytes, so that an expression never met before is judged by the pieces it is made of. Their top order has counts of each class
(those of the larger class scaled down to the smaller, so that neither is surer for its size alone). What absolute
discounting sets free goes to backoff counts that both classes share: the same order over both classes, then continuation counts of
the last four bytes, then of the single byte. Rare expressions thus score alike in both, and only what one class says much more often counts.

For a gram, the difference of the log-likelihoods is a fixed number, and for a gram never met it depends on its context alone, as the
shared part cancels. So the model is a table: gram -> difference, context -> difference. They are counted over all given labelled
rows by Spark; kept is every gram in ``LEAST`` or more texts of either class, at any size of the corpus, and every context of such a gram.

The table is written and never sent whole. Texts are packed into slices: their distinct words once, and for each text which of
them it has, how often. ``toxicity_of`` packs once, for training and scoring, into a table bucketed by slice. A slice asks for the values of its
distinct grams and contexts by a join, and what it gets back is bounded by the slice. Labels come to the slices in the same way, so neither
texts nor slices are shuffled.

The length-normalised difference of a text, the strongest word's, and the summed excess of strong words go through a logistic function
fitted on a bounded sample (``SAMPLE`` labelled rows by a hash of the id), which gives the score from 0 to 1. It is fitted on texts of
one half, as models of the other half see them, so that it knows what evidence from texts not counted looks like.
The length-normalised difference alone does not suffice: a few toxic words hardly move the mean of a long text (held-out accuracy on 990 labels 0.897,
with the strong words 0.970).

Nulls, empty texts and texts without words have no evidence and score as such. NULL labels and labels of unknown documents are passed over; of
several labels of an id the largest counts. Rows that repeat an id are each counted; in the sample an id with one text stands once. If only one class is labelled, every score is the smoothed share of toxic labels.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farebox.llm.buffers import SLICE_BYTES, lower_ascii, pieces_of, slices, span_hashes, text_bytes, token_spans
from farebox.llm.scratch import Steps

ORDER = 6
DISCOUNT = 0.75
LEAST = 3
SAMPLE = 20_000
LEVELS = (2.0, 4.0)
END = 0x20
SLICE_TEXT = 48 << 20
WORDS_AT_ONCE = 1 << 15
SLICE_WORDS = 4 << 20  # bytes of a slice, all its texts and its distinct words


@dataclass
class ToxicModel:
    values: DataFrame | None  # (key, value): a gram, or -1 - context; None if nothing tells the classes apart
    weights: np.ndarray


def distinct_words(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first place of every distinct word, and for each word the number of its distinct one."""
    _, first, which = np.unique(span_hashes(data, starts, lengths), return_index=True, return_inverse=True)
    return first, which


def word_grams(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For all words the grams at every byte and at their end, the newest byte lowest, and the word of each."""
    sizes = lengths + 1
    word = np.repeat(np.arange(len(starts)), sizes)
    place = np.arange(len(word)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    padded = np.r_[data, np.uint8(END)]
    key = np.zeros(len(word), np.int64)
    for back in range(ORDER):
        at = place - back
        byte = np.where(at == lengths[word], END, padded[np.minimum(starts[word] + np.maximum(at, 0), len(data))]).astype(np.int64)
        key |= np.where(at >= 0, byte, 0) << (8 * back)
    return key, word


def words_of(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For slices of a batch: first and last row, bytes, and start, length and row of each word."""
    data, offsets = text_bytes(column)
    for start, stop in slices(offsets):
        part, at = lower_ascii(data[offsets[start] : offsets[stop]]), offsets[start : stop + 1] - offsets[start]
        starts, lengths, owner = token_spans(part, at)
        letters = (part[starts] >= 0x80) | ((part[starts] >= 97) & (part[starts] <= 122)) | ((part[starts] >= 48) & (part[starts] <= 57))
        yield start, stop, part, starts[letters], lengths[letters], owner[letters]


def words_in(column: pa.Array) -> Iterator[tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]]:
    """Distinct words of slices of a batch, and for each text and distinct word of it the text, the word and its times."""
    for start, _, part, starts, lengths, owner in words_of(column):
        if len(starts):
            first, which = distinct_words(part, starts, lengths)
            pairs, times = np.unique(owner * len(first) + which, return_counts=True)
            raw = part.tobytes()
            words = [raw[i : i + n] for i, n in zip(starts[first].tolist(), lengths[first].tolist(), strict=True)]
            yield words, pairs // len(first) + start, pairs % len(first), times


def packed(found: list[tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]]) -> tuple[bytes, bytes]:
    """The distinct words of several pieces, the most frequent first, each with an END; and texts, words and times as compressed Arrow."""
    table: dict[bytes, int] = {}
    places = [np.array([table.setdefault(w, len(table)) for w in words], np.int64)[which] for words, _, which, _ in found]
    rows, which, times = (np.concatenate([np.zeros(0, np.int64), *x]) for x in ([x[1] for x in found], places, [x[3] for x in found]))
    order = np.argsort(-np.bincount(which, minlength=len(table)), kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    words = list(table)
    pairs = pa.record_batch([pa.array(x, pa.int32()) for x in (rows, rank[which], times)], ["row", "word", "times"])
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, pairs.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(pairs)
    return b"".join(words[i] + bytes([END]) for i in order), sink.getvalue().to_pybytes()


def unpacked(pairs: bytes) -> list[np.ndarray]:
    return [x.to_numpy().astype(np.int64) for x in pa.ipc.open_stream(pairs).read_all().columns]


def vocabulary_grams(vocabulary: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The grams of all words, the word of each, and the words' lengths."""
    data = np.frombuffer(vocabulary, np.uint8)
    stops = np.flatnonzero(data == END)
    starts = np.r_[0, stops[:-1] + 1].astype(np.int64)[: len(stops)]
    return *word_grams(data, starts, stops - starts), stops - starts


def distinct_grams(vocabulary: bytes) -> np.ndarray:
    """The grams of all words, each once; those of ``WORDS_AT_ONCE`` words are made at a time."""
    data = np.frombuffer(vocabulary, np.uint8)
    stops = np.flatnonzero(data == END)
    starts = np.r_[0, stops[:-1] + 1].astype(np.int64)[: len(stops)]
    found = [np.zeros(0, np.int64)]
    for first in range(0, len(stops), WORDS_AT_ONCE):
        part = slice(first, first + WORDS_AT_ONCE)
        low, high = starts[part][0], stops[part][-1]
        found.append(np.unique(word_grams(data[low:high], starts[part] - low, stops[part] - starts[part])[0]))
    return np.unique(np.concatenate(found))


def packed_texts(docs: DataFrame, keep: tuple[str, ...], text: str = "text") -> DataFrame:
    """Slices of texts: (slice, rows: place and ``keep`` columns as c0, c1..., vocabulary, pairs)."""
    row = T.StructType([T.StructField("place", T.IntegerType()), *[T.StructField(f"c{i}", docs.schema[c].dataType) for i, c in enumerate(keep)]])
    kinds = [("slice", T.LongType()), ("rows", T.ArrayType(row)), ("vocabulary", T.BinaryType()), ("pairs", T.BinaryType())]
    schema = T.StructType([T.StructField(*x) for x in kinds])

    def pack(held: list[list[pa.Array]], found: list, rows: int) -> pa.RecordBatch:
        columns = [pa.array(np.arange(rows), pa.int32()), *[pa.concat_arrays(x) for x in zip(*held, strict=True)]]
        vocabulary, pairs = packed(found)
        held_rows = pa.ListArray.from_arrays(pa.array([0, rows], pa.int32()), pa.StructArray.from_arrays(columns, row.names))
        values = [pa.array([uuid.uuid4().int >> 65], pa.int64()), held_rows, pa.array([vocabulary], pa.binary()), pa.array([pairs], pa.binary())]
        return pa.record_batch(values, schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, found, rows, texts, words = [], [], 0, 0, 0
        for batch in batches:
            for piece in pieces_of(batch, len(keep), SLICE_BYTES):
                for some, row_of, which, times in words_in(piece.column(len(keep))):
                    found.append((some, row_of + rows, which, times))
                    words += sum(map(len, some))
                held.append(piece.columns[: len(keep)])
                rows, texts = rows + len(piece), texts + len(text_bytes(piece.column(len(keep)))[0])
                if texts >= SLICE_TEXT or words >= SLICE_WORDS:
                    yield pack(held, found, rows)
                    held, found, rows, texts, words = [], [], 0, 0, 0
        if rows:
            yield pack(held, found, rows)

    return docs.select(*keep, F.col(text).cast("string").alias("__text")).mapInArrow(run, schema)


def packed_table(docs: DataFrame, keep: tuple[str, ...], steps: Steps, text: str = "text") -> DataFrame:
    """``packed_texts`` as a written table, in buckets by slice, so that what is joined to slices moves and they don't."""
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return steps.bucketed(packed_texts(docs, keep, text), "texts", "slice", buckets)


def gram_counts(texts: DataFrame, known: DataFrame) -> DataFrame:
    """(gram, toxic, ordinary, toxic0, ordinary0) over all rows of ``texts`` (packed, their id first) that are ``known`` (__id, label, half), and over half 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for vocabulary, pairs, marks in zip(*batch.columns, strict=True):
                place, kind = (x.to_numpy().astype(np.int64) for x in marks.values.flatten())
                key, word, lengths = vocabulary_grams(vocabulary.as_py())
                row, which, _ = unpacked(pairs.as_py())  # a word counts once in a text, however often it is repeated
                kinds = np.full(max(row.max(initial=-1), place.max(initial=-1)) + 1, -1)
                kinds[place] = kind
                grams, at = np.unique(key, return_inverse=True)
                sums = [np.bincount(at, np.bincount(which[kinds[row] == k], minlength=len(lengths))[word], minlength=len(grams)).astype(np.int64) for k in range(4)]
                met = np.add.reduce(sums) > 0
                yield pa.record_batch([pa.array(x[met], pa.int64()) for x in (grams, *sums)], ["gram", "o0", "t0", "o1", "t1"])

    who = texts.select("slice", F.explode("rows").alias("x")).select("slice", F.col("x.place").alias("place"), F.col("x.c0").alias("__id"))
    # Ids meet their labels by a shuffle at any size, as labels grow with the corpus.
    kind = (2 * F.col("half") + F.col("label")).cast("int").alias("kind")
    labelled = who.join(known.select("__id", "label", "half").hint("merge"), "__id").select("slice", "place", kind)
    marks = labelled.groupBy("slice").agg(F.collect_list(F.struct("place", "kind")).alias("marks"))
    told = texts.select("slice", "vocabulary", "pairs").join(marks.hint("shuffle_hash"), "slice").drop("slice")
    sent = told.mapInArrow(run, "gram long, o0 long, t0 long, o1 long, t1 long")
    total = sent.groupBy("gram").agg(*[F.sum(c).alias(c) for c in ("o0", "t0", "o1", "t1")])
    both = [(F.col(f"{c}0") + F.col(f"{c}1")).alias(name) for c, name in (("t", "toxic"), ("o", "ordinary"))]
    return total.select("gram", *both, F.col("t0").alias("toxic0"), F.col("o0").alias("ordinary0"))


def differences(counts: DataFrame, toxic: int, ordinary: int) -> tuple[DataFrame, DataFrame]:
    """(gram, value) and (context, value): log-likelihood under the toxic model less that under the ordinary one."""
    least = min(toxic, ordinary)
    t, o = F.col("toxic") * (least / toxic), F.col("ordinary") * (least / ordinary)
    scaled = counts.select("gram", t.alias("t"), o.alias("o"), (t + o).alias("p"), F.shiftright("gram", 8).alias("context"), "toxic", "ordinary")
    discounted = [F.sum(F.least(F.col(c), F.lit(DISCOUNT))).alias(f"free_{c}") for c in "top"]
    contexts = scaled.groupBy("context").agg(*[F.sum(c).alias(f"all_{c}") for c in "top"], *discounted)
    short = scaled.groupBy(F.col("gram").bitwiseAND(0xFFFFFFFF).alias("short")).agg(F.count("*").alias("n"))
    single = short.groupBy(F.col("short").bitwiseAND(0xFF).alias("byte")).agg(F.sum("n").alias("n1"))
    before = short.groupBy(F.shiftright("short", 8).alias("c3")).agg(F.sum("n").alias("n3"), F.count("*").alias("kinds"))
    kept = scaled.filter((F.col("toxic") >= LEAST) | (F.col("ordinary") >= LEAST))
    kept = kept.withColumn("short", F.col("gram").bitwiseAND(0xFFFFFFFF))
    kept = kept.withColumn("c3", F.shiftright("short", 8)).withColumn("byte", F.col("gram").bitwiseAND(0xFF))
    joined = kept.join(contexts, "context").join(short, "short").join(before, "c3").join(F.broadcast(single), "byte")
    lowest = F.col("n1") / counts.count()
    middle = (F.greatest(F.col("n") - DISCOUNT, F.lit(0.0)) + DISCOUNT * F.col("kinds") * lowest) / F.col("n3")
    shared = (F.greatest(F.col("p") - DISCOUNT, F.lit(0.0)) + F.col("free_p") * F.col("middle")) / F.col("all_p")

    def likelihood(c: str):
        seen = (F.greatest(F.col(c) - DISCOUNT, F.lit(0.0)) + F.col(f"free_{c}") * F.col("shared")) / F.col(f"all_{c}")
        return F.when(F.col(f"all_{c}") > 0, seen).otherwise(F.col("shared"))

    def backoff(c: str):
        return F.when(F.col(f"all_{c}") > 0, F.col(f"free_{c}") / F.col(f"all_{c}")).otherwise(1.0)

    values = joined.withColumn("middle", middle).withColumn("shared", shared)
    values = values.select("gram", "context", F.log(likelihood("t") / likelihood("o")).alias("value"))
    used = contexts.join(kept.select("context").distinct(), "context", "left_semi")
    return values.select("gram", "value"), used.select("context", F.log(backoff("t") / backoff("o")).alias("value"))


def looked_up(keys: np.ndarray, table: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(table):
        return np.zeros(len(keys), bool), np.zeros(len(keys))
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    found = table[at] == keys
    return found, np.where(found, values[at], 0.0)


def word_values(vocabulary: bytes, keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The summed differences of every word's grams, and the words' lengths; the grams of ``WORDS_AT_ONCE`` words are held at a time."""
    data = np.frombuffer(vocabulary, np.uint8)
    stops = np.flatnonzero(data == END)
    starts = np.r_[0, stops[:-1] + 1].astype(np.int64)[: len(stops)]
    lengths, own = stops - starts, np.zeros(len(stops))
    for first in range(0, len(stops), WORDS_AT_ONCE):
        part = slice(first, first + WORDS_AT_ONCE)
        low, high = starts[part][0], stops[part][-1]
        key, word = word_grams(data[low:high], starts[part] - low, lengths[part])
        known, value = looked_up(key, keys, values)
        rest = ~known
        value[rest] = looked_up(-1 - (key[rest] >> 8), keys, values)[1]
        own[part] = np.bincount(word, value, minlength=len(lengths[part]))
    return own, lengths


def evidence(vocabulary: bytes, pairs: bytes, rows: int, keys: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Per text of a slice: the strongest word's difference, summed excess over LEVELS, and the mean difference of a byte."""
    out = np.zeros((rows, 2 + len(LEVELS)))
    row, which, times = unpacked(pairs)
    if not len(row):
        return out
    own, lengths = word_values(vocabulary, keys, values)
    own = own[which]
    strongest = np.zeros(rows)
    np.maximum.at(strongest, row, own)
    out[:, 0] = strongest / 4
    for k, level in enumerate(LEVELS):
        out[:, 1 + k] = np.log1p(np.bincount(row, times * np.maximum(own - level, 0), minlength=rows))
    size = np.bincount(row, times * (lengths[which] + 1), minlength=rows)
    out[:, -1] = np.clip(np.bincount(row, times * own, minlength=rows) / np.maximum(size, 1) * 10, -5, 5)
    return out


def logistic(x: np.ndarray, y: np.ndarray, rounds: int = 30, ridge: float = 1e-2) -> np.ndarray:
    """Weights, the intercept last, by Newton steps."""
    x = np.c_[x, np.ones(len(x))]
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) + ridge * w
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), slope)
        w = w - np.clip(step, -5, 5)
    return w


def values_of(counts: DataFrame, toxic: int, ordinary: int) -> DataFrame:
    """(key, value) of all kept grams and, as -1 - context, of their contexts."""
    grams, contexts = differences(counts, toxic, ordinary)
    return grams.withColumnRenamed("gram", "key").union(contexts.select((-1 - F.col("context")).alias("key"), "value"))


def train_toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic", packed: DataFrame | None = None) -> ToxicModel:
    """The model of all labelled rows: ``docs`` (doc_id, text), ``labels`` (doc_id, and 0 or 1 in ``label``); ``packed`` holds the same rows, their id first."""
    steps = Steps(docs.sparkSession)
    place = F.xxhash64(F.col("__id").cast("string"))
    known = labels.filter(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull())
    known = known.groupBy(F.col("doc_id").alias("__id")).agg(F.max(label).cast("double").alias("label"))
    known = steps.keep(known.withColumn("place", place).withColumn("half", F.pmod("place", F.lit(2)).cast("double")), "known")
    texts = docs.select(F.col("doc_id").alias("__id"), F.col("text").cast("string").alias("text"))
    own = packed_table(texts.join(known.select("__id"), "__id", "left_semi"), ("__id",), steps) if packed is None else packed
    counts = steps.keep(gram_counts(own, known), "counts")
    if packed is None:
        steps.drop("texts")
    totals = [x or 0 for x in counts.agg(*[F.sum(c) for c in ("toxic", "ordinary", "toxic0", "ordinary0")]).first()]
    plain = np.zeros(3 + len(LEVELS))
    if not all(totals):
        times, share = known.agg(F.count("*"), F.sum("label")).first()
        share = ((share or 0) + 0.5) / (times + 1)
        plain[-1] = np.log(share / (1 - share))
        return ToxicModel(None, plain)
    first = counts.filter("toxic0 + ordinary0 > 0").select("gram", F.col("toxic0").alias("toxic"), F.col("ordinary0").alias("ordinary"))
    drawn = known.filter("half = 1").select("__id", "label", "place").orderBy("place", "__id").limit(SAMPLE)
    half = steps.keep(values_of(first, *totals[2:]), "half")
    met = texts.join(F.broadcast(drawn), "__id").withColumn("tie", F.xxhash64("text"))
    seen = evidence_rows(packed_table(met, ("label", "place", "tie"), Steps(docs.sparkSession)), half, met, ("label", "place", "tie"))
    once = seen.groupBy("place", "tie").agg(F.first("label").alias("label"), F.first("evidence").alias("evidence"))
    rows = once.orderBy("place", "tie").limit(SAMPLE).toArrow()  # SAMPLE rows of a few numbers
    x = np.array(rows.column("evidence").to_pylist()).reshape(-1, len(plain) - 1)
    weights = logistic(x, rows.column("label").to_numpy())
    steps.drop("half")
    values = steps.keep(values_of(counts, *totals[:2]), "values")
    steps.drop("counts")
    return ToxicModel(values, weights)


def evidence_rows(packed: DataFrame, values: DataFrame, docs: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    """The ``keep`` columns of every row of ``packed`` (made of ``docs``) and the ``evidence`` of its text."""
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField("evidence", T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, vocabulary, pairs, told, values_told in zip(*batch.columns, strict=True):
                keys, value = np.frombuffer(told.as_py() or b"", np.int64), np.frombuffer(values_told.as_py() or b"", np.float32).astype(np.float64)
                found = evidence(vocabulary.as_py(), pairs.as_py(), len(rows.values), keys, value)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(found) + 1) * found.shape[1], pa.int32()), pa.array(found.ravel()))
                yield pa.record_batch([*rows.values.flatten()[1:], lists], [*keep, "evidence"])

    def gather(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        keys, value = table["key"].to_numpy(), table["value"].to_numpy()
        order = np.argsort(keys, kind="stable")
        cells = [[key[0].as_py()], [keys[order].tobytes()], [value[order].tobytes()]]
        return pa.table([pa.array(x, t) for x, t in zip(cells, (pa.int64(), pa.binary(), pa.binary()), strict=True)], ["slice", "told", "values"])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, vocabulary in zip(*batch.columns, strict=True):
                grams = distinct_grams(vocabulary.as_py())
                keys = np.r_[grams, -1 - np.unique(grams >> 8)]
                for first in range(0, len(keys), 100_000):
                    part = pa.array(keys[first : first + 100_000], pa.int64())
                    yield pa.record_batch([pa.array([number.as_py()] * len(part), pa.int64()), part], ["slice", "key"])

    wanted = packed.select("slice", "vocabulary").mapInArrow(ask, "slice long, key long")
    asked = wanted.join(values.hint("merge"), "key").select("slice", "key", F.col("value").cast("float").alias("value"))
    told = asked.groupBy("slice").applyInArrow(gather, "slice long, told binary, values binary")
    return packed.select("slice", "rows", "vocabulary", "pairs").join(told.hint("shuffle_hash"), "slice", "left").drop("slice").mapInArrow(run, schema)


def score_toxicity(docs: DataFrame, model: ToxicModel, keep: tuple[str, ...] = ("doc_id",), score: str = "score", packed: DataFrame | None = None) -> DataFrame:
    """The ``keep`` columns of every row, and the ``score`` of its whole text; ``packed`` holds the same rows with these columns."""
    keep = tuple(c for c in keep if c not in (score, "evidence"))
    if model.values is None:
        return docs.select(*keep, F.lit(float(1 / (1 + np.exp(-model.weights[-1])))).alias(score))
    packed = packed_table(docs, keep, Steps(docs.sparkSession)) if packed is None else packed
    rows = evidence_rows(packed, model.values, docs, keep)
    total = sum((F.get("evidence", F.lit(i)) * float(w) for i, w in enumerate(model.weights[:-1])), F.lit(float(model.weights[-1])))
    return rows.select(*keep, (1 / (1 + F.exp(-total))).alias(score))


def toxicity_of(docs: DataFrame, labels: DataFrame, score: str = "score") -> DataFrame:
    """(doc_id, score) of all ``docs``, trained on ``labels``; texts are packed once for both."""
    packed = packed_table(docs, ("doc_id",), Steps(docs.sparkSession))
    return score_toxicity(docs, train_toxicity(docs, labels, packed=packed), ("doc_id",), score, packed)
