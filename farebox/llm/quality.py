"""Quality classifier: logistic regression on hashed word n-grams, trained by follow-the-regularised-leader updates.

A text is cut into words and runs of other signs. Its features are hashes of single tokens, of pairs of tokens, and of
runs of one to three token shapes (length, capitals, digits), each counted and divided by the number of tokens; a token
that repeats the one before it counts as a repeat mark, so that pairs see repetition of words never met before. The
score is the logistic function of the sparse dot product with one weight per hash slot, so it lies between 0 and 1.

Training walks ``passes`` times through a bounded, documented sample of labelled texts (``sample`` rows, chosen and ordered by
a hash of the id and of the text; an id that is repeated with one text counts once) in one task, with the per-coordinate updates of
FTRL-proximal. Features of the sample are made in parallel before.
Weights have ``2 ** bits`` slots, so the model that scoring tasks receive has a fixed size.

Nulls and texts without tokens score by the intercept alone. Null labels and labels of unknown documents are passed over;
of several labels of one id the largest counts. Without any labels every score is 0.5. Repeated rows are scored each.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farebox.llm.buffers import by_text, mix, run_hashes, slices, span_hashes, text_bytes, token_spans

SLICE = 1 << 20  # bytes of text whose features a task holds at once
_REPEAT = np.uint64(0x51)
_LOWER, _UPPER, _DIGIT = np.zeros((3, 256), np.int64)
_LOWER[97:123] = _UPPER[65:91] = _DIGIT[48:58] = 1


@dataclass(frozen=True)
class QualitySettings:
    bits: int = 20
    sample: int = 12_000
    passes: int = 4
    alpha: float = 1.0
    beta: float = 1.0
    l1: float = 1e-4
    l2: float = 1e-4


def shapes(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A small number for each token's look: which kinds of characters it holds, and its length up to 15."""
    totals = [np.r_[0, np.cumsum(kind[data])] for kind in (_LOWER, _UPPER, _DIGIT)]
    lower, upper, digit = (t[starts + lengths] - t[starts] for t in totals)
    first = _UPPER[data[starts]]
    sign = (lower + upper + digit == 0) * data[starts].astype(np.int64)
    look = (lower > 0) | ((upper > first) << 1) | (first << 2) | ((digit > 0) << 3)
    return mix((look | np.minimum(lengths, 15) << 4 | sign << 8).astype(np.uint64))


def text_features(column: pa.Array, bits: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """For slices of a batch: number of texts, slot and text number of every feature (by text), tokens per text."""
    data, offsets = text_bytes(column)
    shift = np.uint64(64 - bits)
    for start, stop in slices(offsets, SLICE):
        part, at = data[offsets[start] : offsets[stop]], offsets[start : stop + 1] - offsets[start]
        starts, lengths, owner = token_spans(part, at)
        words = span_hashes(part, starts, lengths)
        again = np.zeros(len(words), bool)
        again[1:] = (words[1:] == words[:-1]) & (owner[1:] == owner[:-1])
        words[again] = _REPEAT
        look = shapes(part, starts, lengths) if len(starts) else words
        groups = [run_hashes(words, owner, n) for n in (1, 2)] + [run_hashes(look, owner, n) for n in (1, 2, 3)]
        hashes = np.concatenate([mix(h + np.uint64(7919 * k)) for k, (h, _) in enumerate(groups)])
        texts = np.concatenate([o for _, o in groups])
        order = np.argsort(texts, kind="stable")
        yield stop - start, (hashes[order] >> shift).astype(np.int64), texts[order], np.bincount(owner, minlength=stop - start)


def learn(rows: Iterable[tuple[float, np.ndarray, np.ndarray]], settings: QualitySettings) -> np.ndarray:
    """FTRL-proximal over (label, slots, values); the last weight is the intercept."""
    size = (1 << settings.bits) + 1
    pull, seen = np.zeros(size), np.zeros(size)

    def weights(at: np.ndarray) -> np.ndarray:
        z = pull[at]
        rate = (settings.beta + np.sqrt(seen[at])) / settings.alpha + settings.l2
        return np.where(np.abs(z) <= settings.l1, 0.0, (np.sign(z) * settings.l1 - z) / rate)

    for label, slots, values in rows:
        at, x = np.r_[slots, size - 1], np.r_[values.astype(np.float64), 1.0]
        w = weights(at)
        g = (sigmoid(np.dot(w, x)) - label) * x
        step = (np.sqrt(seen[at] + g * g) - np.sqrt(seen[at])) / settings.alpha
        pull[at] += g - step * w
        seen[at] += g * g
    return weights(np.arange(size)).astype(np.float32)


def sigmoid(z: np.ndarray | float) -> np.ndarray | float:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def train_quality(
    docs: DataFrame, labels: DataFrame, settings: QualitySettings = QualitySettings(), label: str = "quality"
) -> np.ndarray:
    """Weights from ``docs`` (doc_id, text) and ``labels`` (doc_id, and 0 or 1 in ``label``)."""
    spark, bits = docs.sparkSession, settings.bits
    known = labels.filter(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull())
    known = known.groupBy(F.col("doc_id").alias("__id")).agg(F.max(label).cast("double").alias("label"))
    place = F.xxhash64(F.col("__id").cast("string"))
    drawn = known.select("__id", "label", place.alias("place")).orderBy("place", "__id").limit(settings.sample)
    # The sample has at most settings.sample rows of three numbers, so it may be broadcast.
    texts = docs.select(F.col("doc_id").alias("__id"), F.col("text").cast("string").alias("text"))
    met = texts.join(F.broadcast(drawn), "__id").select("place", F.xxhash64("text").alias("tie"), "label", "text")

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slots, values, row = [], [], 0
            for count, at, owner, tokens in text_features(batch.column(3), bits):
                bounds = by_text(owner, count)
                for i in range(count):
                    unique, times = np.unique(at[bounds[i] : bounds[i + 1]], return_counts=True)
                    slots.append(unique.astype(np.int32).tobytes())
                    values.append((times / max(tokens[i], 1)).astype(np.float16).tobytes())
                row += count
            yield pa.record_batch([*batch.columns[:3], pa.array(slots, pa.binary()), pa.array(values, pa.binary())], names)

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [
            (y, np.frombuffer(s, np.int32), np.frombuffer(v, np.float16))
            for batch in batches
            for y, s, v in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4)), strict=True)
        ]
        yield pa.record_batch([pa.array([learn(rows * settings.passes, settings).tobytes()], pa.binary())], ["weights"])

    names = ["place", "tie", "label", "slots", "values"]
    made = met.mapInArrow(featurise, "place long, tie long, label double, slots binary, values binary")
    # Ids may repeat without end: equal texts become one here, of more than a sample every task keeps the first rows only.
    once = made.groupBy("place", "tie").agg(*[F.first(c).alias(c) for c in ("label", "slots", "values")])
    ordered = once.orderBy("place", "tie").limit(settings.sample).repartition(1).sortWithinPartitions("place", "tie")
    found = ordered.mapInArrow(fit, "weights binary").collect()
    size = (1 << bits) + 1
    return np.frombuffer(found[0]["weights"], np.float32) if found else np.zeros(size, np.float32)


def score_quality(docs: DataFrame, weights: np.ndarray, keep: tuple[str, ...] = ("doc_id",), score: str = "score") -> DataFrame:
    """The ``keep`` columns of every row, and the ``score`` of its whole text."""
    keep = tuple(c for c in keep if c != score)
    bits = int(len(weights) - 1).bit_length() - 1
    sent = docs.sparkSession.sparkContext.broadcast(weights)
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField(score, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = sent.value
        for batch in batches:
            out = []
            for count, at, owner, tokens in text_features(batch.column(len(keep)), bits):
                total = np.bincount(owner, w[at], minlength=count)
                out.append(sigmoid(total / np.maximum(tokens, 1) + w[-1]))
            scores = np.concatenate(out) if out else np.zeros(0)
            yield pa.record_batch([*batch.columns[: len(keep)], pa.array(scores, pa.float64())], [*keep, score])

    return docs.select(*keep, F.col("text").cast("string").alias("__text")).mapInArrow(run, schema)


def held_out(parts: int, part: int, doc_id: str = "doc_id"):
    """Whether crc32 of the id as text leaves ``part`` when divided by ``parts``; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % parts == part, F.lit(False))


def quality_of(docs: DataFrame, labels: DataFrame, keep: tuple[str, ...] = ("doc_id",), score: str = "score") -> DataFrame:
    """Trains on the labels that are not held out, and scores all of ``docs``."""
    weights = train_quality(docs, labels.filter(~held_out(3, 1)))
    return score_quality(docs, weights, keep, score)
