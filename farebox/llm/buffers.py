"""Texts of an Arrow batch as one byte array, and the words, hashes and sums that numpy takes from it.

Everything here works on a bounded slice of a batch inside a task; Spark splits and shuffles the rows.
A word is a longest run of bytes outside ``0x20`` and ``0x09-0x0D``, which is the pattern ``[^\\x20\\x09-\\x0D]+``
on UTF-8, as no byte of a longer sequence lies below 0x80.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 4 << 20
PIECE_BYTES = 12 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_KEEP = np.array([(1 << (8 * n)) - 1 for n in range(9)], np.uint64)
_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_S30, _S27, _S31 = np.uint64(30), np.uint64(27), np.uint64(31)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit scramble, so that equal outputs mean equal inputs."""
    x = (x ^ (x >> _S30)) * _MIX1
    x = (x ^ (x >> _S27)) * _MIX2
    return x ^ (x >> _S31)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 of all texts end to end, and the n + 1 offsets between them; NULL counts as empty."""
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def slices(offsets: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``most`` bytes; a longer text is a range of its own."""
    start = 0
    while start < len(offsets) - 1:
        stop = max(start + 1, int(np.searchsorted(offsets, offsets[start] + most, "right")) - 1)
        yield start, stop
        start = stop


def pieces_of(batch: pa.RecordBatch, column: int, most: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """A batch in pieces of about ``most`` bytes of text, which bounds what a task holds at once."""
    _, offsets = text_bytes(batch.column(column))
    for start, stop in slices(offsets, most):
        yield batch.slice(start, stop - start)


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and text number of every word; words end with their text."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~_SPACE[data]
    step = np.diff(inside)
    starts, stops = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    joined = np.unique(cuts[(inside[cuts] == 1) & (inside[cuts + 1] == 1)])
    if len(joined):
        starts, stops = np.sort(np.r_[starts, joined]), np.sort(np.r_[stops, joined])
    return starts, stops - starts, np.searchsorted(offsets, starts, "right") - 1


def span_hashes(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """64-bit hash of each span of bytes, eight bytes a step."""
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    eight = np.ndarray((len(data) + 1,), "<u8", padded, 0, (1,))
    out = mix(lengths.astype(np.uint64) + _ODD)
    todo, at, left = np.arange(len(starts)), starts.copy(), lengths.copy()
    while len(todo):
        part = eight[at] & _KEEP[np.minimum(left, 8)]
        out[todo] = mix(out[todo] * _ODD ^ part)
        more = left > 8
        todo, at, left = todo[more], at[more] + 8, left[more] - 8
    return out


def run_hashes(words: np.ndarray, owner: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of ``size`` consecutive words of one text, and its text; a shorter text gives one run of all."""
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
    count = np.diff(np.r_[first, n])
    full = np.flatnonzero(owner[: n - size + 1] == owner[size - 1 :]) if n >= size else np.zeros(0, np.int64)
    runs = np.zeros(len(full), np.uint64)
    for k in range(size):
        runs = mix(runs * _ODD ^ words[full + k])
    short = np.flatnonzero(count < size)
    rest = np.zeros(len(short), np.uint64)
    for k in range(size - 1):
        has = count[short] > k
        rest[has] = mix(rest[has] * _ODD ^ words[first[short[has]] + k])
    rest = mix(rest + count[short].astype(np.uint64))
    texts, hashes = np.r_[owner[full], owner[first[short]]], np.r_[runs, rest]
    order = np.argsort(texts, kind="stable")
    return hashes[order], texts[order]


def by_text(texts: np.ndarray, rows: int) -> np.ndarray:
    """The rows + 1 bounds of each text's stretch in a sorted array of text numbers."""
    return np.searchsorted(texts, np.arange(rows + 1))


_KIND = np.ones(256, np.uint8)  # 0 blank, 1 letter or digit, 2 other sign
_KIND[:128] = 2
_KIND[[0x20, *range(0x09, 0x0E)]] = 0
_KIND[[*range(48, 58), *range(65, 91), *range(97, 123)]] = 1


def token_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and text number of every token: a run of letters and digits, or a run of other signs."""
    kinds = _KIND[data]
    edge = np.ones(len(data), bool)
    edge[1:] = kinds[1:] != kinds[:-1]
    cuts = offsets[1:-1]
    edge[cuts[cuts < len(data)]] = True
    starts = np.flatnonzero(edge)
    lengths = np.diff(np.r_[starts, len(data)])
    real = kinds[starts] > 0
    starts, lengths = starts[real], lengths[real]
    return starts, lengths, np.searchsorted(offsets, starts, "right") - 1
