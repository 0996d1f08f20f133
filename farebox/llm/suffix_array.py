"""Suffixes of an Arrow batch's strings in order, by two-stage sorting in numpy, and where a string can repeat at all.

Everything here works on bounded bytes inside a task. ``END`` stands after every string; it occurs in no UTF-8.
"""

from __future__ import annotations

import numpy as np

from farebox.llm.buffers import mix

END = 0xFF
BLOCK = 1 << 20
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB], np.uint64)


def eights(data: np.ndarray, order: str, spare: int = 0) -> np.ndarray:
    """The eight bytes from every place on as one number ("<u8" or ">u8"), zeros behind the end."""
    padded = np.zeros(len(data) + 8 + spare, np.uint8)
    padded[: len(data)] = data
    return np.ndarray((len(data) + 1 + spare,), order, padded, 0, (1,))


def gram_hashes(eight: np.ndarray, count: int, size: int) -> np.ndarray:
    """Hash of the ``size`` bytes from each of the first ``count`` places."""
    total = np.zeros(count, np.uint64)
    for k, at in enumerate([*range(0, size - 8, 8), max(size - 8, 0)]):
        part = eight[at : at + count]
        if size < 8:
            part = part & np.uint64((1 << (8 * size)) - 1)
        total = mix(total + part * _FACTORS[0]) if k % 5 == 0 and k else total + part * _FACTORS[k % 5]
    return mix(total)


def sliding(values: np.ndarray, size: int, best: np.ufunc) -> np.ndarray:
    """``best`` (minimum or maximum) of every ``size`` neighbours."""
    have, step = values, 1
    while 2 * step <= size:
        have, step = best(have[:-step], have[step:]), 2 * step
    return best(have[: len(values) - size + 1], have[size - step :][: len(values) - size + 1]) if step < size else have


def anchored_runs(data: np.ndarray, offsets: np.ndarray, length: int, gram: int, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of neighbouring windows of ``length`` bytes whose least gram hash is the same.

    Equal windows have equal least hashes, so they are in runs of equal value. Returned are a run's first window, its number of
    windows (``most`` at most), its value, and whether the run may hold one window twice.
    """
    n, width = len(data), length - gram + 1
    valid = np.ones(n, bool)
    for start, stop in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        valid[max(start, stop - length + 1) : stop] = False
    found: list[tuple[np.ndarray, ...]] = []
    for low in range(0, n, BLOCK):
        high = min(low + BLOCK, n)
        ok = valid[low:high]
        if not ok.any():
            continue
        count = high - low + width - 1
        hashes = gram_hashes(eights(data[low : high + length], "<u8", length + 8), count, gram)
        least = sliding(hashes, width, np.minimum)
        fresh = ok.copy()
        fresh[1:] &= ~ok[:-1] | (least[1:] != least[:-1])
        first = np.flatnonzero(fresh)
        ends = np.flatnonzero(ok & np.r_[~ok[1:] | fresh[1:], True]) + 1
        held = sliding(np.r_[np.zeros(width - 1, np.uint64), np.where(ok, least, 0), np.zeros(width - 1, np.uint64)], width, np.maximum)
        places = np.flatnonzero(hashes == held[:count])
        twice = np.r_[0, np.cumsum(hashes[places[1:]] == hashes[places[:-1]])] if len(places) else np.zeros(1, np.int64)
        inner, outer = np.searchsorted(places, first), np.searchsorted(places, ends + width - 1) - 1
        again = twice[np.maximum(outer, inner).clip(0, len(twice) - 1)] > twice[inner.clip(0, len(twice) - 1)]
        again |= (first == 0) & (low > 0) | (ends == high - low)  # it may go on in the next block
        found.append((first + low, ends - first, least[first], again))
    first, count, value, again = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, bool))
    parts = -(-count // most)
    step = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
    again |= parts > 1
    cut = np.minimum(np.repeat(count, parts) - step * most, most)
    return np.repeat(first, parts) + step * most, cut, np.repeat(value, parts), np.repeat(again, parts)


def sorted_directly(data: np.ndarray, places: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes by their first ``depth`` bytes, eight at a time; only those still equal are compared on."""
    eight = eights(data, ">u8", depth + 8)
    key = eight[places].astype(np.uint64)
    order = np.argsort(key, kind="stable")
    out, key = places[order], key[order]
    same = np.r_[False, key[1:] == key[:-1]]
    for at in range(8, depth, 8):
        tied = same | np.r_[same[1:], False]
        where = np.flatnonzero(tied)
        if not len(where):
            break
        group = np.cumsum(~same[where])
        key = eight[out[where] + at].astype(np.uint64)
        order = np.lexsort((key, group))
        out[where] = out[where][order]
        key = key[order]
        same[where] &= np.r_[False, (group[1:] == group[:-1]) & (key[1:] == key[:-1])]
    return out


def suffix_order(data: np.ndarray, depth: int, wanted: np.ndarray | None = None) -> np.ndarray:
    """The ``wanted`` suffixes of ``data`` (all by default) in the order of at least their first ``depth`` bytes.

    Suffixes smaller than their successor are sorted directly. Every other one follows from its successor: a scan over the
    buckets of first bytes, from the lowest on, appends to each bucket the places before those that it passes. So besides what is wanted
    only the successors count that lead from a wanted suffix to the next one sorted directly.
    """
    n = len(data)
    differs = np.flatnonzero(np.r_[data[1:] != data[:-1], True])
    ahead = differs[np.searchsorted(differs, np.arange(n))]
    small = np.r_[data, np.uint8(0)][ahead + 1] > data[ahead]
    small[ahead == n - 1] = False
    used = np.ones(n, bool)
    if wanted is not None:
        place = np.arange(n)
        stopped = np.r_[-1, np.maximum.accumulate(np.where(small, place, -1))[:-1]]
        used = np.maximum.accumulate(np.where(wanted, place, -1)) > stopped
    direct = sorted_directly(data, np.flatnonzero(small & used), depth)
    sizes, direct_sizes = np.bincount(data[used], minlength=256), np.bincount(data[direct], minlength=256)
    starts, direct_starts = np.r_[0, np.cumsum(sizes)], np.r_[0, np.cumsum(direct_sizes)]
    heads, order = starts[:256].copy(), np.zeros(starts[-1], np.int64)
    induced = used & ~small

    def append(passed: np.ndarray) -> None:
        before = passed[passed > 0] - 1
        before = before[induced[before]]
        byte = data[before]
        by_byte = np.argsort(byte, kind="stable")
        counts = np.bincount(byte, minlength=256)
        within = np.arange(len(before)) - np.repeat(np.cumsum(counts) - counts, counts)
        order[heads[byte[by_byte]] + within] = before[by_byte]
        heads[:] += counts

    append(np.array([n]))
    for byte in range(256):
        tail = starts[byte + 1] - direct_sizes[byte]
        order[tail : starts[byte + 1]] = direct[direct_starts[byte] : direct_starts[byte + 1]]
        done = starts[byte]
        while done < heads[byte]:
            stop = heads[byte]
            append(order[done:stop].copy())
            done = stop
        append(order[tail : starts[byte + 1]].copy())
    return order if wanted is None else order[wanted[order]]


def common_prefixes(data: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """Length of the prefix that each suffix shares with the one before it in ``order``, up to ``most``."""
    eight = eights(data, "<u8", most + 8)
    shared = np.zeros(len(order), np.int64)
    active = np.arange(1, len(order))
    for at in range(0, most, 8):
        apart = eight[order[active] + at] ^ eight[order[active - 1] + at]
        ended = apart != 0
        low = apart[ended] & (~apart[ended] + np.uint64(1))  # the lowest bit that differs, in the first byte that differs
        shared[active[ended]] = at + np.log2(low.astype(np.float64)).astype(np.int64) // 8
        active = active[~ended]
    shared[active] = most
    return np.minimum(shared, most)


def equal_windows(strings: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """String, place in it, and class of every window of ``length`` bytes that stands more than once in the strings."""
    data = np.frombuffer(b"".join(s + bytes([END]) for s in strings), np.uint8)
    ends = np.cumsum([len(s) + 1 for s in strings])
    whole = np.ones(len(data), bool)
    for stop in ends.tolist():
        whole[max(stop - length, 0) : stop] = False
    if not whole.any():
        return (np.zeros(0, np.int64),) * 3
    order = suffix_order(data, length, whole)
    same = common_prefixes(data, order, length) >= length
    member = same | np.r_[same[1:], False]
    at, group = order[member], np.cumsum(~same[member])
    of = np.searchsorted(ends, at, "right")
    return of, at - np.r_[0, ends][of], group
