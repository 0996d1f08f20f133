"""Whitening against numpy's eigenvalues, and the parts of the solver on matrices that are hard for it."""

from __future__ import annotations

import math

import numpy as np
import pytest
from farebox.llm.queries import QUERIES
from farebox.llm.whitening import bidiagonal, principal_directions, squared_singular_values, whiten

KIND = "vec_id long, embedding array<float>, label int, n string, component string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", "y") for i, v in rows], KIND)


def plain(rows, count=4):
    """vec_id -> whitened coordinates up to sign, with explained and deviations, from the covariance matrix."""
    kept = [(i, [math.floor(256 * np.float32(c).astype(float)) for c in v]) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    width = max((len(v) for _, v in kept), default=0)
    kept = [(i, v + [0] * (width - len(v))) for i, v in kept]
    fit = sorted({tuple(v) for _, v in kept})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    mean = np.array(sums) / n
    away = np.array(fit, float) - mean
    values, vectors = np.linalg.eigh(away.T @ away / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    out = []
    for i, v in kept:
        deviation = sum((n * x - s) ** 2 for x, s in zip(v, sums))
        white = (np.array(v) - mean) @ vectors[:, :count] / np.sqrt(values[:count])
        out += [(i, k + 1, n, deviation, float(white[k]), float(values[k] / values.sum())) for k in range(min(count, width))]
    return out


def check(found, rows):
    want, got = plain(rows), [tuple(r) for r in found.collect()]
    assert len(got) == len(want)
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[3], abs(r[4]))
    got, want = sorted(got, key=key), sorted(want, key=key)
    assert [r[:4] for r in got] == [r[:4] for r in want]
    assert np.allclose([r[5] for r in got], [r[5] for r in want], rtol=1e-9)
    for component in {r[1] for r in got}:
        a, b = (np.array([r[4] for r in x if r[1] == component]) for x in (got, want))
        assert np.allclose(a, b * np.sign(a @ b), atol=1e-7)
    assert len({r[6] for r in got}) == 1 and got[0][6] < 1e-9


def vectors(count, width, seed=1):
    draw = np.random.default_rng(seed)
    return draw.normal(size=(count, width)) @ draw.normal(size=(width, width)) / 3 + draw.normal(size=width)


def test_query_has_all_vectors_and_equals_numpy(spark, data):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{data}/embeddings.parquet").collect()]
    check(QUERIES["op12_whitening"](spark, data), rows)


def test_nulls_copies_short_and_broken_vectors(spark):
    rows = [(n, v.tolist()) for n, v in enumerate(vectors(80, 6))]
    rows += [(n, rows[3][1]) for n in range(200, 260)] + [rows[5], rows[5], (None, rows[7][1]), (None, None), (300, None)]
    rows += [(301, [1.0, None] + [0.0] * 4), (302, [float("nan")] * 6), (303, [float("inf")] * 6), (304, [0.5, 0.25]), (305, [])]
    found = whiten(frame(spark, rows).repartition(5))
    assert found.dtypes == [("vec_id", "bigint"), ("component", "int"), ("n", "bigint"), ("deviation", "bigint"), ("whitened", "double"), ("explained", "double"), ("identity_error", "double")]
    check(found, rows)


def test_fewer_independent_vectors_than_components(spark):
    rows = [(n, [float(n), 2.0 * n, 1.0]) for n in range(9)]
    got = sorted(map(tuple, whiten(frame(spark, rows)).collect()))
    assert len(got) == 27 and all(abs(r[5] - (r[1] == 1)) < 1e-12 for r in got)
    assert all((r[4] is None) == (r[1] > 1) and r[6] < 1e-9 for r in got)
    same = whiten(frame(spark, [(1, [1.0, 2.0])] * 4)).collect()
    assert [tuple(r)[2:] for r in same] == [(1, 0, None, None, None)] * 8


def test_deviation_beyond_64_bits_is_null(spark):
    got = {(r["vec_id"], r["deviation"] is None) for r in whiten(frame(spark, [(1, [3e30, 1.0]), (2, [0.0, 0.0]), (3, [0.0, 1.0])])).collect()}
    assert got == {(1, True), (2, True), (3, True)}


def test_empty(spark):
    assert whiten(frame(spark, [])).count() == whiten(frame(spark, [(1, []), (2, None)])).count() == 0


HARD = {
    "random": np.random.default_rng(2).normal(size=(30, 30)),
    "graded": np.diag(10.0 ** -np.arange(20)) @ np.random.default_rng(3).normal(size=(20, 20)),
    "all equal": np.eye(12),
    "two equal": np.diag([5.0, 5, 5, 2, 1, 1]) @ np.linalg.qr(np.random.default_rng(4).normal(size=(6, 6)))[0],
    "rank one": np.outer(np.arange(1.0, 9), np.arange(2.0, 10)),
    "zero": np.zeros((5, 5)),
    "one": np.array([[-3.0]]),
    "close": np.diag([1 + 1e-9, 1.0, 1 - 1e-9, 0.5]) @ np.linalg.qr(np.random.default_rng(5).normal(size=(4, 4)))[0],
}


@pytest.mark.parametrize("name", list(HARD))
def test_singular_values_and_directions(name):
    r = np.linalg.qr(HARD[name], mode="r")
    want = np.linalg.svd(r, compute_uv=False)
    a, b, v = bidiagonal(r)
    assert np.allclose(v.T @ v, np.eye(len(r)), atol=1e-13)
    assert np.allclose(np.sqrt(squared_singular_values(a, b)), want, rtol=1e-10, atol=1e-14 * max(want[0], 1e-300))
    values, directions = principal_directions(r, 4)
    real = int((want[:4] > 1e-10 * max(want[0], 1e-300)).sum())
    directions = directions[:, :real]
    assert np.allclose(directions.T @ directions, np.eye(real), atol=1e-9)
    assert np.allclose(r.T @ (r @ directions), directions * values[:real], atol=1e-12 * max(values[0], 1))
