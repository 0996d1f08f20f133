"""Whitening of embeddings: directions of largest variance, found through a bidiagonal qd solver.

Every entry c becomes x = floor(256 * c). The fit list is each distinct x vector once (``n`` vectors with sums ``S``), so copies don't bend
the directions. No covariance matrix is formed, which would square the condition:

1. Tasks reduce the centred rows of the fit list block by block to a triangle R by QR, and the triangles of tasks are stacked and reduced
   again in groups of tasks; the driver gets one triangle, as wide as a vector, whatever the number of rows.
2. Householder reflections turn R into an upper bidiagonal matrix.
3. dqds transforms of its squared entries give all squared singular values, to high relative accuracy. Each shift is the reciprocal of
   the trace of the inverse, which never exceeds the smallest value.
4. Twisted factorisations of the tridiagonal product less each eigenvalue give its vector: stationary transform from the top, progressive
   from the bottom, twisted where they agree best. Vectors of near values are made orthogonal among themselves.
5. One pass over the fit list measures how far the whitened covariance is from the identity; it goes out with every row.

Sums are exact (decimals of two halves), so ``deviation``, the sum of (n * x - S)^2, is exact; where it doesn't fit a long it is NULL.

Rows whose vector is NULL or holds NULL or non-finite entries are dropped; a NULL id stays. Shorter vectors are padded with
zeros to the longest. Repeated rows each get their rows. Entries beyond 64 bits are taken as the largest long. Components are ``count`` or as many as vectors are wide;
one whose eigenvalue is 0 (fewer independent vectors than components) has whitened NULL and explained 0, and is left out of
``identity_error``; without any variance both are NULL. No rows left, or only empty vectors: no result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farebox.llm.scratch import Steps

COUNT = 4
BLOCK_ROWS = 4096
GROUPS = (1024, 32, 1)  # triangles are merged in so many groups, level by level
NEAR = 1e-3  # vectors of eigenvalues closer than this part of the largest are made orthogonal
_EPS = float(np.finfo(float).eps)


def quantised(df: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(vec_id, x) of the rows that take part, as whole numbers of one width."""
    c = F.col(vector).cast("array<double>")
    whole = c.isNotNull() & F.forall(c, lambda v: F.coalesce((F.abs(v) < float("inf")) & ~F.isnan(v), F.lit(False)))
    rows = df.filter(whole).select(F.col(vec_id).alias("vec_id"), F.transform(c, lambda v: F.floor(v * 256).cast("long")).alias("x"))
    least, most = rows.agg(F.min(F.size("x")), F.max(F.size("x"))).first()
    if least != most:
        rows = rows.withColumn("x", F.concat("x", F.array_repeat(F.lit(0).cast("long"), F.lit(most) - F.size("x"))))
    return rows


def matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), width)


def triangle(rows: np.ndarray) -> np.ndarray:
    return np.linalg.qr(rows, mode="r")


def exact_sums(fit: DataFrame, width: int) -> tuple[int, list[int]]:
    """How many vectors, and the sum of each dimension."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, high, rows = np.zeros(width, np.int64), np.zeros(width, np.int64), 0
        for batch in batches:
            x = matrix(batch.column(0), width)
            low, high, rows = low + (x & 0xFFFFFFFF).sum(0), high + (x >> 32).sum(0), rows + len(x)
        sums = [Decimal((h << 32) + v) for h, v in zip(high.tolist(), low.tolist(), strict=True)]
        yield pa.record_batch([pa.array(range(-1, width), pa.int32()), pa.array([Decimal(rows), *sums], pa.decimal128(38, 0))], ["dim", "part"])

    sums = fit.mapInArrow(add, "dim int, part decimal(38,0)").groupBy("dim").agg(F.sum("part").alias("total"))
    found = {r["dim"]: int(r["total"]) for r in sums.collect()}  # one row a dimension
    return found.get(-1, 0), [found.get(i, 0) for i in range(width)]


def reduced(fit: DataFrame, mean: np.ndarray) -> np.ndarray:
    """The triangle of the centred rows of the fit list."""
    width = len(mean)

    def pack(r: np.ndarray, place: int) -> pa.Table:
        return pa.table([pa.array([place], pa.int32()), pa.array([r.tobytes()], pa.binary())], ["place", "r"])

    def unpack(cell: bytes) -> np.ndarray:
        return np.frombuffer(cell).reshape(-1, width)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        r = np.zeros((0, width))
        for batch in batches:
            for start in range(0, len(batch), BLOCK_ROWS):
                r = triangle(np.vstack([r, matrix(batch.column(0).slice(start, BLOCK_ROWS), width) - mean]))
        yield from pack(r, TaskContext.get().partitionId()).to_batches()

    def fold(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        r = np.zeros((0, width))
        for cell in table["r"]:
            r = triangle(np.vstack([r, unpack(cell.as_py())]))
        return pack(r, key[0].as_py())

    parts = fit.mapInArrow(blocks, "place int, r binary")
    for groups in GROUPS:
        parts = parts.groupBy(F.pmod("place", F.lit(groups)).alias("group")).applyInArrow(fold, "place int, r binary")
    whole = np.vstack([np.zeros((0, width)), *[unpack(row["r"]) for row in parts.collect()]])  # the last level has one group
    return np.vstack([whole, np.zeros((max(width - len(whole), 0), width))])[:width]


def reflector(x: np.ndarray) -> tuple[np.ndarray, float]:
    """A unit vector v with (1 - 2 v v') x = (alpha, 0, 0...), and alpha."""
    size = np.linalg.norm(x)
    if size == 0 or not np.any(x[1:]):
        return np.zeros(len(x)), float(x[0])
    alpha = -np.copysign(size, x[0])
    v = x.copy()
    v[0] -= alpha
    return v / np.linalg.norm(v), float(alpha)


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal and upper diagonal of U' R V, and V."""
    r, width = r.copy(), r.shape[1]
    v, diagonal, above = np.eye(width), np.zeros(width), np.zeros(max(width - 1, 0))
    for k in range(width):
        left, diagonal[k] = reflector(r[k:, k])
        r[k:, k:] -= np.outer(2 * left, left @ r[k:, k:])
        if k < width - 1:
            right, above[k] = reflector(r[k, k + 1 :])
            r[k:, k + 1 :] -= np.outer(r[k:, k + 1 :] @ right, 2 * right)
            v[:, k + 1 :] -= np.outer(v[:, k + 1 :] @ right, 2 * right)
    return diagonal, above, v


def inverse_trace(q: list[float], e: list[float]) -> float:
    """Sum of the reciprocals of all squared singular values; infinite for a singular array."""
    d, total = q[0], 0.0
    for k, x in enumerate(e):
        if d <= 0:
            return float("inf")
        total += 1 / d
        d *= q[k + 1] / (d + x)
    return total + 1 / d if d > 0 else float("inf")


def shifted(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float]] | None:
    """One differential quotient-difference transform with a shift; None if the shift was above the smallest value."""
    d, out_q, out_e = q[0] - shift, [], []
    for k, x in enumerate(e):
        if d < 0:
            return None
        total = d + x
        ratio = q[k + 1] / total if total > 0 else 0.0
        out_q.append(total)
        out_e.append(x * ratio)
        d = d * ratio - shift if total > 0 else q[k + 1] - shift
    return (out_q + [d], out_e) if d >= 0 else None


def squared_singular_values(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """All squared singular values of an upper bidiagonal matrix by dqds, the largest first."""
    scale = max(np.abs(diagonal).max(initial=0), np.abs(above).max(initial=0))
    if scale == 0:
        return np.zeros(len(diagonal))
    todo, found = [(((diagonal / scale) ** 2).tolist(), ((above / scale) ** 2).tolist(), 0.0)], []
    while todo:
        q, e, moved = todo.pop()
        if q[0] < q[-1]:
            q, e = q[::-1], e[::-1]
        rounds = 0
        while len(q) > 1:
            cut = next((k for k in range(len(e) - 1, -1, -1) if e[k] <= _EPS**2 * (moved + min(q[k], q[k + 1])) or e[k] < 1e-300), None)
            if cut is not None:
                todo.append((q[: cut + 1], e[:cut], moved))
                q, e = q[cut + 1 :], e[cut + 1 :]
                continue
            shift = (1 - 16 * len(q) * _EPS) / inverse_trace(q, e)
            after = shifted(q, e, shift)
            while after is None:
                shift = shift / 2 if shift > 1e-300 else 0.0
                after = shifted(q, e, shift)
            (q, e), moved, rounds = after, moved + shift, rounds + 1
            if rounds > 1000 * (len(q) + 1):
                raise ArithmeticError("singular values did not converge")
        found.append(q[0] + moved)
    return np.sort(np.array(found))[::-1] * scale**2


def twisted_vectors(diagonal: np.ndarray, above: np.ndarray, value: float) -> Iterator[np.ndarray]:
    """Unit vectors of the tridiagonal product of a bidiagonal matrix for one eigenvalue, the twist that fits best first."""
    small = _EPS * max(np.abs(diagonal).max(), np.abs(above).max(initial=0)) or 1.0
    a = np.where(np.abs(diagonal) < small, small, diagonal)
    d, low = (a * a).tolist(), (above / a[:-1]).tolist()
    n, tiny = len(d), _EPS**2 * small**2 + 1e-300
    s, down = [-value], []
    for k in range(n - 1):
        pivot = s[k] + d[k]
        pivot = pivot if abs(pivot) > tiny else tiny
        down.append(d[k] * low[k] / pivot)
        s.append(down[k] * low[k] * s[k] - value)
    p, up = [0.0] * n, [0.0] * (n - 1)
    p[-1] = d[-1] - value
    for k in range(n - 2, -1, -1):
        pivot = d[k] * low[k] ** 2 + p[k + 1]
        pivot = pivot if abs(pivot) > tiny else tiny
        ratio = d[k] / pivot
        up[k] = low[k] * ratio
        p[k] = p[k + 1] * ratio - value
    for twist in np.argsort(np.abs(np.array(s) + np.array(p) + value), kind="stable"):
        z = np.zeros(n)
        z[twist] = 1.0
        for k in range(twist - 1, -1, -1):
            z[k] = -down[k] * z[k + 1]
        for k in range(twist, n - 1):
            z[k + 1] = -up[k] * z[k]
        size = np.linalg.norm(z)
        if np.isfinite(size):
            yield z / size


def principal_directions(r: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """All eigenvalues of R'R, and the unit vectors of the ``count`` largest as columns."""
    diagonal, above, v = bidiagonal(r)
    values = squared_singular_values(diagonal, above)
    chosen: list[np.ndarray] = []
    for j in range(min(count, len(values))):
        near = np.array([z for z, value in zip(chosen, values, strict=False) if value - values[j] <= NEAR * values[0]]).reshape(-1, len(values))
        best, most = np.zeros(len(values)), 0.0
        for z in twisted_vectors(diagonal, above, float(values[j])):
            for _ in range(2 if len(near) else 0):
                z = z - near.T @ (near @ z)
            if (left := float(np.linalg.norm(z))) > most:
                best, most = z / left, left
            if most > 0.5:
                break
        chosen.append(best)
    return values, v @ np.array(chosen).reshape(-1, len(values)).T


def identity_error(fit: DataFrame, mean: np.ndarray, weights: np.ndarray, rows: int) -> float | None:
    """Largest absolute entry of the covariance of the whitened fit list, less the identity."""
    count, width = weights.shape[1], len(mean)
    if not count:
        return None

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            w = (matrix(batch.column(0), width) - mean) @ weights
            if len(w):
                middle = w.mean(0)
                inner, outer = (w - middle).T @ (w - middle), len(w) * np.outer(middle, middle)
                cells = [np.repeat(np.arange(count), count), np.tile(np.arange(count), count), inner.ravel(), outer.ravel(), np.repeat(w.sum(0), count)]
                yield pa.record_batch([pa.array(x) for x in cells], ["i", "j", "inner", "outer", "total"])

    sums = fit.mapInArrow(products, "i long, j long, inner double, outer double, total double")
    cells = sums.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("inner", "outer", "total")]).collect()  # count^2 rows
    total = {r["i"]: r["total"] / rows for r in cells}
    return max(abs((r["inner"] + r["outer"]) / rows - total[r["i"]] * total[r["j"]] - (r["i"] == r["j"])) for r in cells)


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum over dimensions of (n * x - S)^2 of each row; None where it doesn't fit 64 bits."""
    most = n * max(abs(int(x.min(initial=0))), int(x.max(initial=0))) + max(map(abs, sums), default=0)
    if most**2 * max(len(sums), 1) < 1 << 63:
        away = n * x - np.array(sums, np.int64)
        return (away * away).sum(1).tolist()
    exact = [sum((n * v - s) ** 2 for v, s in zip(row, sums, strict=True)) for row in x.tolist()]
    return [v if v < 1 << 63 else None for v in exact]


def whiten(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", count: int = COUNT) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error): ``count`` rows for every vector."""
    steps = Steps(vectors.sparkSession)
    schema = T.StructType(
        [
            T.StructField(vec_id, vectors.schema[vec_id].dataType),
            T.StructField("component", T.IntegerType()),
            T.StructField("n", T.LongType()),
            T.StructField("deviation", T.LongType()),
            T.StructField("whitened", T.DoubleType()),
            T.StructField("explained", T.DoubleType()),
            T.StructField("identity_error", T.DoubleType()),
        ]
    )
    rows = quantised(vectors, vec_id, vector)
    width = rows.select(F.size("x")).first()
    if width is None or width[0] == 0:
        return vectors.sparkSession.createDataFrame([], schema)
    width = width[0]
    fit = steps.keep(rows.select("x").distinct(), "fit")
    n, sums = exact_sums(fit, width)
    mean = np.array([s / n for s in sums])
    values, directions = principal_directions(reduced(fit, mean), count)
    real = int((values[:count] > (_EPS * width) ** 2 * values[0]).sum())
    weights = directions[:, :real] / np.sqrt(values[:real] / n)
    error = identity_error(fit, mean, weights, n)
    given = min(count, width)
    explained = [float(v) / float(values.sum()) if k < real else 0.0 for k, v in enumerate(values[:given])] if real else [None] * given

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, len(batch), BLOCK_ROWS):
                part = batch.slice(start, BLOCK_ROWS)
                x = matrix(part.column(1), width)
                white = np.full((len(x), given), np.nan)
                white[:, :real] = (x - mean) @ weights
                row = np.repeat(np.arange(len(x)), given)
                yield pa.record_batch(
                    [
                        part.column(0).take(pa.array(row)),
                        pa.array(np.tile(np.arange(1, given + 1), len(x)), pa.int32()),
                        pa.array(np.full(len(row), n), pa.int64()),
                        pa.array(deviations(x, n, sums), pa.int64()).take(pa.array(row)),
                        pa.array(white.ravel(), pa.float64(), mask=np.tile(np.arange(given) >= real, len(x))),
                        pa.array(explained * len(x), pa.float64()),
                        pa.array([error] * len(row), pa.float64()),
                    ],
                    schema.names,
                )

    return rows.mapInArrow(project, schema)
