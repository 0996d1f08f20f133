"""Exact top-k by inner product through a pivot-distance index.

Vectors become integers, floor(256 * x), padded with zeros to the longest. With one more component
sqrt(M^2 - |x|^2) for the stored vectors, M the largest norm, and 0 for the queries, the largest inner products are the
smallest distances, so bounds from the triangle inequality hold.

1. Pivots are centres fitted on a bounded sample (``SAMPLE`` rows a pivot, by a hash of the id; a few rounds of k-means), as many as half the square
   root of the table's rows, ``PIVOTS`` to ``MOST_PIVOTS``. Every vector is keyed by its nearest pivot and by the annulus its distance to it falls in, of which
   there are as many, up to ``ANNULI``, as leave ``CELL_ROWS`` rows a cell. A
   cell (pivot, annulus) with many rows is dealt to several blocks by chance, so a frequent vector, direction or id fills many blocks instead of one.
2. A query expands the annuli in the order of the least distance that each can hold: to anything in annulus [a, b] around a pivot at
   distance d it is at least a - d and d - b, and, past the half plane towards the query's own nearest pivot, at least half the difference of the
   distances. It visits the first block of this order, then the next ``STEPS``, and then all that are left, each time only those whose bound reaches the k-th
   best score so far, which rises. Within a block, rows sorted by distance are cut to the span that can qualify.
3. The best k of all blocks win; ties go to the smaller id. Nothing is approximated: bounds are widened by more than rounding can shift.

Blocks and packs of queries meet by a join on the block, which Spark can split; the driver holds pivots and one row per
cell, at most MOST_PIVOTS x ANNULI.

Vectors that are NULL, or hold NULL, NaN or infinite components, take no part, neither do NULL ids; an empty array is a zero
vector. Components from 2^21 on raise an error, as scores might not fit a long. Rows that repeat an id are stored rows of their own; a query never
meets rows with its own id, and a repeated query id is searched once, with its largest vector. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from farebox.llm.scratch import Steps

PIVOTS = 64
MOST_PIVOTS = 2048
ANNULI = 16
SAMPLE = 32
STEPS = (1, 8)  # blocks that a query visits before its threshold is taken again; the last round has no limit
BLOCK_ROWS = 2048
LEAST_ROWS = 256
CELL_ROWS = 128
CHUNK = 512  # rows whose distances to all pivots or cells a task holds at once
PACK_QUERIES = 64
LARGEST = 1 << 29


def quantised(df: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(id, v) with integer components; rows that take no part are dropped."""
    x = F.col(vector).cast("array<double>")
    good = F.col(vec_id).isNotNull() & x.isNotNull()
    good &= F.forall(x, lambda c: F.coalesce((F.abs(c) < float("inf")) & ~F.isnan(c), F.lit(False)))
    whole = F.transform(x, lambda c: F.floor(c * 256))
    fits = F.forall(whole, lambda c: F.abs(c) < LARGEST)
    return df.filter(good).select(
        F.col(vec_id).cast("long").alias("id"),
        F.when(fits, whole.cast("array<long>")).otherwise(F.raise_error(F.lit("a vector component is too large to score"))).alias("v"),
    )


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Vectors of a batch as rows of doubles (exact for such integers), shorter ones padded with zeros."""
    offsets = column.offsets.to_numpy()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    sizes = np.diff(offsets)
    out = np.zeros((len(column), width))
    if len(flat):
        at = np.arange(len(flat)) - np.repeat(offsets[:-1] - offsets[0], sizes)
        out[np.repeat(np.arange(len(column)), sizes), at] = flat
    return out


def centres(rows: np.ndarray, count: int) -> np.ndarray:
    """Pivots for a sample: k-means from evenly spread rows."""
    found = np.unique(rows, axis=0)
    found = found[np.linspace(0, len(found) - 1, min(count, len(found))).astype(int)]
    for _ in range(5):
        near, _ = nearest(rows, found)
        sums = np.zeros_like(found)
        np.add.at(sums, near, rows)
        times = np.bincount(near, minlength=len(found))[:, None]
        found = np.where(times > 0, sums / np.maximum(times, 1), found)
    return found


def nearest(rows: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest pivot of each row, and the distance to it."""
    near, away = np.zeros(len(rows), np.int64), np.zeros(len(rows))
    for start in range(0, len(rows), CHUNK):
        to = distances(rows[start : start + CHUNK], pivots)
        near[start : start + CHUNK], away[start : start + CHUNK] = to.argmin(1), to.min(1)
    return near, away


def distances(rows: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    square = (rows**2).sum(1)[:, None] + (pivots**2).sum(1)[None] - 2 * rows @ pivots.T
    return np.sqrt(np.maximum(square, 0))


def lifted(rows: np.ndarray, largest: float) -> np.ndarray:
    """Stored vectors on the sphere around 0 with the largest norm as radius."""
    return np.c_[rows, np.sqrt(np.maximum(largest - (rows**2).sum(1), 0))]


def scores_of(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products, exact: doubles hold them below 2^53, else 64-bit integers do."""
    most = max(1.0, np.abs(queries).max(initial=0)) * max(1.0, np.abs(rows).max(initial=0)) * max(1, rows.shape[1])
    if most < 2**52:
        return (queries @ rows.T).astype(np.int64)
    return queries.astype(np.int64) @ rows.astype(np.int64).T


class Index:
    """What searching tasks need to know: pivots, the ring width, the largest squared norm, and the cells."""

    def __init__(self, pivots: np.ndarray, reach: float, annuli: int, largest: float, width: int, block_rows: int):
        self.pivots, self.step, self.annuli, self.largest, self.width, self.block_rows = pivots, reach / annuli, annuli, largest, width, block_rows
        self.slack = 1e-6 * (1 + np.sqrt(largest))
        self.cells = np.zeros((0, 4))  # pivot, annulus, rows, blocks before this cell
        self.low = self.high = np.zeros(0)

    def keys(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        near, reach = nearest(lifted(rows, self.largest), self.pivots)
        ring = np.minimum(reach / self.step, self.annuli - 1).astype(int) if self.step else np.zeros(len(rows), int)
        return near, reach, ring

    def bounds(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distance of each query to each pivot, and the least possible distance to anything in each cell."""
        away = distances(np.c_[queries, np.zeros(len(queries))], self.pivots)
        cell = self.cells[:, 0].astype(int)
        to = away[:, cell]
        least = np.maximum(self.low[None] - to, to - self.high[None])
        beyond = (to - away.min(1)[:, None]) / 2
        return away, np.maximum(np.maximum(least, beyond) - self.slack, 0)


def build(stored: DataFrame, steps: Steps) -> tuple[Index, DataFrame]:
    """The index, and the table (id, v, pivot, ring, reach) of all stored vectors."""
    facts = stored.agg(F.max(F.size("v")), F.max(F.aggregate("v", F.lit(0.0), lambda s, c: s + c.cast("double") * c)), F.count("*")).first()
    width, largest, count = int(facts[0] or 0), float(facts[1] or 0), facts[2]
    wanted = min(max(PIVOTS, int(np.sqrt(count) / 2)), MOST_PIVOTS)
    annuli = min(max(2, count // (wanted * CELL_ROWS)), ANNULI)
    tasks = int(stored.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    drawn = stored.select(F.xxhash64("id").alias("h"), "id", "v").orderBy("h", "id").limit(SAMPLE * wanted).toArrow()
    rows = matrix(drawn.column("v").combine_chunks(), width) if drawn.num_rows else np.zeros((1, width))
    rows = lifted(rows, largest)
    pivots = centres(rows, wanted)
    index = Index(pivots, float(nearest(rows, pivots)[1].max()), annuli, largest, width, min(BLOCK_ROWS, max(LEAST_ROWS, count // (2 * tasks))))
    sent = stored.sparkSession.sparkContext.broadcast(index)

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near, reach, ring = sent.value.keys(matrix(batch.column("v"), sent.value.width))
            deal = pa.array(np.random.default_rng().integers(0, 1 << 40, len(batch)))  # written with the row, so it stays what it is
            yield pa.record_batch([*batch.columns, pa.array(near, pa.int32()), pa.array(ring, pa.int32()), pa.array(reach), deal], ["id", "v", "pivot", "ring", "reach", "deal"])

    keyed = steps.keep(stored.mapInArrow(key, "id long, v array<long>, pivot int, ring int, reach double, deal long"), "keyed")
    cells = keyed.groupBy("pivot", "ring").agg(F.count("*"), F.min("reach"), F.max("reach")).orderBy("pivot", "ring").collect()
    count = np.array([c[2] for c in cells], float)
    blocks = np.ceil(count / index.block_rows)
    index.cells = np.c_[[c[0] for c in cells], [c[1] for c in cells], count, np.cumsum(blocks) - blocks].reshape(-1, 4)
    index.low, index.high = np.array([c[3] for c in cells]), np.array([c[4] for c in cells])
    return index, keyed


def with_block(keyed: DataFrame, index: Index) -> DataFrame:
    """Adds the number of the block that each stored vector lies in."""
    spark = keyed.sparkSession
    rows = [(int(p), int(r), int(b), int(-(-n // index.block_rows))) for p, r, n, b in index.cells]
    cells = spark.createDataFrame(rows or [(-1, -1, 0, 1)], "pivot int, ring int, base long, blocks long")
    placed = keyed.join(F.broadcast(cells), ["pivot", "ring"])  # at most MOST_PIVOTS x ANNULI rows
    return placed.select("id", "v", "reach", "pivot", (F.col("base") + F.pmod("deal", "blocks")).alias("block"))


PACK = "block long, ids array<long>, floors array<long>, vectors array<array<long>>"


def requests(queries: DataFrame, index: Index, after: int, upto: int | None, packs: int) -> DataFrame:
    """Packs of queries (id, v, floor) for the blocks in places ``after`` to ``upto`` of each query's order, as far as they can matter."""
    sent = queries.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = sent.value
        if not len(index.cells):
            return
        base = index.cells[:, 3].astype(int)
        blocks = np.ceil(index.cells[:, 2] / index.block_rows).astype(int)
        for batch in (whole.slice(k, CHUNK) for whole in batches for k in range(0, len(whole), CHUNK)):
            ids, floors = batch.column("id").to_numpy(), batch.column("floor").to_pylist()
            rows = matrix(batch.column("v"), index.width)
            _, least = index.bounds(rows)
            norms = (rows**2).sum(1)
            found, of = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for i in range(len(ids)):
                # A score of s means a squared distance of |q|^2 + M^2 - 2 s.
                limit = np.inf if floors[i] is None else np.sqrt(max(norms[i] + index.largest - 2 * floors[i], 0)) + index.slack
                order = np.lexsort((-index.cells[:, 2], least[i]))
                order = order[: np.searchsorted(least[i][order], limit, "right")]
                ends = np.cumsum(blocks[order])
                place = np.arange(after, ends[-1] if upto is None else min(upto, ends[-1])) if len(order) else np.zeros(0, np.int64)
                cell = np.searchsorted(ends, place, "right")  # of each place in the query's order of blocks
                found.append(base[order[cell]] + place - (ends - blocks[order])[cell])
                of.append(np.full(len(place), i))
            block_of, query_of = np.concatenate(found), np.concatenate(of)
            sorted_by = np.argsort(block_of, kind="stable")
            block_of, query_of = block_of[sorted_by], query_of[sorted_by]
            used, first = np.unique(block_of, return_index=True)
            vectors = batch.column("v")
            for block, at in zip(used.tolist(), np.split(query_of, first[1:]), strict=True) if len(used) else ():
                for k in range(0, len(at), packs):
                    some = at[k : k + packs]
                    yield pa.record_batch(
                        [
                            pa.array([block], pa.int64()),
                            pa.array([ids[some].tolist()], pa.list_(pa.int64())),
                            pa.array([[floors[i] for i in some]], pa.list_(pa.int64())),
                            pa.array([vectors.take(pa.array(some)).to_pylist()], pa.list_(pa.list_(pa.int64()))),
                        ],
                        ["block", "ids", "floors", "vectors"],
                    )

    return queries.select("id", "v", "floor").mapInArrow(run, PACK)


def visit(packs: DataFrame, blocks: DataFrame, index: Index, k: int) -> DataFrame:
    """(query_id, vec_id, score): for every pack and block the k best of each query that reach its floor."""
    sent = packs.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = sent.value
        held: tuple | None = None
        for batch in batches:
            for row in batch.to_pylist():
                if held is None or held[0] != row["block"]:
                    held = (row["block"], np.frombuffer(row["members"], np.int64), np.frombuffer(row["reaches"], np.float64), np.frombuffer(row["values"], np.int64).reshape(-1, index.width).astype(np.float64))
                _, ids, reach, stored = held
                queries = matrix(pa.array(row["vectors"], pa.list_(pa.int64())), index.width)
                away = distances(np.c_[queries, np.zeros(len(queries))], index.pivots[row["pivot"]][None])[:, 0]
                norms = (queries**2).sum(1)
                floor = np.array([np.nan if f is None else f for f in row["floors"]], float)
                limit = np.sqrt(np.maximum(norms + index.largest - 2 * floor, 0)) + index.slack
                limit = np.where(np.isnan(limit), np.inf, limit)
                start = np.searchsorted(reach, away - limit - index.slack, "left")
                stop = np.searchsorted(reach, away + limit + index.slack, "right")
                out = []
                a, b = int(start.min()), int(stop.max())
                score = scores_of(queries, stored[a:b])
                for i, query in enumerate(row["ids"]):
                    s, e = int(start[i]) - a, int(stop[i]) - a
                    got, own = score[i, s:e], ids[a + s : a + e]
                    use = own != query
                    if row["floors"][i] is not None:
                        use &= got >= row["floors"][i]
                    got, own = got[use], own[use]
                    if len(got) > k:
                        edge = np.partition(got, len(got) - k)[len(got) - k]
                        near = got >= edge
                        got, own = got[near], own[near]
                    best = np.lexsort((own, -got))[:k]
                    out += [(query, int(own[j]), int(got[j])) for j in best]
                if out:
                    yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], ["query_id", "vec_id", "score"])

    # Spark cannot know how many packs there will be; without the hint it may take them for small and broadcast them.
    return packs.join(blocks.hint("merge"), "block").mapInArrow(run, "query_id long, vec_id long, score long")


def packed_blocks(placed: DataFrame, index: Index) -> DataFrame:
    """One row per block: its pivot, and ids, distances and components of its rows, sorted by distance."""
    width = index.width

    def pack(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by([("reach", "ascending"), ("id", "ascending")])
        values = matrix(table.column("v").combine_chunks(), width).astype(np.int64)
        return pa.table(
            {
                "block": [key[0].as_py()],
                "pivot": pa.array([table.column("pivot")[0].as_py()], pa.int32()),
                "members": [table.column("id").to_numpy().tobytes()],
                "reaches": [table.column("reach").to_numpy().tobytes()],
                "values": [values.tobytes()],
            }
        )

    return placed.groupBy("block").applyInArrow(pack, "block long, pivot int, members binary, reaches binary, values binary")


def top_k(vectors: DataFrame, is_query, k: int = 5, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows that ``is_query`` holds for, against all rows but the query's own."""
    steps = Steps(vectors.sparkSession)
    stored = steps.keep(quantised(vectors, vec_id, vector), "stored")
    asked = quantised(vectors.filter(is_query), vec_id, vector).groupBy("id").agg(F.max("v").alias("v"))
    tasks = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # A small table may lie in one file; its queries are dealt to as many tasks as any.
    asked = steps.keep(asked.repartition(tasks, "id"), "asked")
    index, keyed = build(stored, steps)
    blocks = steps.keep(packed_blocks(with_block(keyed, index), index), "blocks")
    known, found, after = asked.withColumn("floor", F.lit(None).cast("long")), None, 0
    for turn, size in enumerate((*STEPS, None)):
        upto = None if size is None else after + size
        seen = visit(requests(known.repartition(tasks, "id"), index, after, upto, PACK_QUERIES), blocks, index, k)
        both = best(seen if found is None else seen.union(found), k)
        if upto is None:
            return both.select("query_id", "rank", "vec_id", "score")
        ranked = steps.keep(both, f"found-{turn}")
        floors = ranked.filter(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").alias("floor"))
        known, found, after = asked.join(floors, "id", "left"), ranked.select("query_id", "vec_id", "score"), upto


def best(found: DataFrame, k: int) -> DataFrame:
    """The first k of each query, by score and then the smaller id; Spark cuts each task's rows to k before the shuffle."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
