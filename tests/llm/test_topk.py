import math
import random

import numpy as np
import pytest
from compare import assert_same_rows
from farebox.llm import topk
from farebox.llm.queries import ORACLES, QUERIES
from farebox.llm.topk import scores_of, top_k
from pyspark.sql import functions as F

KIND = "vec_id long, embedding array<float>, rank int, score string"


def brute_force(rows, k, query):
    stored = []
    for vec_id, v in rows:
        if vec_id is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            stored.append((vec_id, [math.floor(256 * float(np.float32(x))) for x in v]))
    out = []
    for q in {i for i, _ in stored if query(i)}:
        v = max(x for i, x in stored if i == q)
        ranked = sorted((-sum(a * b for a, b in zip(v, x)), i) for i, x in stored if i != q)[:k]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(ranked)]
    return sorted(out)


def check(spark, rows, k=5, every=5):
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], KIND)
    got = sorted(map(tuple, top_k(df, F.col("vec_id") % every == 0, k).collect()))
    assert got == brute_force(rows, k, lambda i: i % every == 0)
    return got


def test_query_equals_sql(spark, data):
    assert assert_same_rows(QUERIES["op4_top_k"](spark, data), data, ORACLES["op4_top_k"]) == 50


def test_clusters_copies_and_ties(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_ROWS", 16)
    monkeypatch.setattr(topk, "LEAST_ROWS", 8)
    monkeypatch.setattr(topk, "PIVOTS", 5)
    monkeypatch.setattr(topk, "PACK_QUERIES", 3)
    draw = np.random.default_rng(4)
    centre = draw.normal(size=(6, 8))
    rows = [(i, (centre[i % 6] + draw.normal(size=8) * 0.2).tolist()) for i in range(400)]
    rows += [(1000 + i, rows[3][1]) for i in range(200)]
    rows += [(2000 + i, (draw.normal(size=8) * 10.0 ** draw.integers(-3, 3)).tolist()) for i in range(40)]
    random.Random(1).shuffle(rows)
    assert len(check(spark, rows)) > 500


def test_odd_vectors(spark):
    rows = [(None, [1.0, 2.0]), (5, None), (10, [1.0, None]), (15, [1.0, float("nan")]), (20, [float("inf"), 0.0]), (25, []), (30, [0.0, 0.0])]
    rows += [(35, [0.5, -0.5]), (35, [0.5, -0.5]), (40, [1.0]), (41, [1.0, 0.25]), (41, [0.25, 1.0]), (42, [-0.001, 3.0, 1.0])]
    check(spark, rows)
    check(spark, [(5, [1.0]), (6, [2.0])])
    check(spark, [(5, [1.0])])
    check(spark, [])


def test_too_large_components_are_an_error(spark):
    with pytest.raises(Exception, match="too large"):
        check(spark, [(5, [1e30]), (6, [1.0])])


def test_scores_stay_exact_beyond_doubles():
    a, b = np.array([[2.0**28, 3.0]]), np.array([[2.0**28, 1.0], [2.0**28 - 1, 7.0]])
    assert scores_of(a, b).tolist() == [[2**56 + 3, 2**28 * (2**28 - 1) + 21]]


def test_one_id_many_times_fills_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk, "LEAST_ROWS", 32)
    rows = [(5, [1.0, 2.0, 0.5])] * 3000 + [(i, [float(i % 7), 1.0, 0.25]) for i in range(10, 60)]
    assert len(check(spark, rows)) > 10
    from farebox.llm.scratch import Steps

    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], KIND)
    index, keyed = topk.build(topk.quantised(df, "vec_id", "embedding"), Steps(spark))
    sizes = [r["count"] for r in topk.with_block(keyed, index).groupBy("block").count().collect()]
    assert sum(sizes) == len(rows) and max(sizes) < 700


def test_pivots_grow_with_the_table(spark, monkeypatch):
    from farebox.llm.scratch import Steps

    monkeypatch.setattr(topk, "PIVOTS", 4)
    for rows in (50, 900):
        df = spark.range(rows).select("id", F.array(*[(F.rand(k) * 256).cast("long") for k in range(4)]).alias("v"))
        index, _ = topk.build(df, Steps(spark))
        assert len(index.pivots) == max(4, int(rows**0.5 / 2))
