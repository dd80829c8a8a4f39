import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from fundscope.llm import topk

SCHEMA = "vec_id long, embedding array<double>"


def brute(rows, k, every):
    used = []
    for i, v in rows:
        if v is not None and all(x is not None and math.isfinite(256.0 * x) for x in v):
            used.append((i, [math.floor(256.0 * x) for x in v]))
    out = []
    for a, (i, v) in enumerate(used):
        if i is None or i % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), j is None, j or 0)
                        for b, (j, w) in enumerate(used) if a != b)[:k]
        out += [(i, r, None if none else j, max(min(-s, 2**63 - 1), -2**63))
                for r, (s, none, j) in enumerate(scored, 1)]
    return sorted(out, key=str)


def found(spark, rows, every=10, **options):
    vectors = spark.createDataFrame(rows, SCHEMA).withColumns(
        {c: F.lit("own") for c in ("v", "n", "rank", "score", "rb", "query_key", "length")})
    got = topk.search(vectors, F.col("vec_id") % every == 0, **options)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted(map(tuple, got.collect()), key=str)


def vectors(n=200):
    rng = np.random.default_rng(0)
    return [(i, (rng.normal(size=8) * rng.choice([0.1, 1, 10])).tolist()) for i in range(n)]


ODD = [(None, [0.5] * 8), (None, None), (7, None), (8, [1.0, None]), (9, [math.nan] * 8), (10, []),
       (10, [1.0]), (10, [1.0, 0.0]), (11, [math.inf]), (12, [1e300] * 3), (13, [-1e300] * 3),
       (14, [1e20] * 8), (20, [1e306]), (30, [0.0] * 8), (30, [-0.0] * 8), (40, [1.5] * 20)]


@pytest.mark.parametrize("options", [{}, {"block": 16, "query_block": 7, "seeds": 3, "sample": 50}])
def test_equals_brute_force(spark, options):
    rows = vectors()
    rows += [(0, rows[0][1])] * 3 + [(1, rows[1][1])] * 2 + ODD
    assert found(spark, rows, **options) == brute(rows, 5, 10)


def test_few_rows(spark):
    assert found(spark, []) == []
    assert found(spark, [(10, [1.0])]) == []
    assert found(spark, [(3, [1.0])]) == []
    same = [(10, [1.0])] * 3
    assert found(spark, same) == brute(same, 5, 10)


def test_ties_and_a_hot_vector(spark):
    rows = [(i, [1.0, 2.0]) for i in range(600)] + [(i, [-1.0, 0.5]) for i in range(600, 640)]
    assert found(spark, rows, 50, block=64, query_block=4, seeds=8) == brute(rows, 5, 50)


def test_short_rows_are_never_met(spark):
    """Blocks of short rows get no queries where long ones bound the answer."""
    long = [(i, [100.0 + i % 7, 1.0]) for i in range(50)]
    short = [(i, [0.5, 0.5]) for i in range(50, 400)]
    met = []
    turn = np.eye(2)
    q = {"ids": np.zeros(1, int), "width": np.full(1, 2), "x": np.array([[25600.0, 256.0]]),
         "n": np.ones(1, int), "bound": np.array([-np.inf])}
    x = np.floor(256 * np.array([v for _, v in long + short]))
    rows = {"ids": np.arange(1, len(x) + 1), "none": np.zeros(len(x), bool),
            "width": np.full(len(x), 2), "x": x, "n": np.ones(len(x), int)}
    whole = topk.products
    try:
        topk.products = lambda a, b: met.append(len(a)) or whole(a, b)
        topk.STEP, step = 32, topk.STEP
        best = topk.search_block(q, rows, turn, 5)
    finally:
        topk.products, topk.STEP = whole, step
    scores = sorted((x @ q["x"][0]).astype(int).tolist(), reverse=True)[:5]
    assert [-s for s, _, _ in best.found[0]] == scores
    assert sum(met) < 64


def test_rotation_keeps_products(spark):
    rows = topk.whole(spark.createDataFrame(vectors(), SCHEMA), 256, "vec_id", "embedding")
    turn = topk.rotation(rows, 200, 8)
    assert np.allclose(turn @ turn.T, np.eye(8), atol=1e-9)
    x = np.random.default_rng(1).normal(size=(5, 10))
    assert np.allclose(topk.rotated(x, turn) @ topk.rotated(x, turn).T, x @ x.T)
