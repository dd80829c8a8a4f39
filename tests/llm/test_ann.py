import numpy as np
import pytest
from pyspark.sql import functions as F

from fundscope.llm import ann, queries

SCHEMA = "vec_id long, embedding array<float>, extra string"


def brute(rows, k=10):
    good = [(i, np.array(v, np.float32).astype(float)) for i, v, *_ in rows if i is not None and v
            and all(x is not None and np.isfinite(x) for x in v) and any(x != 0 for x in v)]
    out = {}
    for q, x in good:
        if q % 100 == 0:
            d = sorted((float(np.sqrt(((y - x) ** 2).sum())), i) for i, y in good if i != q)
            out[q] = d[:k]
    return out


def test_recall_and_exact_scores(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.op5_neighbours(spark, sf).collect()
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    want = brute(rows)
    hits = 0
    vectors = {i: np.array(v, np.float32).astype(float) for i, v in rows}
    for q, near in want.items():
        own = sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in own] == list(range(1, 11))
        assert [(r.score, r.vec_id) for r in own] == sorted((r.score, r.vec_id) for r in own)
        assert all(np.isclose(r.score, np.sqrt(((vectors[q] - vectors[r.vec_id]) ** 2).sum()),
                              rtol=1e-12) for r in own)
        hits += len({i for _, i in near} & {r.vec_id for r in own})
    assert hits / (10 * len(want)) >= 0.9


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], "x"), (1, [0.0, 0.0], "x"), (2, None, "x"), (3, [nan, 1.0], "x"),
            (4, [inf, 1.0], None), (5, [None, 1.0], "x"), (6, [], "x"), (None, [1.0, 1.0], "x"),
            (7, [1.0, 0.0], "x"), (8, [1.0, 0.0], "x"), (9, [1.0, 2.0], "x"), (9, [1.0, 2.0], "x"),
            (100, [3.0, 0.0], "x"), (200, [0.0, 0.0], "x"), (300, [1.0], "x")]
    got = ann.search(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 100 == 0).collect()
    found = {q: [(r.vec_id, round(r.score, 6)) for r in sorted(got, key=lambda r: r["rank"])
                 if r.query_id == q] for q in (0, 100)}
    assert found[0] == [(7, 0.0), (8, 0.0), (9, 2.0), (9, 2.0), (100, 2.0)]
    assert [i for i, _ in found[100]] == [0, 7, 8, 9, 9]
    assert {r.query_id for r in got} == {0, 100}
    assert ann.search(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 100 == 0).count() == 0


@pytest.mark.parametrize("block", [7, 50])
def test_blocks_change_nothing(spark, monkeypatch, block):
    """A hot vector (a third of all rows) over many small blocks; all parts probed: exact."""
    rng = np.random.default_rng(0)
    rows = [(i, ([1.0] * 8 if i % 3 == 0 else rng.normal(size=8).tolist()), "x") for i in range(900)]
    monkeypatch.setattr(ann, "BLOCK", block)
    monkeypatch.setattr(ann, "QUERIES_PER_BLOCK", 2)
    got = ann.search(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 100 == 0,
                     probes=ann.PARTS).collect()
    for q, near in brute(rows).items():
        own = sorted((r["rank"], r.vec_id, r.score) for r in got if r.query_id == q)
        assert [i for _, i, _ in own] == [i for _, i in near]
        assert np.allclose([s for *_, s in own], [d for d, _ in near])


def test_parts_are_balanced():
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.normal(size=(600, 6)), rng.normal(size=(200, 6)) + 9])
    part = ann.balanced_parts(x, 8)
    assert np.bincount(part, minlength=8).max() <= np.ceil(ann.SLACK * len(x) / 8)
    assert len(set(part[600:].tolist()) & set(part[:600].tolist())) <= 2


def test_a_query_leaves_out_its_own_row_only(spark):
    rows = [(0, [1.0, 0.0], "x"), (0, [0.0, 5.0], "x"), (1, [2.0, 0.0], "x"), (100, [3.0, 3.0], "x"),
            (100, [3.0, 3.0], "x")]
    got = ann.search(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 100 == 0, k=3).collect()
    lists = sorted((r.query_id, r["rank"], r.vec_id, round(r.score, 4)) for r in got)
    apart = [(0, 1, 1, 1.0), (0, 2, 100, 3.6056), (0, 3, 100, 3.6056),          # of (1, 0)
             (0, 1, 100, 3.6056), (0, 2, 100, 3.6056), (0, 3, 0, 5.099)]        # of (0, 5)
    copies = [(100, 1, 100, 0.0), (100, 2, 1, 3.1623), (100, 3, 0, 3.6056)] * 2
    assert lists == sorted(apart + copies)


def test_clusters_need_few_probes_and_parts_grow():
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(size=(100, 8)) + 20 * rng.normal(size=8) for _ in range(20)])
    model = ann.fit_router(x, ann.balanced_parts(x, 16))
    assert ann.measured_probes(x, model) <= 4
    loose = rng.normal(size=(2000, 32))
    assert ann.measured_probes(loose, ann.fit_router(loose, ann.balanced_parts(loose, 16))) >= 8
    assert ann.parts_for(500) == 16 < ann.parts_for(50_000) < ann.parts_for(10**9) == 62
