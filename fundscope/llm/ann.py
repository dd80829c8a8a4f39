"""Approximate nearest neighbours by learned partitions.

On a bounded sample (``SAMPLE`` rows expected, chosen by a hash) the exact neighbour graph
is built and cut into balanced parts: seeds grow along the graph, and rounds of moves take
each vector to the part that holds most of its neighbours, as far as the part has room.
A small softmax classifier then learns the part from the vector. It puts every row into its
likeliest part, and routes each query to its likeliest parts, whose rows are
reranked by exact Euclidean distance on the original vectors in double precision.

The number of parts grows with the root of the rows, up to what the sample can teach. How many
parts a query probes is measured: the fewest that hold ``TARGET`` of the true neighbours of
sampled vectors within the sample. Clustered vectors need one or two; vectors without clusters need most
parts, and if the target takes all of them the search is exact.

Rows and queries meet in blocks: a part is dealt over blocks of about ``BLOCK`` rows and
its queries over blocks of about ``QUERIES_PER_BLOCK``, so a hot part (a third of all
vectors alike) is many tasks. Each block returns at most k rows per query; a final
aggregate keeps the k nearest.

Cases: null, empty, zero, and non-finite vectors take no part, nor do vectors of another
length than the most frequent one. Ties go to the smaller id. Rows with a null id are
neither queries nor candidates. Repeated ids are candidates of their own. Fewer candidates
than k give all of them. A query leaves out its own row and no other: rows of the same id with
another vector are candidates, and so are further copies of the row. Queries with
one id and different vectors are answered apart. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fundscope.llm.common import HASH_SEED, stored

SAMPLE = 6000
PARTS = 16                      # at least
ROWS_A_SAMPLE_PART = 96         # sampled vectors that a part needs to be learned
TARGET = 0.97                   # share of true neighbours in the probed parts, on the sample
ASKED = 500                     # sampled vectors that measure it
GRAPH_NEIGHBOURS = 10
SLACK = 1.1                     # a part may hold this many times its equal share of the sample
BLOCK = 4096
QUERIES_PER_BLOCK = 1024
K = 10


def usable(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``vec_id, v`` (array<double>) of the rows that take part."""
    v = F.col(vec_col).cast("array<double>")
    rows = (vectors.select(F.col(id_col).alias("vec_id"), v.alias("v"))
            .where(F.col("vec_id").isNotNull()).where(
                F.col("v").isNotNull() & (F.size("v") > 0)))
    v = F.col("v")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return rows.where(F.coalesce(finite, F.lit(False)) & F.exists(v, lambda x: x != 0))


def balanced_parts(x: np.ndarray, parts: int, seed: int = 0) -> np.ndarray:
    """Balanced partition of the neighbour graph of a bounded sample."""
    n = len(x)
    parts = max(1, min(parts, n))
    room = int(np.ceil(SLACK * n / parts))
    k = min(GRAPH_NEIGHBOURS, n - 1)
    sq = (x * x).sum(1)
    near = np.empty((n, k), np.int64)
    for i in range(0, n, 1024):                            # sample rows against the sample
        d = sq[i: i + 1024, None] - 2 * x[i: i + 1024] @ x.T + sq
        d[np.arange(len(d)), np.arange(i, i + len(d))] = np.inf
        near[i: i + 1024] = np.argpartition(d, k - 1, 1)[:, :k] if k else 0
    # seeds far apart, first parts by distance to them within each part's room
    rng = np.random.default_rng(seed)
    seeds = [int(rng.integers(n))]
    away = np.full(n, np.inf)
    for _ in range(1, parts):
        away = np.minimum(away, ((x - x[seeds[-1]]) ** 2).sum(1))
        seeds.append(int(rng.choice(n, p=away / away.sum())) if away.sum() > 0
                     else int(rng.integers(n)))
    centre = x[seeds]
    part = np.zeros(n, np.int64)
    for _ in range(5):                                     # balanced centres to start from
        d = (centre * centre).sum(1) - 2 * x @ centre.T
        part = _fill(-d, room)
        centre = np.stack([x[part == p].mean(0) if (part == p).any() else centre[p]
                           for p in range(parts)])
    both = np.concatenate([near, np.arange(n)[:, None]], 1)
    for _ in range(10):                                    # moves along the graph
        votes = np.zeros((n, parts))
        np.add.at(votes, (np.repeat(np.arange(n), both.shape[1]), part[both].ravel()), 1)
        np.add.at(votes, (near.ravel(), np.repeat(part, k)), 1)    # edges count both ways
        moved = _fill(votes + 1e-3 * np.eye(parts)[part], room)
        if (moved == part).all():
            break
        part = moved
    return part


def _fill(score: np.ndarray, room: int) -> np.ndarray:
    """Each row to its best part that has room; rows that lose most by another go first."""
    top = np.partition(score, -2, 1) if score.shape[1] > 1 else score
    urgency = top[:, -1] - (top[:, -2] if score.shape[1] > 1 else 0)
    wish = np.argsort(-score, 1, kind="stable")
    left = np.full(score.shape[1], room)
    part = np.empty(len(score), np.int64)
    for i in np.argsort(-urgency, kind="stable"):
        for p in wish[i]:
            if left[p]:
                part[i] = p
                left[p] -= 1
                break
    return part


def fit_router(x: np.ndarray, part: np.ndarray, epochs: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """Softmax classifier (weights, intercepts) of the part, by batches with momentum."""
    parts = int(part.max()) + 1 if len(part) else 1
    scale = 1 / max(np.sqrt((x * x).mean() * x.shape[1]), 1e-30) if len(x) else 1.0
    z = x * scale
    w, b = np.zeros((x.shape[1], parts)), np.zeros(parts)
    mw, mb = np.zeros_like(w), np.zeros_like(b)
    target = np.eye(parts)[part]
    order = np.random.default_rng(1)
    for epoch in range(epochs):
        for rows in np.array_split(order.permutation(len(z)), max(1, len(z) // 256)):
            m = z[rows] @ w + b
            p = np.exp(m - m.max(1, keepdims=True))
            p = p / p.sum(1, keepdims=True) - target[rows]
            mw = 0.9 * mw - 2.0 / (1 + 0.05 * epoch) * (z[rows].T @ p / len(rows) + 1e-5 * w)
            mb = 0.9 * mb - 2.0 / (1 + 0.05 * epoch) * p.mean(0)
            w, b = w + mw, b + mb
    return w * scale, b


def parts_for(total: int, sample: int = SAMPLE) -> int:
    """Number of parts: an eighth of the root of the rows, within what the sample can teach."""
    return max(PARTS, min(int(np.sqrt(total) / 8), sample // ROWS_A_SAMPLE_PART))


def measured_probes(x: np.ndarray, model, k: int = K, target: float = TARGET) -> int:
    """The fewest parts that hold ``target`` of the k nearest of sampled vectors in the sample."""
    w, b = model
    order = np.argsort(-(x @ w + b), 1, kind="stable")
    home = order[:, 0]
    asked = np.random.default_rng(2).permutation(len(x))[:ASKED]
    k = min(k, len(x) - 1)
    if k < 1:
        return w.shape[1]
    sq = (x * x).sum(1)
    d = sq[asked, None] - 2 * x[asked] @ x.T + sq
    d[np.arange(len(asked)), asked] = np.inf
    near = np.argpartition(d, k - 1, 1)[:, :k]
    rank = np.argsort(order[asked], 1)                     # place of each part in a query's order
    met = np.bincount(np.take_along_axis(rank, home[near], 1).ravel(), minlength=w.shape[1])
    return int(np.searchsorted(np.cumsum(met) / met.sum(), target) + 1)


def train(rows: DataFrame, total: int, sample: int = SAMPLE, parts: int | None = None):
    """The router, fitted on a bounded sample of the usable rows, and the parts to probe."""
    draw = F.pmod(F.xxhash64(F.lit(HASH_SEED), "vec_id"), F.lit(1 << 30))
    table = rows.where(draw < sample / max(total, 1) * (1 << 30)).orderBy("vec_id").toArrow().to_pandas()
    x = np.array(table.v.tolist(), float)
    if not len(x):
        return None
    model = fit_router(x, balanced_parts(x, parts or parts_for(total, sample)))
    return model, min(measured_probes(x, model), model[0].shape[1])


def _router(model, probes: int):
    """Adds ``parts``: the likeliest parts of each vector, best first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, b = model
        for batch in batches:
            v = batch.column("v")
            x = np.asarray(v.flatten()).reshape(batch.num_rows, -1)
            best = np.argsort(-(x @ w + b), 1, kind="stable")[:, :probes].astype(np.int32)
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(0, best.size + 1, best.shape[1]), pa.int32()),
                pa.array(best.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], [*batch.schema.names, "parts"])
    return run


def _rerank(k: int):
    def run(key, queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(queries) and len(rows):
            x, ids, copies = np.stack(rows.v.to_numpy()), rows.vec_id.to_numpy(), rows.n.to_numpy()
            order = np.argsort(ids, kind="stable")
            x, ids, copies = x[order], ids[order], copies[order]
            for qid, key, times, q in zip(queries.query_id, queries.query_key, queries.times, queries.q,
                                          strict=True):
                d = np.sqrt(((x - q) ** 2).sum(1))
                left = copies.copy()
                left[(ids == qid) & (x == q).all(1)] -= 1  # the query's own row
                d[left == 0] = np.inf
                n = min(k, int(np.isfinite(d).sum()))
                if n:
                    edge = np.partition(d, n - 1)[n - 1]
                    best = np.flatnonzero(d <= edge)
                    best = best[np.argsort(d[best], kind="stable")][:n]
                    best = np.repeat(best, np.minimum(left[best], k))[:k]
                    found.append(pd.DataFrame({"query_id": qid, "query_key": key, "times": times,
                                               "vec_id": ids[best], "score": d[best]}))
        return pd.concat(found) if found else pd.DataFrame(
            {"query_id": [], "query_key": [], "times": [], "vec_id": [], "score": []}).astype(
                {"query_id": "int64", "query_key": "int64", "times": "int64", "vec_id": "int64",
                 "score": "float64"})
    return run


def search(vectors: DataFrame, is_query: Column, k: int = K, id_col: str = "vec_id",
           vec_col: str = "embedding", parts: int | None = None, probes: int | None = None,
           sample: int = SAMPLE) -> DataFrame:
    """``query_id, rank, vec_id, score``; ``is_query`` is a condition on the id column ``vec_id``.

    ``parts`` and ``probes`` are chosen from the data unless given.
    """
    spark = vectors.sparkSession
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = usable(vectors, id_col, vec_col)
    lengths = (rows.groupBy(F.size("v").alias("n")).count()
               .orderBy(F.desc("count"), "n").limit(1).collect())
    if not lengths:
        return empty
    rows = rows.where(F.size("v") == lengths[0].n)
    fitted = train(rows, lengths[0]["count"], sample, parts)
    if fitted is None:                                     # too few rows for the draw: all of them
        fitted = train(rows, 0, sample, parts)
    model, measured = fitted
    # equal rows (id and vector) are one, with their number
    schema = "vec_id long, v array<double>, n long, parts array<int>"
    routed = stored(rows.groupBy(F.col("vec_id").cast("long").alias("vec_id"), "v")
                    .agg(F.count("*").alias("n")).mapInArrow(_router(model, probes or measured), schema), "routed")
    kept = routed.select("vec_id", "v", "n", F.col("parts")[0].alias("part"))
    queries = (routed.where(is_query).select("vec_id", "v", F.col("n").alias("times"),
                                             F.explode("parts").alias("part")))
    # one row per part (PARTS rows): how many blocks its rows and its queries need
    sizes = kept.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("row_blocks"))
    asks = queries.groupBy("part").agg(
        F.ceil(F.count(F.lit(1)) / QUERIES_PER_BLOCK).cast("int").alias("query_blocks"))
    blocks = F.broadcast(stored(sizes.join(asks, "part"), "blocks"))
    spread = F.pmod(F.xxhash64("vec_id", "v"), F.lit(1 << 30))
    row_side = (kept.join(blocks, "part")
                .withColumn("rb", (spread % F.col("row_blocks")).cast("int"))
                .withColumn("qb", F.explode(F.sequence(F.lit(0), F.col("query_blocks") - 1)))
                .select("part", "rb", "qb", "vec_id", "v", "n"))
    query_side = (queries.join(blocks, "part")
                  .withColumn("qb", (spread % F.col("query_blocks")).cast("int"))
                  .withColumn("rb", F.explode(F.sequence(F.lit(0), F.col("row_blocks") - 1)))
                  .select(F.col("part").alias("qpart"), F.col("rb").alias("qrb"),
                          F.col("qb").alias("qqb"), F.col("vec_id").alias("query_id"),
                          F.xxhash64("vec_id", "v").alias("query_key"), "times", F.col("v").alias("q")))
    found = (query_side.groupBy("qpart", "qrb", "qqb")
             .cogroup(row_side.groupBy("part", "rb", "qb"))).applyInPandas(
        _rerank(k), "query_id long, query_key long, times long, vec_id long, score double")
    nth = F.row_number().over(Window.partitionBy("query_id", "query_key").orderBy("score", "vec_id"))
    return (found.withColumn("rank", nth).where(F.col("rank") <= k)
            .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "times")))
            .select("query_id", "rank", "vec_id", "score"))
