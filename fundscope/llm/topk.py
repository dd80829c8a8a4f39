"""Exact top-k inner products of integer vectors, in order of length.

Vectors are rows of whole numbers held as doubles. A bounded sample gives a rotation (right
singular vectors, by falling singular value), so that the first rotated components carry most
of a product. Rows are sorted by falling Euclidean length and cut into blocks of about
``BLOCK`` rows. The longest rows, at most ``SEEDS``, are a first answer: they give each query
a lower bound on its k-th best score. By Cauchy-Schwarz a query can be skipped by every block
whose longest row times the query's length stays below that bound; queries are sorted by
bound / length, so the blocks that a block of queries needs are the first ones. Within a pair of blocks
the rows are met by falling length: the partial sums of the first rotated components
plus the product of the residual lengths bound a score from above; what stays at or above the
running bound is multiplied exactly, on the integers. Pruning never removes a possible tie.

Products are exact: in doubles where 53 bits hold every partial sum, else with whole
numbers of any size. A score beyond 64 bits is ranked exactly and shown as the nearest long.
All bounds carry a margin for rounding.

Rows meet in blocks (queries are a stated set; no pair of rows is ever a row of a join), each
pair of blocks returns at most k rows a query, and a final window keeps the k best.

Cases: null vectors and those with a null or non-finite component (also after scaling) take no
part. Vectors of different lengths meet with zeros behind the shorter; an empty vector has
score 0 with everything. Rows with equal id and vector are merged with their number, and count as
that many candidates and queries; a query's own row is taken off once. A null id is no query, it
is a candidate that comes last in ties. Fewer candidates than k give all of them. An empty table
gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fundscope.llm.common import HASH_SEED, stored

K = 5
SCALE = 256
SAMPLE = 4096                   # expected rows that fit the rotation; it changes time only
MAX_WIDTH = 1024                # the rotation is fitted for vectors up to this length
SEEDS = 2048
BLOCK = 8192
QUERY_BLOCK = 8192
STEP = 1024                     # rows met at once, by falling length
PAIRS = 1 << 14                 # pairs multiplied at once
HEAD = 0.5                      # share of the components in the partial sums
MARGIN = 1e-9                   # far above the rounding of the sums, relative to the lengths
BANDS = 256                     # steps in which blocks are left out
EXACT = float(1 << 53)


def whole(vectors: DataFrame, scale: float, id_col: str, vec_col: str) -> DataFrame:
    """``vec_id, v, n, length``: floor(scale x) of the usable vectors, equal rows merged."""
    v = F.col("v")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    # floor() of a double is a long in Spark: beyond 2**53 a double is whole already
    floor = lambda x: F.when(F.abs(x) < EXACT, F.floor(x).cast("double")).otherwise(x)
    rows = (vectors.select(F.col(id_col).cast("long").alias("vec_id"),
                           F.transform(F.col(vec_col).cast("array<double>"),
                                       lambda x: floor(x * scale) + F.lit(0.0)).alias("v"))
            .where(F.coalesce(finite, F.lit(False))))
    return (rows.groupBy("vec_id", "v").agg(F.count("*").alias("n"))
            .withColumn("length", F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x))))


def matrix(lists: pa.Array, width: int) -> np.ndarray:
    """Rows of doubles, zeros behind the shorter ones."""
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    size = np.diff(lists.offsets.to_numpy())
    flat = np.asarray(lists.flatten(), float)
    out = np.zeros((len(size), max(width, int(size.max(initial=0)))))
    row = np.repeat(np.arange(len(size)), size)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return out


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact products of pairs of rows; objects where 53 bits do not hold them."""
    size = np.abs(q).max(1, initial=0) * np.abs(x).max(1, initial=0) * max(q.shape[1], 1)
    if size.max(initial=0) < EXACT:
        return np.einsum("ij,ij->i", q, x).astype(np.int64)
    return np.array([sum(int(a) * int(b) for a, b in zip(r, s, strict=True))
                     for r, s in zip(q, x, strict=True)], object)


def rotation(rows: DataFrame, total: int, width: int, sample: int = SAMPLE) -> np.ndarray:
    """Orthogonal matrix of right singular vectors of a bounded sample (identity if too wide)."""
    if width > MAX_WIDTH or not width:
        return np.eye(0)
    draw = F.pmod(F.xxhash64(F.lit(HASH_SEED), "vec_id", "v"), F.lit(1 << 30))
    table = rows.where(draw < sample / max(total, 1) * (1 << 30)).select("v").toArrow()
    if not table.num_rows:
        return np.eye(width)
    x = matrix(table["v"], width)
    x = x / max(np.abs(x).max(), 1.0)
    return np.linalg.svd(np.concatenate([x, np.zeros((width, width))]), full_matrices=False)[2].T


def rotated(x: np.ndarray, turn: np.ndarray) -> np.ndarray:
    if not len(turn):
        return x
    return np.concatenate([x[:, :len(turn)] @ turn, x[:, len(turn):]], 1)


class Best:
    """The k best (score, id) of each query so far."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.found: list[list[tuple]] = [[] for _ in range(queries)]

    def add(self, query, score, ids, none, times) -> set[int]:
        """Adds candidates; gives the queries that got some. Null ids come last in ties."""
        touched = set(query.tolist())
        for q, s, i, x, n in zip(query.tolist(), score.tolist(), ids.tolist(), none.tolist(),
                                 times.tolist(), strict=True):
            self.found[q] += [(-s, x, i)] * min(n, self.k)
        for q in touched:
            self.found[q] = sorted(self.found[q])[: self.k]
        return touched

    def bound(self, q: int) -> float:
        """The k-th best score, or -inf; rounded down so that a tie stays above it."""
        own = self.found[q]
        if len(own) < self.k:
            return -math.inf
        try:
            return math.nextafter(float(-own[-1][0]), -math.inf)
        except OverflowError:
            return -math.inf if own[-1][0] > 0 else sys.float_info.max


def search_block(q: dict, rows: dict, turn: np.ndarray, k: int) -> Best:
    """The k best rows for each query of a block; rows are met by falling length.

    ``q`` has ids, width, x, n and bound; ``rows`` ids, none, width, x and n.
    """
    best = Best(len(q["x"]), k)
    width = max(q["x"].shape[1], rows["x"].shape[1], len(turn), 1)
    qx, x = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (q["x"], rows["x"]))
    with np.errstate(over="ignore", invalid="ignore"):
        length = np.sqrt((x * x).sum(1))
        order = np.argsort(-length, kind="stable")
        sorted_rows = {c: rows[c][order] for c in ("ids", "none", "width", "n")} | {
            "x": x[order], "length": length[order]}
        xr = rotated(sorted_rows["x"], turn)
        head = max(1, int(width * HEAD))
        sorted_rows |= {"head": xr[:, :head], "rest": np.sqrt((xr[:, head:] ** 2).sum(1))}
        for i in range(0, len(qx), STEP):
            _search_step(q, qx, slice(i, i + STEP), sorted_rows, turn, head, best)
    return best


def _search_step(q: dict, qx: np.ndarray, queries: slice, rows: dict, turn: np.ndarray, head: int,
                 best: Best) -> None:
    x, length, k = rows["x"], rows["length"], best.k
    bound = q["bound"][queries].copy()
    first = queries.start
    qx = qx[queries]
    qr = rotated(qx, turn)
    rest, size = np.sqrt((qr[:, head:] ** 2).sum(1)), np.sqrt((qx * qx).sum(1))
    small = (np.abs(qx).max(initial=0) * np.abs(x).max(initial=0) * qx.shape[1]) < EXACT
    live = np.arange(len(qx))
    for i in range(0, len(x), STEP):
        part = slice(i, i + STEP)
        # comparisons are turned round so that what overflows stays in
        live = live[~(size[live] * length[i] * (1 + MARGIN) < bound[live])]
        if not len(live):
            break
        upper = qr[live, :head] @ rows["head"][part].T
        upper += rest[live, None] * rows["rest"][None, part]
        upper += MARGIN * size[live, None] * length[i]
        may = ~(upper < bound[live, None])
        if small and may.mean() > 0.05:                    # most rows are needed: whole products
            score = qx[live] @ x[part].T
            at = max(0, score.shape[1] - k - 1)            # one more, for the query's own row
            edge = np.partition(score, at, 1)[:, at]
            a, r = np.nonzero(score >= np.maximum(edge, bound[live])[:, None])
            chunks = [(live[a], r + i, score[a, r].astype(np.int64))]
        else:
            a, r = np.nonzero(may)
            a, r = live[a], r + i
            chunks = ((u, v, products(qx[u], x[v])) for u, v in (
                (a[j: j + PAIRS], r[j: j + PAIRS]) for j in range(0, len(a), PAIRS)))
        for a, r, score in chunks:
            own = ((rows["ids"][r] == q["ids"][a + first]) & (rows["width"][r] == q["width"][a + first])
                   & ~rows["none"][r])
            own[own] = (x[r[own]] == qx[a[own]]).all(1)
            n = rows["n"][r] - own
            good = (n > 0) & np.array(score >= bound[a], bool)
            a, r, score, n = a[good], r[good], score[good], n[good]
            if score.dtype != object:                      # the k best of these are enough
                by = np.lexsort((rows["ids"][r], rows["none"][r], -score, a))
                by = by[np.arange(len(by)) - np.searchsorted(a[by], a[by]) < k]
                a, r, score, n = a[by], r[by], score[by], n[by]
            for t in best.add(a + first, score, rows["ids"][r], rows["none"][r], n):
                bound[t - first] = max(bound[t - first], best.bound(t))


LONG = (-(1 << 63), (1 << 63) - 1)
FOUND = "query_id long, times long, query_key long, vec_id long, score long, high string"


def _rows(table) -> dict:
    ids = table["vec_id"]
    lists = table["v"].combine_chunks() if isinstance(table["v"], pa.ChunkedArray) else table["v"]
    return {"ids": np.asarray(pc.fill_null(ids, 0), np.int64), "none": np.asarray(pc.is_null(ids), bool),
            "width": np.asarray(pc.list_value_length(lists), np.int64), "x": matrix(lists, 0),
            "n": np.asarray(table["n"], np.int64)}


def _sort_key(score: int) -> str:
    """Text that sorts like the exact score (falling scores first are asked for by desc)."""
    digits = str(abs(score))
    if score >= 0:
        return f"1{len(digits):05d}{digits}"
    return f"0{99999 - len(digits):05d}" + "".join(chr(105 - ord(c)) for c in digits)


def _pair_of_blocks(turn_shared, k: int):
    def run(queries: pa.Table, rows: pa.Table) -> pa.Table:
        names = ["query_id", "times", "query_key", "vec_id", "score", "high"]
        out: list[list] = [[] for _ in names]
        if queries.num_rows and rows.num_rows:
            q = _rows(queries)
            q["bound"] = np.asarray(queries["bound"], float)
            best = search_block(q, _rows(rows), turn_shared.value, k)
            keys = queries["query_key"].to_pylist()
            for i, found in enumerate(best.found):
                for s, none, vec in found:
                    for c, x in zip(out, (q["ids"][i], q["n"][i], keys[i], None if none else vec,
                                          min(max(-s, LONG[0]), LONG[1]), _sort_key(-s)), strict=True):
                        c.append(x)
        return pa.table([*[pa.array(c, pa.int64()) for c in out[:5]], pa.array(out[5], pa.string())],
                        names)
    return run


def _bounds(seeds_shared, turn_shared, k: int):
    """Adds ``bound``: the k-th best score among the longest rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            q = _rows(batch)
            q["bound"] = np.full(len(q["x"]), -np.inf)
            best = search_block(q, seeds_shared.value, turn_shared.value, k)
            bound = pa.array([best.bound(i) for i in range(len(q["x"]))], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, bound], [*batch.schema.names, "bound"])
    return run


def laid(rows: DataFrame, *order: Column, size: int, name: str) -> tuple[DataFrame, int]:
    """The rows in blocks 0, 1, ... of about ``size`` rows, in the given order, and their number."""
    blocks = max(1, -(-rows.count() // size))
    dealt = stored(rows.repartitionByRange(blocks, *order, F.xxhash64("vec_id", "v"))
                   .withColumn("dealt", F.spark_partition_id()), name)
    parts = dealt.agg(F.max("dealt")).first()[0]
    blocks = min(blocks, (parts or 0) + 1)
    block = F.floor(F.col("dealt") * blocks / ((parts or 0) + 1)).cast("int")
    return dealt.withColumn(name, block).drop("dealt"), blocks


def search(vectors: DataFrame, is_query: Column, k: int = K, scale: float = SCALE,
           id_col: str = "vec_id", vec_col: str = "embedding", sample: int = SAMPLE,
           seeds: int = SEEDS, block: int = BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """``query_id, rank, vec_id, score``; ``is_query`` is a condition on the id column ``vec_id``."""
    spark = vectors.sparkSession
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    rows = stored(whole(vectors, scale, id_col, vec_col), "whole-vectors")
    about = rows.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("width")).first()
    if not about.n:
        return empty
    turn = rotation(rows, about.n, about.width, sample)
    shared = spark.sparkContext.broadcast(turn)
    top = rows.orderBy(F.desc("length"), "vec_id", "v").limit(seeds).toArrow()
    seeded = spark.sparkContext.broadcast(_rows(top))      # at most ``seeds`` rows
    asked = rows.where(F.coalesce(is_query, F.lit(False)) & F.col("vec_id").isNotNull())
    fields = "vec_id long, v array<double>, n long, length double"
    asked = asked.select("vec_id", "v", "n", "length").mapInArrow(
        _bounds(seeded, shared, k), fields + ", bound double")
    # a row shorter than ``need`` cannot reach the bound (margin as within a block)
    need = F.when(F.col("bound") > 0, F.col("bound") / F.greatest(F.col("length"), F.lit(1e-300))
                  * (1 - 2 * MARGIN)).otherwise(F.lit(-1.0))
    asked = stored(asked.withColumn("need", need).withColumn("query_key", F.xxhash64("vec_id", "v")),
                   "bounds")
    row_blocks, n_rows = laid(rows, F.desc("length"), size=block, name="rb")
    query_blocks, n_queries = laid(asked, F.col("need"), size=query_block, name="qb")
    # The blocks of rows lie in at most BANDS bands of falling length. A query needs the first
    # bands, down to its ``need``; blocks of queries needed by a band are again the first ones.
    band = F.floor(F.col("rb") * BANDS / max(n_rows, BANDS)).cast("int")
    longest = {r.band: r.longest for r in row_blocks.groupBy(band.alias("band")).agg(
        F.max("length").alias("longest")).collect()}       # at most BANDS rows
    levels = F.array(*[F.lit(float(longest[b])) for b in sorted(longest)])
    bands = F.array(*[F.lit(b) for b in sorted(longest)])
    deep = F.size(F.filter(levels, lambda x: x >= F.col("need")))
    query_blocks = query_blocks.withColumn("bands", deep)
    last = {r.bands: r.qb for r in query_blocks.groupBy("bands").agg(F.max("qb").alias("qb")).collect()}
    asking = [max([q for b, q in last.items() if b > i], default=-1) for i in range(len(longest))]
    last_qb = F.get(F.array(*[F.lit(x) for x in asking]), F.array_position(bands, band).cast("int") - 1)
    first_blocks = F.array(*[F.lit(-(-b * max(n_rows, BANDS) // BANDS)) for b in sorted(longest)] + [F.lit(n_rows)])
    row_side = (row_blocks.withColumn("last_qb", last_qb).where("last_qb >= 0")
                .select("rb", F.explode(F.sequence(F.lit(0), "last_qb")).alias("qb"), "vec_id", "v", "n"))
    query_side = (query_blocks.where("bands > 0").select(
        F.explode(F.sequence(F.lit(0), F.get(first_blocks, F.col("bands")) - 1)).alias("rb"),
        "qb", "vec_id", "v", "n", "bound", "query_key"))
    found = (query_side.groupBy("rb", "qb").cogroup(row_side.groupBy("rb", "qb"))
             .applyInArrow(_pair_of_blocks(shared, k), FOUND))
    nth = F.row_number().over(Window.partitionBy("query_id", "query_key").orderBy(
        F.desc("high"), F.asc_nulls_last("vec_id")))
    return (found.withColumn("rank", nth).where(F.col("rank") <= k)
            .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "times")))
            .select("query_id", "rank", "vec_id", "score"))
