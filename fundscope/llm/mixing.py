"""Mixing sources to target weights by iterative proportional fitting.

Documents are counted into cells (source, language, topic) of tokens. Raking scales the
cells' token weights until their sums over each dimension meet that dimension's target
shares; the calibrated factor of a cell is its weight over its tokens. Documents are then
drawn independently (Poisson sampling) with probability min(1, c x factor), where c is
solved so that the expected tokens are the wanted share of all tokens.

The cell table, not the documents, goes through the iterations; it stays a DataFrame and
is written to the shared folder once a round, since its size follows the number of
sources. Default targets are tempered shares: p^``TEMPER`` normalised, which lifts small
sources, languages and topics.

The topic of a text, where the table has no topic column, is the bucket of ``TOPICS``
that holds most of its long words by hash (ties: the least bucket; none: bucket 0).

Cases: null source or language is the value ``und``. Null and empty texts have no tokens;
they join their cell, add nothing to its sums, and are drawn with its probability. A cell
without tokens has factor 1. The draw is a hash of id and text, so equal rows are drawn
alike and a repeated run draws the same. An empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fundscope.llm.common import fresh, key_pair, salted_join, stored

TOPICS = 8
LONG_WORD = 6
TEMPER = 0.7
KEEP_SHARE = 0.6
ROUNDS = 30
TOLERANCE = 1e-4
DIMENSIONS = ("source", "lang", "topic")
LONG_WORDS = re.compile(rf"[^\W\d_]{{{LONG_WORD},}}")


def topic_of(text: str) -> int:
    """Bucket with most long words; every occurrence in the whole text counts."""
    words = LONG_WORDS.findall(text.lower())
    if not words:
        return 0
    codes = np.fromiter((zlib.crc32(w.encode()) for w in words), np.uint32, len(words))
    return int(np.bincount(codes % TOPICS, minlength=TOPICS).argmax())


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        tokens, topics = [], []
        for text in batch.column("text").to_pylist():
            text = text or ""
            tokens.append(len(text.split()))
            topics.append(topic_of(text))
        names = [n for n in batch.schema.names if n != "text"]
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(n) for n in names], pa.array(tokens, pa.int64()),
             pa.array(topics, pa.int32())], [*names, "n_tokens", "topic"])


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             source_col: str = "source", lang_col: str = "lang") -> DataFrame:
    """``doc_id, k1, k2, source, lang, n_tokens, topic`` of every row."""
    text = F.col(text_col)
    rows = docs.select(F.col(id_col).alias("doc_id"),
                       *key_pair(F.col(id_col), F.coalesce(text, F.lit(""))),
                       F.coalesce(F.col(source_col).cast("string"), F.lit("und")).alias("source"),
                       F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                       text.alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_measure, f"doc_id {id_type}, k1 long, k2 long, source string, "
                                     "lang string, n_tokens long, topic int")


def cell_tokens(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*DIMENSIONS).agg(F.sum("n_tokens").alias("tokens"),
                                         F.count(F.lit(1)).alias("n_docs"))


def tempered_targets(cells: DataFrame, dimension: str, temper: float = TEMPER) -> DataFrame:
    """``<dimension>, target``: shares of tokens raised to ``temper``, summing to 1."""
    sums = cells.groupBy(dimension).agg(F.sum("tokens").alias("own")).where("own > 0")
    powered = sums.select(dimension, F.pow("own", F.lit(temper)).alias("target"))
    whole = powered.agg(F.sum("target").alias("s"))
    return powered.select(dimension, (F.col("target") / whole.scalar()).alias("target"))


def rake(cells: DataFrame, targets: dict[str, DataFrame], rounds: int = ROUNDS,
         tolerance: float = TOLERANCE) -> DataFrame:
    """Cells with ``factor`` so that sum(tokens x factor) meets every target share.

    ``targets`` maps a dimension to its target table; values without a target get none of
    the mix (factor 0), values without tokens are left out of the sums. Stops when the
    largest deviation of a share is under ``tolerance``.
    """
    mass = cells.agg(F.sum("tokens")).first()[0] or 0
    table = cells.withColumn("factor", F.when(F.col("tokens") > 0, 1.0).otherwise(0.0))
    for d, t in targets.items():
        # targets of values that the cells do not have cannot be met: share them out
        there = t.join(cells.where("tokens > 0").select(d).distinct(), d, "left_semi")
        goal = there.select(d, (F.col("target") / there.agg(F.sum("target")).scalar()
                                * mass).alias(f"goal_{d}"))
        table = salted_join(table, goal, [d], F.hash(*DIMENSIONS), "left").na.fill(
            0.0, [f"goal_{d}"])
    goals = [f"goal_{d}" for d in targets]
    table = stored(table, "rake-start")
    for _ in range(rounds):
        for d in targets:
            # over the cells of one value: combinations of the other dimensions, no documents
            own = F.sum(F.col("tokens") * F.col("factor")).over(Window.partitionBy(d))
            table = (table.withColumn("own", own)
                     .withColumn(f"off_{d}", F.abs(F.col("own") - F.col(f"goal_{d}")))
                     .withColumn("factor", F.when(F.col("own") > 0, F.col("factor")
                                                  * F.col(f"goal_{d}") / F.col("own")).otherwise(0.0))
                     .drop("own"))
        table = stored(table, "raked")
        off = [f"off_{d}" for d in targets]
        worst = table.agg(*[F.max(c) for c in off]).first()
        table = table.drop(*off)
        if max((x or 0.0 for x in worst), default=0.0) < tolerance * max(mass, 1):
            break
    return table.drop(*goals)


def draw_scale(cells: DataFrame, share: float) -> float:
    """c with sum(tokens x min(1, c x factor)) = share x sum(tokens), by narrowing a grid."""
    whole = cells.agg(F.sum("tokens").alias("t"), F.max("factor").alias("hi"),
                      F.min(F.when(F.col("factor") > 0, F.col("factor"))).alias("lo")).first()
    if not whole.t or not whole.hi:
        return 1.0
    low, high = 0.0, 1.0 / whole.lo
    for _ in range(4):
        grid = np.linspace(low, high, 65)
        tried = cells.select("tokens", "factor", F.posexplode(
            F.array(*[F.lit(float(c)) for c in grid])).alias("i", "c"))
        sums = dict(tried.groupBy("i").agg(F.sum(F.col("tokens") * F.least(
            F.lit(1.0), F.col("factor") * F.col("c")))).collect())
        at = int(np.searchsorted([sums[i] for i in range(len(grid))], share * whole.t))
        low, high = grid[max(at - 1, 0)], grid[min(at, 64)]
    return float(high)


def mixture(docs: DataFrame, targets: dict[str, DataFrame] | None = None,
            share: float = KEEP_SHARE, id_col: str = "doc_id", text_col: str = "text",
            source_col: str = "source", lang_col: str = "lang") -> DataFrame:
    """``measured`` rows with ``factor`` (calibrated weight), ``prob`` and ``sampled``."""
    rows = stored(measured(docs, id_col, text_col, source_col, lang_col), "measured")
    cells = stored(cell_tokens(rows), "cells")
    targets = targets or {d: tempered_targets(cells, d) for d in DIMENSIONS}
    raked = stored(rake(cells, targets), "cell-factors")
    scale = draw_scale(raked, share)
    raked = raked.select(*DIMENSIONS, "factor", F.when(F.col("tokens") > 0, F.least(
        F.lit(1.0), F.col("factor") * scale)).otherwise(F.lit(1.0)).alias("prob"))
    ticket = F.pmod(F.col("k1"), F.lit(1 << 53)) / F.lit(float(1 << 53))
    return (salted_join(rows, raked, list(DIMENSIONS), F.col("k1"))
            .withColumn("sampled", ticket < F.col("prob")))


def sample(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The drawn rows of ``docs`` with their own columns."""
    drawn = (mixture(docs, id_col=id_col, text_col=text_col, **options)
             .where("sampled").select("k1", "k2").distinct())
    names = [fresh(docs, "mix_k1"), fresh(docs, "mix_k2")]
    k1, k2 = key_pair(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")))
    return (docs.withColumns({names[0]: k1, names[1]: k2})
            .join(drawn.toDF(*names).hint("shuffle_hash"), names, "left_semi").drop(*names))
