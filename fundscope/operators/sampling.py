"""Repeatable splits, class samples and rebalancing.

Every random choice is a keyed hash (``md5(seed|key)``), so results do not
change with partitioning, retries or executor loss, and DuckDB can replay them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundscope.functions.columns import hash_percent, hash_unit
from fundscope.session import ensure_checkpoint_dir

# Fixed values of the reference's modelling run.
SPLIT_SEED = 101
TRAIN_PERCENT = 75
OVERSAMPLE = 2000
PER_CLASS = 4700

BUCKET_BITS = 16          # high bits of the 32-bit hash: at most 65,536 counts per draw


def keyed_split(df: DataFrame, key: str = "id", percent: int = TRAIN_PERCENT,
                seed: int = SPLIT_SEED) -> tuple[DataFrame, DataFrame]:
    """L3: (train, test) by ``hash_percent(seed, key) < percent``.

    Rows with the same key always fall on the same side, and the split is the
    same for any partitioning (``randomSplit`` is not). Rows without a key train.
    """
    side = F.coalesce(hash_percent(seed, F.col(key)) < percent, F.lit(True))
    return df.where(side), df.where(~side)


def _sample_key(seed, key: str, copy_col: str | None) -> Column:
    k = F.col(key).cast("string")
    if copy_col is not None:
        k = F.concat(k, F.lit("#"), F.col(copy_col).cast("string"))
    return hash_unit(seed, k)


def _cut(counts: list[tuple[int, int]], n: int) -> tuple[int, int]:
    """(bucket that holds the n-th row, rows wanted of it) from counts per hash bucket."""
    below = 0
    for bucket, count in sorted(counts):
        if below + count >= n:
            return bucket, n - below
        below += count
    return 1 << BUCKET_BITS, 0                      # fewer rows than asked: all of them


def _bucket() -> Column:
    return F.shiftright(F.col("_h"), 32 - BUCKET_BITS)


def _below_cut(keyed: DataFrame, cut: tuple[int, int], order: list[Column]) -> DataFrame:
    whole = keyed.where(_bucket() < cut[0])
    edge = keyed.where(_bucket() == cut[0]).orderBy(*order).limit(cut[1])
    return whole.unionByName(edge).drop("_h")


def first_n_by_hash(df: DataFrame, n: int, seed, key: str = "id",
                    copy_col: str | None = None) -> DataFrame:
    """The ``n`` rows with the least keyed hash (ties by key, copy number).

    Rows are counted per hash bucket (at most ``2**BUCKET_BITS`` counts come back);
    whole buckets below the cut are kept, and only the rows of the cut bucket (about
    N / 65,536 of the input) are ordered. No global sort, no task holding ``n`` rows.
    """
    order = [F.col("_h"), F.col(key)] + ([F.col(copy_col)] if copy_col else [])
    keyed = df.withColumn("_h", F.coalesce(_sample_key(seed, key, copy_col), F.lit(0)))
    counts = keyed.groupBy(_bucket().alias("b")).agg(F.count(F.lit(1)).alias("n")).collect()
    return _below_cut(keyed, _cut([(r.b, r.n) for r in counts], n), order)


def sample_class(df: DataFrame, n: int, label: str = "label", value=1, seed=SPLIT_SEED,
                 key: str = "id", copy_col: str | None = None) -> DataFrame:
    """L4: ``n`` rows of one class, chosen by keyed hash (the reference: ``rand()``)."""
    return first_n_by_hash(df.where(F.col(label) == value), n, seed, key, copy_col)


def rebalance(train: DataFrame, label: str = "label", key: str = "id",
              oversample: int = OVERSAMPLE, per_class: int = PER_CLASS,
              seed=SPLIT_SEED, positive=1, negative=0) -> DataFrame:
    """L5 + J3: add ``oversample`` extra positives, then ``per_class`` rows of each class.

    ``copy_no`` gives repeated rows an identity (0 = original, 1 = extra copy),
    so the second stage can tell copies apart and stays repeatable.
    """
    ensure_checkpoint_dir(train.sparkSession)
    base = train.withColumn("copy_no", F.lit(0)).checkpoint()   # evaluated once for all draws
    extra = sample_class(base, oversample, label, positive, f"{seed}a", key, "copy_no")
    neg = sample_class(base, per_class, label, negative, f"{seed}b", key, "copy_no")
    positives = base.where(F.col(label) == positive).unionByName(
        extra.withColumn("copy_no", F.lit(1)))
    pos = first_n_by_hash(positives, per_class, f"{seed}c", key, "copy_no")
    return neg.unionByName(pos)


def fold_column(key: str = "id", folds: int = 10, seed=SPLIT_SEED) -> Column:
    """Cross-validation fold from the key hash: copies of a row share a fold."""
    return (hash_unit(f"fold{seed}", F.col(key)) % folds).cast("int")


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name, duplicates kept."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
