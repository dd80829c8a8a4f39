"""Profiling and descriptive statistics.

Every statistic is one aggregate with map-side partial aggregation; totals are
uncorrelated scalar subqueries (run once, one row), never a window over the
whole table and never a driver round-trip. The only driver loop is the exact
quantile search, which moves bounded histograms (``QUANTILE_BUCKETS`` rows).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

COUNT = "count"


def _n() -> Column:
    return F.count(F.lit(1))


def row_count(df: DataFrame, name: str = "rows") -> DataFrame:
    """One row, the number of rows."""
    return df.agg(_n().alias(name))


def distinct_counts(df: DataFrame, cols: Sequence[str], approx: bool = False,
                    rsd: float = 0.01) -> DataFrame:
    """A2: one row: ``rows`` and ``distinct_<col>`` for each column (exact by default)."""
    fn = (lambda c: F.approx_count_distinct(c, rsd)) if approx else F.count_distinct
    return df.agg(_n().alias("rows"), *[fn(F.col(c)).alias(f"distinct_{c}") for c in cols])


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """A3: the distinct values of one column."""
    return df.select(col).distinct()


def group_count(df: DataFrame, keys: str | Sequence[str], name: str = COUNT,
                descending: bool = True) -> DataFrame:
    """Rows per group, largest first (ties by key)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    out = df.groupBy(*keys).agg(_n().alias(name))
    order = [F.col(name).desc() if descending else F.col(name).asc()] + [F.col(k) for k in keys]
    return out.orderBy(*order)


def value_counts(df: DataFrame, col: str, include_null: bool = False) -> DataFrame:
    """``Counter`` (nulls kept) or ``value_counts`` (nulls dropped) of a column."""
    src = df if include_null else df.where(F.col(col).isNotNull())
    return group_count(src, col)


def total_rows(df: DataFrame) -> Column:
    """Row count of ``df`` as a scalar-subquery column (evaluated once)."""
    return df.select(_n()).scalar()


def share_by(df: DataFrame, col: str, name: str = "share", digits: int | None = None,
             total_of: DataFrame | None = None) -> DataFrame:
    """Each group's share of all rows, largest first.

    The total is the sum of the group counts, or the row count of ``total_of``, as a
    scalar subquery: no one-row cross join, no separate driver job, and the input of the
    groups is grouped once (Spark reuses the exchange).
    """
    counts = df.groupBy(col).agg(_n().alias(COUNT))
    total = (counts.select(F.sum(COUNT)).scalar() if total_of is None
             else total_rows(total_of))
    share = F.col(COUNT) / total
    if digits is not None:
        share = F.round(share, digits)
    return counts.orderBy(F.col(COUNT).desc(), F.col(col)).select(col, COUNT, share.alias(name))


def value_share(df: DataFrame, col: str, value, name: str = "share") -> DataFrame:
    """Share of rows where ``col == value``; nulls count as not equal."""
    hit = F.coalesce(F.col(col) == F.lit(value), F.lit(False)).cast("int")
    return df.agg(F.avg(hit).alias(name))


def per_year(df: DataFrame, date_col: str, name: str = COUNT) -> DataFrame:
    """Rows per calendar year, by year."""
    return (df.groupBy(F.year(date_col).alias("year")).agg(_n().alias(name))
            .orderBy("year"))


def monthly_mean(df: DataFrame, date_col: str, digits: int = 2) -> DataFrame:
    """Per (month, year) count, then the mean over years for each month.

    Years with no rows in a month are left out of that month's mean (as in SQL).
    """
    per_month_year = (df.groupBy(F.month(date_col).alias("month"),
                                 F.year(date_col).alias("year"))
                      .agg(_n().alias("number")))
    return (per_month_year.groupBy("month")
            .agg(F.round(F.avg("number"), digits).alias("mean_count"))
            .orderBy("month"))


def max_lengths(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A10: one row, ``max_len_<col>`` for each string column."""
    return df.agg(*[F.max(F.length(c)).alias(f"max_len_{c}") for c in cols])


def ranges(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row, ``min_<col>`` and ``max_<col>`` for each column."""
    aggs = []
    for c in cols:
        aggs += [F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}")]
    return df.agg(*aggs)


_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
            T.DecimalType)


def profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Type-driven profile of every column in ONE aggregate pass.

    Long form ``(column, metric, num_value, date_value)``:
    strings -> count, min/max/mean/stddev of length; numbers -> count, min, max,
    mean, stddev; dates/timestamps -> count, min, max; booleans -> count, n_true.
    """
    fields = [f for f in df.schema.fields if cols is None or f.name in cols]
    aggs: list[Column] = []
    entries: list[tuple[str, str, str, str]] = []  # column, metric, alias, kind

    def add(col_name: str, metric: str, expr: Column, kind: str) -> None:
        alias = f"m{len(aggs)}"
        aggs.append(expr.alias(alias))
        entries.append((col_name, metric, alias, kind))

    for f in fields:
        c = F.col(f.name)
        add(f.name, "count", F.count(c).cast("double"), "num")
        if isinstance(f.dataType, T.StringType):
            length = F.length(c)
            add(f.name, "min_length", F.min(length).cast("double"), "num")
            add(f.name, "max_length", F.max(length).cast("double"), "num")
            add(f.name, "mean_length", F.avg(length), "num")
            add(f.name, "stddev_length", F.stddev_samp(length), "num")
        elif isinstance(f.dataType, _NUMERIC):
            add(f.name, "min", F.min(c).cast("double"), "num")
            add(f.name, "max", F.max(c).cast("double"), "num")
            add(f.name, "mean", F.avg(c).cast("double"), "num")
            add(f.name, "stddev", F.stddev_samp(c).cast("double"), "num")
        elif isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            add(f.name, "min", F.min(c).cast("date"), "date")
            add(f.name, "max", F.max(c).cast("date"), "date")
        elif isinstance(f.dataType, T.BooleanType):
            add(f.name, "n_true", F.sum(c.cast("int")).cast("double"), "num")
    wide = df.agg(*aggs)
    rows = [F.struct(F.lit(col_name).alias("column"), F.lit(metric).alias("metric"),
                     (F.col(alias) if kind == "num" else F.lit(None).cast("double"))
                     .alias("num_value"),
                     (F.col(alias) if kind == "date" else F.lit(None).cast("date"))
                     .alias("date_value"))
            for col_name, metric, alias, kind in entries]
    return wide.select(F.inline(F.array(*rows)))


# ---------------------------------------------------------------- histograms

def histogram(df: DataFrame, col: str, bins: int = 10, lo: float | None = None,
              hi: float | None = None, open_range: tuple[float, float] | None = None
              ) -> DataFrame:
    """A16 (+F3): equal-width histogram with numpy's edges, last bin closed.

    ``open_range=(a, b)`` first keeps ``a < x < b`` (F3). Edges default to the
    min and max of the kept rows, taken as scalar subqueries. Every bin is
    reported, empty ones with 0: ``bin, bin_lo, bin_hi, count``.
    """
    x = F.col(col).cast("double")
    src = df.select(x.alias("x")).where(F.col("x").isNotNull() & ~F.isnan("x"))
    if open_range is not None:
        src = src.where((F.col("x") > open_range[0]) & (F.col("x") < open_range[1]))
    lo_c = F.lit(float(lo)) if lo is not None else src.select(F.min("x")).scalar()
    hi_c = F.lit(float(hi)) if hi is not None else src.select(F.max("x")).scalar()
    width = hi_c - lo_c
    raw = F.floor((F.col("x") - lo_c) * bins / width)
    idx = F.when(width == 0, F.lit(0)).otherwise(F.least(raw, F.lit(bins - 1)))
    counts = (src.where((F.col("x") >= lo_c) & (F.col("x") <= hi_c))
              .groupBy(idx.cast("int").alias("bin")).agg(_n().alias(COUNT)))
    # All bins, including empty ones. Both sides hold at most `bins` rows, so the
    # counts are broadcast (a proven bound) instead of sort-merge joined.
    all_bins = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return (all_bins.join(F.broadcast(counts), "bin", "left")
            .select("bin",
                    (lo_c + F.col("bin") * width / bins).alias("bin_lo"),
                    (lo_c + (F.col("bin") + 1) * width / bins).alias("bin_hi"),
                    F.coalesce(F.col(COUNT), F.lit(0)).cast("long").alias(COUNT))
            .orderBy("bin"))


# ---------------------------------------------------------------- quantiles

QUANTILE_BUCKETS = 4096      # counts moved to the driver per range and step


def exact_order_stats(df: DataFrame, col: str, ranks: Sequence[int]) -> dict[int, float]:
    """Values at the given 0-based ranks of the ascending non-null values, exactly.

    Distributed selection. Every pending rank sits in a value range; ranges of one level
    are disjoint, so ONE pass tags each row with its range and counts rows per (range,
    equal-width bucket): at most ``QUANTILE_BUCKETS`` rows per range come back. Each rank
    then descends into its bucket, until the bucket holds one value. A range's least and
    greatest value always fall into different buckets, so every step narrows it.
    Infinities are counted apart; widths are taken in halves, so none overflows. The
    column is never collected or sorted in one task.
    """
    src = (df.select(F.col(col).cast("double").alias("v"))
           .where(F.col("v").isNotNull() & ~F.isnan("v")))
    v, inf = F.col("v"), float("inf")
    finite = (v > -inf) & (v < inf)
    first = src.agg(F.min(F.when(finite, v)).alias("lo"), F.max(F.when(finite, v)).alias("hi"),
                    F.count_if(v == -inf).alias("low"), F.count_if(finite).alias("n"),
                    _n().alias("all")).first()
    out = {r: -inf if r < first["low"] else inf for r in ranks if 0 <= r < first["all"]}
    # rank -> (lo, hi, rows strictly below lo); the rank's value lies in [lo, hi]
    pending = {r: (first["lo"], first["hi"], first["low"]) for r in out
               if first["low"] <= r < first["low"] + first["n"]}
    while pending:
        out.update({r: s[0] for r, s in pending.items() if s[0] == s[1]})
        pending = {r: s for r, s in pending.items() if s[0] != s[1]}
        states = sorted(set(pending.values()))
        if not states:
            break
        tag, bucket = F.when(F.lit(False), 0), F.when(F.lit(False), 0)
        for i, (lo, hi, _) in enumerate(states):
            inside = (v >= lo) & (v <= hi)
            step = (hi / 2 - lo / 2) / QUANTILE_BUCKETS
            place = (F.least(F.floor((v / 2 - lo / 2) / step), F.lit(QUANTILE_BUCKETS - 1))
                     if step > 0 else F.when(v > lo, 1).otherwise(0))
            # the ends keep apart even where rounding would join them
            place = F.when(v == lo, 0).when(v == hi, QUANTILE_BUCKETS).otherwise(place)
            tag = tag.when(inside, i)
            bucket = bucket.when(inside, place.cast("int"))
        hist: dict[int, list] = {}
        for row in (src.select(tag.alias("t"), bucket.alias("b"), "v")
                    .where(F.col("t").isNotNull()).groupBy("t", "b")
                    .agg(_n().alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
                    .collect()):
            hist.setdefault(row["t"], []).append((row["lo"], row["hi"], row["n"]))
        for i, st in enumerate(states):
            for r in [r for r, s in pending.items() if s == st]:
                below = st[2]
                for lo, hi, count in sorted(hist[i]):
                    if r < below + count:
                        pending[r] = (lo, hi, below)
                        break
                    below += count
    return out


def describe(df: DataFrame, col: str, digits: int | None = None) -> DataFrame:
    """Pandas ``describe`` of one numeric column, with exact interpolated quartiles.

    One row: count, mean, std, min, q25, q50, q75, max. Quartiles use linear
    interpolation between order statistics ((n-1)p), as pandas and DuckDB's
    ``quantile_cont`` do.
    """
    x = F.col(col).cast("double")
    base = df.select(x.alias("v")).where(F.col("v").isNotNull() & ~F.isnan("v")).persist()
    try:                                              # the input is evaluated once
        row = base.agg(_n().alias("count"), F.avg("v").alias("mean"),
                       F.stddev_samp("v").alias("std"), F.min("v").alias("min"),
                       F.max("v").alias("max")).first().asDict()
        n, need = row["count"], {}
        for p in (0.25, 0.5, 0.75):
            k = int((n - 1) * p) if n else 0
            need[p] = (k, min(k + 1, n - 1), (n - 1) * p - k)
        found = exact_order_stats(base, "v", sorted({v for t in need.values() for v in t[:2]}))
    finally:
        base.unpersist()
    for p, (k, k1, frac) in need.items():
        at = found.get(k)
        row[f"q{int(p * 100)}"] = (None if at is None else at if not frac or at == found[k1]
                                   else at + (found[k1] - at) * frac)
    names = ["count", "mean", "std", "min", "q25", "q50", "q75", "max"]
    out = df.sparkSession.createDataFrame(
        [tuple(row[c] for c in names)], ", ".join(
            f"`{c}` {'long' if c == 'count' else 'double'}" for c in names))
    if digits is not None:
        out = out.select(*[F.round(c, digits).alias(c) if c != "count" else F.col(c)
                           for c in out.columns])
    return out


# ------------------------------------------------------------ stored distinct sketches (A2)

SKETCH_BITS = 14                            # 2**14 registers: standard error 0.0065


def sketch_error(bits: int = SKETCH_BITS) -> float:
    """Relative standard error of an estimate (0.8326 / sqrt(registers))."""
    return 0.8326 / 2 ** (bits / 2)


def distinct_sketches(df: DataFrame, by: Sequence[str], cols: Sequence[str],
                      bits: int = SKETCH_BITS) -> DataFrame:
    """A2: one mergeable sketch of the distinct values of each column, for each group.

    A sketch has a bounded size (16 KB at 14 bits), so it can be stored and united later into any
    coarser grouping without reading the rows again.
    """
    return df.groupBy(*by).agg(*[F.hll_sketch_agg(F.col(c).cast("string"), bits).alias(c) for c in cols])


def united_estimates(sketches: DataFrame, by: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """A2: estimates ``<col>_estimate`` of stored sketches, united by a coarser grouping."""
    return sketches.groupBy(*by).agg(*[
        F.hll_sketch_estimate(F.hll_union_agg(c)).alias(f"{c}_estimate") for c in cols])
