"""Row-local column expressions (E1-E14 and helpers).

All are built-in Spark expressions, so they stay inside whole-stage codegen and
work the same on batch and streaming DataFrames. None depends on the session
time zone or on a random generator.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's for equal results.
# Goal bin edges (lower edge inclusive): 15k, 35k, 55k, 100k, 140k, 250k -> bins 1..7;
# bins 4..7 are merged afterwards, so the effective edges are 15k, 35k, 55k.
GOAL_EDGES_FINE = (15000, 35000, 55000, 100000, 140000, 250000)
GOAL_EDGES = (15000, 35000, 55000)
# Sub-categories kept by name; every other value becomes "Other".
KEEP_SUBCATEGORIES = ("Apps", "Gadgets", "Web", "Hardware", "Software", "Wearables",
                      "DIY Electronics")
OTHER = "Other"
# State recode: these two survive, the rest become "other".
KEPT_STATES = ("successful", "failed")
OTHER_STATE = "other"
SECONDS_PER_DAY = 86400


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bool_to_int(c: str | Column) -> Column:
    """True -> 1, false or null -> 0."""
    return F.when(_c(c) == F.lit(True), 1).otherwise(0)


def indicator(cond: Column) -> Column:
    """1 where the condition holds, 0 where it fails or is null."""
    return F.when(cond, 1).otherwise(0)


def recode_state(c: str | Column, kept: Sequence[str] = KEPT_STATES,
                 other: str = OTHER_STATE) -> Column:
    """Keep the listed states, everything else (null too) becomes ``other``."""
    col = _c(c)
    return F.when(col.isin(list(kept)), col).otherwise(F.lit(other))


def keep_or_other(c: str | Column, keep: Iterable[str] = KEEP_SUBCATEGORIES,
                  other: str = OTHER) -> Column:
    """Keep named values, the rest (null too) becomes ``other``."""
    col = _c(c)
    return F.when(col.isin(list(keep)), col).otherwise(F.lit(other))


def bin_by_edges(c: str | Column, edges: Sequence[float]) -> Column:
    """Bins 1..len(edges)+1, lower edge inclusive; null falls into the top bin."""
    col = _c(c)
    expr = None
    for i, edge in enumerate(edges, start=1):
        expr = F.when(col < edge, i) if expr is None else expr.when(col < edge, i)
    return expr.otherwise(len(edges) + 1)


def goal_bin(c: str | Column, edges: Sequence[float] = GOAL_EDGES) -> Column:
    """E4+E5: the reference bins into 7 and merges 4..7; we emit the 4 bins directly."""
    return bin_by_edges(c, edges)


def merge_bins(c: str | Column, top: int) -> Column:
    """E5: bins above ``top`` become ``top``."""
    col = _c(c)
    return F.when(col < top, col).otherwise(F.lit(top))


def text_length(c: str | Column) -> Column:
    """Characters; null stays null."""
    return F.length(_c(c))


def split_first(c: str | Column, sep: str = "/") -> Column:
    """First piece of a separated string (``sep`` is a regex in Spark)."""
    return F.split(_c(c), sep).getItem(0)


def epoch_to_date(c: str | Column) -> Column:
    """Epoch seconds -> UTC calendar date, with no session time zone involved."""
    return F.date_from_unix_date(F.floor(_c(c) / SECONDS_PER_DAY).cast("int"))


def day_diff(end: str | Column, start: str | Column) -> Column:
    """Whole days from ``start`` to ``end``."""
    return F.datediff(_c(end), _c(start))


def month_text(c: str | Column) -> Column:
    """Zero-padded month of a date, e.g. '03'."""
    return F.date_format(_c(c), "MM")


def has_text(c: str | Column) -> Column:
    """1 if the text holds any non-blank character, else 0 (null -> 0)."""
    return F.when(F.coalesce(_c(c).rlike(r"\S"), F.lit(False)), 1).otherwise(0)


def hash_unit(seed: int | str, key: str | Column, digits: int = 8) -> Column:
    """Keyed pseudo-random number in [0, 16**digits): first hex digits of md5(seed|key).

    Same value in any engine with md5, and independent of partitioning.
    """
    text = F.concat(F.lit(f"{seed}|"), _c(key).cast("string"))
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("long")


def hash_percent(seed: int | str, key: str | Column) -> Column:
    """0..99 bucket of the keyed hash (used for splits and folds)."""
    return hash_unit(seed, key) % 100
