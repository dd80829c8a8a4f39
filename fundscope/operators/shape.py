"""Flattening, column selection and duplicate handling.

Duplicate handling is written so that a key holding a third of all rows never
lands whole in one sort or one collected group: survivors are chosen by
aggregates with map-side partial aggregation (min of a struct), and the
per-key results are joined back with a salt, so a hot key spans several tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundscope.functions.columns import epoch_to_date, split_first
from fundscope.operators.joins import salted_join
from fundscope.sources.schemas import CAMPAIGN_COLUMNS


def flatten_struct(df: DataFrame, struct_col: str = "data") -> DataFrame:
    """Promote the fields of one struct column to top-level columns."""
    return df.select(f"{struct_col}.*")


def flatten_campaigns(raw: DataFrame, struct_col: str = "data",
                      columns: Sequence[str] = CAMPAIGN_COLUMNS) -> DataFrame:
    """S2 + P1 + P2 + E8 + E9: raw crawl records -> flat campaign table.

    An allow-list select replaces the reference's chain of drops, so nothing
    that is not needed is carried (or, with a declared schema, even parsed).
    """
    flat = flatten_struct(raw, struct_col)
    derived = {
        "created_at": epoch_to_date("created_at"),
        "launched_at": epoch_to_date("launched_at"),
        "deadline": epoch_to_date("deadline"),
        "usd_pledged": F.col("usd_pledged").try_cast("double"),
        "mainCategory": split_first(F.col("category.slug"), "/"),
        "subCategory": F.col("category.name"),
        "creatorID": F.col("creator.id"),
        "url": F.col("urls.web.project"),
    }
    return flat.select(*[derived.get(c, F.col(c)).alias(c) for c in columns])


def drop_columns(df: DataFrame, *names: str) -> DataFrame:
    """Drop by name; absent names are ignored (as ``DataFrame.drop``)."""
    return df.drop(*names)


def columns_like(df: DataFrame, fragment: str) -> list[str]:
    """Names of the columns that contain ``fragment``."""
    return [c for c in df.columns if fragment in c]


def dedupe_by_key(df: DataFrame, keys: Sequence[str],
                  order: Sequence[str] | None = None) -> DataFrame:
    """One row per key; the survivor is the least row by ``order`` then all columns.

    ``min(struct(...))`` aggregates partially on the map side, so a hot key
    shrinks to one row per input partition before the shuffle, and the result
    does not depend on partitioning (unlike ``dropDuplicates``).
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    order = [c for c in (order or []) if c in rest]
    tail = [c for c in rest if c not in order]
    packed = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)],
                      *[F.col(c) for c in tail])
    best = df.groupBy(*keys).agg(F.min(packed).alias("_best"))
    return best.select(*keys, *[F.col(f"_best.o{order.index(c)}").alias(c) if c in order
                                else F.col(f"_best.{c}") for c in rest]).select(*df.columns)


def distinct_rows(df: DataFrame) -> DataFrame:
    """Whole-row de-duplication (hash aggregate with map-side combine)."""
    return df.distinct()


def later_duplicates(df: DataFrame, value: str, position: str) -> DataFrame:
    """Rows whose ``value`` already occurred at a smaller ``position``.

    The value is reduced to a SHA-256 digest so the shuffle carries 32 bytes, not
    whole texts; the first position per digest comes from a partial aggregate,
    then is joined back with a salt (a hot value spans several tasks). Nulls count
    as one value (as pandas ``duplicated`` and a SQL window partition do); the
    null marker cannot collide with a 64-hex-digit digest.
    """
    digest = F.coalesce(F.sha2(F.col(value).cast("string"), 256), F.lit("null"))
    keyed = df.withColumn("_digest", digest)
    first = (keyed.groupBy("_digest")
             .agg(F.min(position).alias("first_" + position)))
    return (salted_join(keyed, first, ["_digest"], F.col(position))
            .where(F.col(position) > F.col("first_" + position))
            .drop("_digest"))


def same_url_conflicts(df: DataFrame, url: str = "url", name: str = "name",
                       carry: Sequence[str] = ("id", "launched_at")) -> DataFrame:
    """J1 (re-aimed): rows that share their url with a row of a different name.

    The reference lists every (k1, k2) pair of such rows; that output grows with
    the square of a url's size. A row has at least one such partner exactly when
    its name is not null and its url carries two or more distinct names, i.e.
    the least and greatest name of the url differ. We return each such row once
    with one partner name (the url's least or greatest name, whichever differs), the rows of
    its url (``url_rows``) and how many of them have another name (``partners``: the pairs
    the reference lists for this row). Partial aggregates by (url, name), then by url, and salted
    joins: linear in the input.
    """
    valid = df.where(F.col(url).isNotNull() & F.col(name).isNotNull())
    per_name = valid.groupBy(url, name).agg(F.count(F.lit(1)).alias("_same"))
    per_url = (per_name.groupBy(url)
               .agg(F.min(name).alias("_min_name"), F.max(name).alias("_max_name"),
                    F.sum("_same").alias("url_rows"))
               .where(F.col("_min_name") != F.col("_max_name")))
    classes = salted_join(per_name, per_url, [url], F.hash(name))
    return (salted_join(valid.select(*carry, name, url), classes, [url, name], F.hash(*carry))
            .select(*carry, name, url,
                    F.when(F.col(name) == F.col("_min_name"), F.col("_max_name"))
                     .otherwise(F.col("_min_name")).alias("other_name"),
                    "url_rows", (F.col("url_rows") - F.col("_same")).alias("partners")))


def attach_by_key(left: DataFrame, right: DataFrame, key: str | Sequence[str],
                  columns: Sequence[str]) -> DataFrame:
    """Attach columns of ``right`` to ``left`` by key (the reference used row position)."""
    keys = [key] if isinstance(key, str) else list(key)
    return left.join(right.select(*keys, *columns), keys, "left")


def with_columns_sql(df: DataFrame, **exprs: str | Column) -> DataFrame:
    """``select *, expr as name`` with SQL text or Column expressions."""
    return df.withColumns({k: F.expr(v) if isinstance(v, str) else v
                           for k, v in exprs.items()})
