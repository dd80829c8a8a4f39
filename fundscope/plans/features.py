"""Campaign feature plan.

One chain of row-local expressions and filters: Catalyst collapses it into a
single projection, and the filters reach the scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundscope.functions.columns import (
    GOAL_EDGES,
    KEEP_SUBCATEGORIES,
    bool_to_int,
    day_diff,
    goal_bin,
    indicator,
    keep_or_other,
    recode_state,
    text_length,
)
from fundscope.sources.schemas import FEATURE_COLUMNS

# Fixed values of the reference's modelling slice.
REF_CUTOFF = "2016-01-01"
REF_CATEGORY = "technology"
REF_HOME = "US"
EXCLUDED_STATE = "live"


def closed_campaigns(df: DataFrame, excluded: str = EXCLUDED_STATE) -> DataFrame:
    """drop campaigns still running (a null state is dropped too)."""
    return df.where(F.col("state") != excluded)


def created_since(df: DataFrame, cutoff: str) -> DataFrame:
    """campaigns created on or after ``cutoff`` (yyyy-MM-dd)."""
    return df.where(F.col("created_at") >= F.lit(cutoff).cast("date"))


def in_category(df: DataFrame, category: str) -> DataFrame:
    """one main category."""
    return df.where(F.col("mainCategory") == category)


def campaign_features(df: DataFrame, cutoff: str = REF_CUTOFF,
                      category: str = REF_CATEGORY, home: str = REF_HOME,
                      keep: Sequence[str] = KEEP_SUBCATEGORIES,
                      edges: Sequence[float] = GOAL_EDGES,
                      keep_id: bool = True) -> DataFrame:
    """Campaign table -> feature table (11 features, plus ``id``)."""
    sliced = in_category(created_since(closed_campaigns(df), cutoff), category)
    feats = sliced.select(
        F.col("id"),
        bool_to_int("staff_pick").alias("staff_pick"),
        text_length("blurb").alias("blurblen"),
        text_length("name").alias("namelen"),
        indicator(F.col("country") == home).alias("countryUS"),
        day_diff("deadline", "launched_at").alias("campaignlen"),
        day_diff("launched_at", "created_at").alias("preparelen"),
        keep_or_other("subCategory", keep).alias("newsubCategory"),
        F.month("deadline").alias("monthdead"),
        F.month("launched_at").alias("monthLaunched"),
        goal_bin("goal", edges).alias("goalBin"),
        indicator(recode_state("state") == "successful").alias("label"),
    )
    cols = (["id"] if keep_id else []) + list(FEATURE_COLUMNS)
    return feats.select(*cols)


def state_recoded(df: DataFrame) -> DataFrame:
    """E2 on the table: live campaigns removed, state in {successful, failed, other}."""
    return closed_campaigns(df).withColumn("state", recode_state("state"))
