"""Join helper for hot keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SALTS = 8


def fresh(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have (compared without case)."""
    taken = {c.lower() for c in df.columns}
    name = base
    while name.lower() in taken:
        name += "_"
    return name


def salted_join(many: DataFrame, one: DataFrame, on: list[str], salt: Column,
                how: str = "inner", salts: int = SALTS) -> DataFrame:
    """Join a side that may hold hot keys with a side that has one row per key.

    The rows of a hot key are dealt over ``salts`` tasks by ``salt`` (any column that
    varies within a key); the other side is repeated once for each salt. Spark's own skew
    split does not help here: the one-row side is an aggregate on the key, so no exchange
    stands directly under the join.
    """
    name = fresh(many, "join_salt")
    # never null, so that no null check goes below the join: a shared aggregate stays one stage
    left = many.withColumn(name, F.coalesce(F.pmod(F.hash(salt), F.lit(salts)), F.lit(0)))
    right = one.withColumn(name, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right, [*on, name], how).drop(name)
