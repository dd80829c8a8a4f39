"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fundscope.operators.joins import fresh, salted_join  # noqa: F401 - shared with the operators here
from fundscope.session import SHUFFLE_CLEANUP, ensure_checkpoint_dir, shuffles_dropped  # noqa: F401

HASH_SEED = 7


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def work_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared checkpoint folder, never the same twice."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back (cuts lineage).

    The write's own shuffle files go when it ends.
    """
    spark = df.sparkSession
    path = work_path(spark, name)
    with shuffles_dropped(spark):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete the files of ``stored`` tables that nothing reads any more."""
    for df in tables:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df.stored_path)
        path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def key_pair(*cols: Column) -> list[Column]:
    """128 bits of hash as two longs ``k1``, ``k2`` (64 alone collide at 10^10 rows)."""
    return [F.xxhash64(*cols).alias("k1"), F.xxhash64(F.lit(HASH_SEED), *cols).alias("k2")]
