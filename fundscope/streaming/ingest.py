"""Incremental ingest of crawl files (S1 + S2 + features on a file stream).

The reference has no streaming part. What carries over unchanged is the
row-local work: flattening (S2, E8, E9) and the feature expressions (E1-E11)
hold no state, so the same functions run on a streaming DataFrame. Nothing
here keeps state across micro-batches; duplicate handling and statistics stay
batch jobs over the landed table.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql import types as T

from fundscope.operators.shape import flatten_campaigns
from fundscope.plans.features import campaign_features
from fundscope.session import ensure_checkpoint_dir
from fundscope.sources.schemas import RAW_RECORD


def campaign_stream(spark: SparkSession, source_dir: str, schema: T.StructType = RAW_RECORD,
                    max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming flat campaign table from new line-JSON crawl files."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return flatten_campaigns(reader.json(source_dir))


def feature_stream(spark: SparkSession, source_dir: str, **feature_args) -> DataFrame:
    """Streaming feature rows (same options as ``campaign_features``)."""
    return campaign_features(campaign_stream(spark, source_dir), **feature_args)


def land(stream: DataFrame, path: str, name: str, checkpoint: str | None = None,
         available_now: bool = True) -> StreamingQuery:
    """Append a stream to parquet at ``path``; progress lives under the shared
    checkpoint folder (``spark.checkpoint.dir``) unless ``checkpoint`` is given,
    so a restarted job resumes where it stopped."""
    if checkpoint is None:
        checkpoint = os.path.join(ensure_checkpoint_dir(stream.sparkSession), "streams", name)
    writer = (stream.writeStream.format("parquet").outputMode("append")
              .option("checkpointLocation", checkpoint).queryName(name))
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start(path)
