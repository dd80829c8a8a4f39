"""Session helpers.

Library functions never depend on session state for their results: dates are
derived with time-zone-free arithmetic and every random choice is a keyed hash.
The settings below are for throughput and for local runs (tests, bench).
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "fundscope", event_log_dir: str | None = None) -> SparkSession:
    """Local session for tests and bench; on a cluster use the cluster's session.

    ``event_log_dir`` writes Spark's event log there (stage and task times
    without the web UI, which stays off).
    """
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    parts = shuffle_partitions or 4 * int(cpus)   # AQE coalesces the small ones
    builder = SparkSession.builder
    if event_log_dir:
        os.makedirs(event_log_dir, exist_ok=True)
        builder = (builder.config("spark.eventLog.enabled", "true")
                   .config("spark.eventLog.compress", "false")   # plain JSON lines
                   .config("spark.eventLog.dir", event_log_dir))
    spark = (
        builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting one only where none is set.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as is; if it
    is unset there, this raises, since executors would write to their own disks. Only a
    local master (tests) falls back to a fresh local folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="fundscope-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Queries run in here delete their shuffle files when they end, not when garbage is collected."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def stored_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under a new name in the shared checkpoint folder and read it back.

    Cuts lineage; a lost executor reads the table again. The write's own shuffle files go when it ends.
    """
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    with shuffles_dropped(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
