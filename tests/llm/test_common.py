import os
import time

from pyspark.sql import functions as F

from fundscope.llm.common import SHUFFLE_CLEANUP, discard, stored


def shuffle_files(spark):
    found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(found.apply(i).getName().endswith(".data") for i in range(found.size()))


def test_stored_leaves_no_shuffle_files(spark):
    spark.conf.unset(SHUFFLE_CLEANUP)
    before, setting = shuffle_files(spark), spark.conf.get(SHUFFLE_CLEANUP)
    rows = spark.range(10_000).groupBy((F.col("id") % 100).alias("k")).count()
    out = stored(rows, "t")
    end = time.time() + 20                                 # files are deleted in the background
    while shuffle_files(spark) > before and time.time() < end:
        time.sleep(0.2)
    assert shuffle_files(spark) <= before
    assert spark.conf.get(SHUFFLE_CLEANUP) == setting
    assert out.count() == 100 and out.dtypes == rows.dtypes
    spark.conf.set(SHUFFLE_CLEANUP, "false")
    stored(rows, "t")
    assert spark.conf.get(SHUFFLE_CLEANUP) == "false"
    spark.conf.unset(SHUFFLE_CLEANUP)


def test_discard_deletes_stored_files(spark):
    tables = [stored(spark.range(n), "t") for n in (0, 5, 7)]
    discard(*tables[:2])
    there = [os.path.exists(t.stored_path.removeprefix("file:")) for t in tables]
    assert there == [False, False, True] and tables[2].count() == 7
