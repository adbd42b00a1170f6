"""A stored table leaves no shuffle files behind it."""

from __future__ import annotations

import os
import time

from pyspark.sql import functions as F

from ratingloom.scratch import materialize


def _shuffle_files(spark) -> set[str]:
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {name for folder in folders for _, _, found in os.walk(folder.getPath()) for name in found if name.startswith("shuffle_") and name.endswith(".data")}


def test_storing_a_table_leaves_no_shuffle_files(spark):
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was, before = spark.conf.get(setting, "false"), _shuffle_files(spark)
    rows = spark.range(200_000).select((F.col("id") % 5_003).alias("key"), F.col("id").alias("value"))
    joined = rows.groupBy("key").agg(F.max("value").alias("most")).hint("merge").join(rows.repartition("key").hint("merge"), "key")
    stored = materialize(joined, "joined")
    for _ in range(20):  # the deletion is not waited for
        left = _shuffle_files(spark) - before
        if not left:
            break
        time.sleep(0.5)
    assert not left
    assert spark.conf.get(setting, "false") == was
    # Both the table and the frame it was made of can still be read.
    assert stored.count() == joined.count() == 200_000
