"""What a fit leaves on disk does not grow with its iterations."""

from __future__ import annotations

import os
import time

from pyspark.sql import functions as F

from ratingloom.operators import factor_models


def _shuffle_bytes(spark) -> int:
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    names = (os.path.join(at, name) for folder in folders for at, _, found in os.walk(folder.getPath()) for name in found)
    sizes = 0
    for name in names:
        if "shuffle_" in name:
            try:
                sizes += os.path.getsize(name)
            except FileNotFoundError:  # deleted meanwhile
                pass
    return sizes


def _left_by(spark, ratings, iterations: int) -> int:
    before = _shuffle_bytes(spark)
    model = factor_models.fit_als(ratings, rank=16, maxIter=iterations)
    assert model.userFactors.count() == 2_000
    time.sleep(3)  # MLlib's deletion is not waited for
    return _shuffle_bytes(spark) - before


def test_shuffle_files_of_a_fit_are_those_of_its_last_iteration(spark):
    pair = spark.range(60_000).select((F.col("id") % 2_000).cast("int").alias("user_idx"), (F.xxhash64("id") % 1_000).cast("int").alias("item_idx"))
    ratings = pair.withColumn("rating", F.pmod(F.col("item_idx"), F.lit(5)).cast("double")).persist()
    ratings.count()
    few, many = _left_by(spark, ratings, 2), _left_by(spark, ratings, 5)
    ratings.unpersist()
    assert 0 < many < 1.3 * few
