"""Queries move and read their rows no more often than they need."""

from __future__ import annotations

import pytest

from pyspark.sql import functions as F

from ratingloom.plans import catalog


def test_known_ids_are_encoded_from_the_stored_ratings(spark, small_dir):
    files = catalog.QUERIES["encode_known_ids"](spark, small_dir).inputFiles()
    assert files and not any("lineitem" in name or "orders" in name for name in files)


@pytest.mark.parametrize("key", ["user_idx", "item_idx"])
def test_gradient_sums_need_no_shuffle_of_their_own(spark, key):
    pairs = spark.range(50).select((F.col("id") % 7).cast("int").alias("user_idx"), (F.col("id") % 11).cast("int").alias("item_idx"), F.lit(3.0).alias("rating"))
    sides = [spark.range(n).select(F.col("id").cast("int").alias(name), F.array(F.rand(1), F.rand(2)).alias(f)) for n, name, f in ((7, "user_idx", "p"), (11, "item_idx", "q"))]
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = catalog._gradients(pairs, *sides, key, 2)
        plan = found._jdf.queryExecution().sparkPlan().toString(), found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    # Two sides of each of two joins, and the key's own factors once more.
    assert plan[1].count("Exchange hashpartitioning") == 5
    assert found.count() == (7 if key == "user_idx" else 11)
