"""Positions in a list, without a task that sees the whole list."""

from __future__ import annotations

from pyspark.sql import functions as F

from ratingloom.operators import item_details
from ratingloom.plans import catalog


def test_positions_follow_the_order_over_many_ranges(spark):
    rows = spark.range(5_000, numPartitions=7).select(((F.col("id") * 7_919) % 5_000 * 3).alias("ordinal"), F.lit("x").alias("asin"))
    found = item_details.positions(rows, "ordinal", "asin")
    assert "Window" not in found._jdf.queryExecution().executedPlan().toString()
    assert {r.ordinal: r.position for r in found.collect()} == {3 * i: i + 1 for i in range(5_000)}
    assert item_details.positions(rows.limit(0), "ordinal", "asin").count() == 0


def test_looked_up_items_have_their_positions(spark, small_dir):
    rows = catalog.QUERIES["item_lookup"](spark, small_dir).orderBy("ordinal").collect()
    assert [r.position for r in rows] == list(range(1, len(rows) + 1))
