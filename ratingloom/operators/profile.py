"""Descriptive statistics of a ratings table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratingloom.functions.scalars import half_step
from ratingloom.scratch import materialize


def _activity(df: DataFrame, by: str, counted: str) -> DataFrame:
    per_key = df.groupBy(by).agg(F.count(counted).alias("num_ratings"))
    return per_key.orderBy(F.desc("num_ratings"), by)


def user_activity(df: DataFrame) -> DataFrame:
    """Ratings per user, most active first."""
    return _activity(df, "user_idx", "item_idx")


def item_popularity(df: DataFrame) -> DataFrame:
    """Ratings per item, most rated first."""
    return _activity(df, "item_idx", "user_idx")


def overview(df: DataFrame) -> DataFrame:
    """One row (num_rows, num_users, num_items, sparsity) from a single scan."""
    sizes = df.agg(
        F.count("*").cast("double").alias("num_rows"),
        F.count_distinct("user_idx").cast("double").alias("num_users"),
        F.count_distinct("item_idx").cast("double").alias("num_items"),
    )
    cells = F.greatest(F.col("num_users") * F.col("num_items"), F.lit(1.0))
    filled = F.least(F.col("num_rows") / cells, F.lit(1.0))
    return sizes.withColumn("sparsity", 1 - filled)


def basic_stats(df: DataFrame) -> dict[str, float]:
    return overview(df).first().asDict()


def distribution(df: DataFrame) -> DataFrame:
    """Ratings per half-step bin."""
    binned = df.groupBy(half_step(F.col("rating")).alias("rating_bin"))
    return binned.agg(F.count("rating").alias("count")).orderBy("rating_bin")


def _at_rank(rank: int) -> Column:
    """The value whose run of equal ratings covers a 0-based rank."""
    inside = (F.col("before") <= rank) & (F.col("before") + F.col("times") > rank)
    return F.max(F.when(inside, F.col("rating")))


def rating_profile(df: DataFrame) -> DataFrame:
    """One row (count, mean, median, min, max), the median being exact.

    Ratings shrink to (value, times) first.  To find the middle ranks without
    holding all distinct values in one task, values are range partitioned; the
    partition totals tell which partitions hold the middle, and running counts
    are taken in those alone.
    """
    values = df.where(F.col("rating").isNotNull()).groupBy("rating")
    values = values.agg(F.count("*").alias("times"))
    placed = materialize(
        values.repartitionByRange("rating").withColumn("part", F.spark_partition_id()),
        "rating-values",
    )
    totals = placed.groupBy("part").agg(F.sum("times").alias("times")).collect()
    rows = sum(row["times"] for row in totals)
    low, high = (rows - 1) // 2, rows // 2
    before, middle = 0, []
    for row in sorted(totals):
        if before <= high and low < before + row["times"]:
            middle.append((row["part"], before))
        before += row["times"]
    spark = df.sparkSession
    starts = spark.createDataFrame(middle, "part int, start bigint")
    earlier = Window.partitionBy("part").orderBy("rating").rowsBetween(Window.unboundedPreceding, -1)
    running = placed.join(F.broadcast(starts), "part").select(
        "rating",
        "times",
        (F.col("start") + F.coalesce(F.sum("times").over(earlier), F.lit(0))).alias("before"),
    )
    median = running.agg(
        ((_at_rank(low) + _at_rank(high)) / 2).alias("median")
    )
    return placed.agg(
        F.coalesce(F.sum("times"), F.lit(0)).alias("count"),
        (F.sum(F.col("rating") * F.col("times")) / F.sum("times")).alias("mean"),
        F.min("rating").alias("min"),
        F.max("rating").alias("max"),
    ).select("count", "mean", median.scalar().alias("median"), "min", "max")


def rating_summary(df: DataFrame) -> dict[str, float]:
    row = rating_profile(df).first()
    return {name: float(row[name]) for name in ("count", "mean", "median", "min", "max")}


def histogram(counts: DataFrame, bins: int = 50, limit_top: int | None = None) -> DataFrame:
    """``bins`` equal-width bins over ``num_ratings``: (bin, low, high, frequency).

    All rows count by default; ``limit_top`` keeps only the most active ones.
    Rows shrink to one per distinct count before the range is known.
    """
    if limit_top is not None:
        key = next(name for name in counts.columns if name != "num_ratings")
        counts = counts.orderBy(F.desc("num_ratings"), key).limit(limit_top)
    sizes = counts.groupBy("num_ratings").agg(F.count("*").alias("times"))
    least = sizes.agg(F.min("num_ratings").cast("double")).scalar()
    most = sizes.agg(F.max("num_ratings").cast("double")).scalar()
    placed = sizes.withColumn("_least", least).withColumn("_most", most)
    span = F.col("_most") - F.col("_least")
    slot = F.floor((F.col("num_ratings") - F.col("_least")) * bins / span)
    slot = F.when(span > 0, F.least(slot, F.lit(bins - 1))).otherwise(0).cast("int")
    width = span / bins
    return (
        placed.groupBy(slot.alias("bin"), "_least", width.alias("_width"))
        .agg(F.sum("times").alias("frequency"))
        .select(
            "bin",
            (F.col("_least") + F.col("bin") * F.col("_width")).alias("low"),
            (F.col("_least") + (F.col("bin") + 1) * F.col("_width")).alias("high"),
            "frequency",
        )
        .orderBy("bin")
    )
