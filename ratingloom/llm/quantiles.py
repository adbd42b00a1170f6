"""Exact quantiles of groups of any size, without a group meeting in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratingloom.scratch import materialize


def group_quantiles(rows: DataFrame, group: str, value: str, quantile: float) -> DataFrame:
    """(group, limit): each group's quantile of ``value``, between two values in proportion; a null group is a group.

    Values shrink to (value, times).  They are range partitioned by group and value and
    stored, so a large group lies in many parts.  The parts' totals, one row for each
    group and part, say where each part begins in its group; counts then run within parts.
    """
    known = rows.where(F.col(value).isNotNull()).select(F.struct(group).alias("g"), F.col(value).cast("double").alias("v"))
    counted = known.groupBy("g", "v").agg(F.count("*").alias("times"))
    placed = materialize(counted.repartitionByRange("g", "v").withColumn("part", F.spark_partition_id()), "quantile-values")
    each = Window.partitionBy("g")
    earlier = each.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy("g", "part").agg(F.sum("times").alias("n"))
    starts = totals.select("g", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"), F.sum("n").over(each).alias("all"))
    within = Window.partitionBy("g", "part").orderBy("v").rowsBetween(Window.unboundedPreceding, -1)
    running = placed.withColumn("before", F.coalesce(F.sum("times").over(within), F.lit(0))).join(materialize(starts, "quantile-starts"), ["g", "part"])
    place = F.lit(quantile) * (F.col("all") - 1)
    first, end = F.col("start") + F.col("before"), F.col("start") + F.col("before") + F.col("times")

    def at(rank):
        return F.max(F.when((first <= rank) & (rank < end), F.col("v")))

    share = F.max(place - F.floor(place))
    low, high = at(F.floor(place)), at(F.ceil(place))
    limit = F.when(share == 0, low).otherwise((1 - share) * low + share * high)
    return running.groupBy("g").agg(limit.alias("limit")).select(F.col("g")[group].alias(group), "limit")
