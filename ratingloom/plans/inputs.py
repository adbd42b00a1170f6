"""Recommender inputs seen in the order, event and vector tables of a data folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def order_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines with their buyer: (o_custkey, l_partkey, l_quantity)."""
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        "o_custkey", "l_partkey", "l_quantity"
    )


def ratings(spark: SparkSession, folder: str) -> DataFrame:
    """(user_id, item_id, rating 1..5): buyers rate parts by quantity."""
    return order_lines(spark, folder).select(
        F.col("o_custkey").cast("string").alias("user_id"),
        F.col("l_partkey").cast("string").alias("item_id"),
        F.ceil(F.col("l_quantity") / 10).cast("double").alias("rating"),
    )


def rated_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """One row per buyer and part with the highest rating, ids as ints."""
    return (
        order_lines(spark, folder)
        .groupBy(
            F.col("o_custkey").cast("int").alias("user_idx"),
            F.col("l_partkey").cast("int").alias("item_idx"),
        )
        .agg(F.max(F.ceil(F.col("l_quantity") / 10)).cast("double").alias("rating"))
    )


def event_reviews(spark: SparkSession, folder: str) -> DataFrame:
    """Events as raw reviews under alias names; errors carry no readable rating."""
    stars = F.create_map(
        *[F.lit(x) for x in ("purchase", "5", "signup", "4", "click", "3", "view", "2")]
    )
    return table(spark, folder, "events").select(
        F.col("user_id").alias("reviewerID"),
        F.get_json_object("props", "$.k").alias("asin"),
        F.coalesce(F.try_element_at(stars, F.col("event_type")), F.lit("n/a")).alias("overall"),
        F.col("ts").alias("unixReviewTime"),
        "event_id",
    )


def vectors(spark: SparkSession, folder: str) -> DataFrame:
    """(id int, features) of the vector table, shaped like a factor table."""
    return table(spark, folder, "embeddings").select(
        F.col("vec_id").cast("int").alias("id"), F.col("embedding").alias("features")
    )
