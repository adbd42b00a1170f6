"""Stored tables of the pipeline, published under one root as sets.

A root without a manifest holds one Parquet folder per table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ratingloom.sources import snapshots

# The tables' folder names.
INTERACTIONS = "interactions.parquet"
USER_MAP = "user_map.parquet"
ITEM_MAP = "item_map.parquet"
POPULAR_ITEMS = "popular_items.parquet"


def table_path(spark: SparkSession, root: str, name: str) -> str:
    return snapshots.current(spark, root).get(name, f"{root.rstrip('/')}/{name}")


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(spark, root, name))


# Columns of the tables that serving may find absent.
_SCHEMAS = {
    INTERACTIONS: "user_idx int, item_idx int, rating double",
    USER_MAP: "user_idx int, user_id string",
    ITEM_MAP: "item_idx int, item_id string",
    POPULAR_ITEMS: "item_idx int, count_ratings bigint, avg_rating double",
}


def path_exists(spark: SparkSession, path: str) -> bool:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


def read_or_empty(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The table, or one without rows where it was not written."""
    return read_set(spark, root, name)[0]


def read_set(spark: SparkSession, root: str, *names: str) -> list[DataFrame]:
    """Tables of one published set, empty where one was not written."""
    published = snapshots.current(spark, root)
    found = []
    for name in names:
        path = published.get(name, f"{root.rstrip('/')}/{name}")
        there = name in published or path_exists(spark, path)
        found.append(spark.read.parquet(path) if there else spark.createDataFrame([], _SCHEMAS[name]))
    return found


def write_table(df: DataFrame, root: str, name: str) -> str:
    """Publish a new version of one table; returns its path."""
    return snapshots.publish(df.sparkSession, root, {name: df.write.parquet})[name]
