"""Tables from which a few keys are read without a scan.

Rows lie in bucket folders by a hash of their key, sorted by key, with Bloom
filters on it.  A reader computes the buckets of the keys it wants, so other
folders are not even listed; within a file, sorted row groups and their filters
leave out what cannot hold a wanted key.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratingloom.scratch import materialize
from ratingloom.sources.tables import path_exists

# Rows that a bucket aims at, most buckets, and most keys that go into the scan as values.
BUCKET_ROWS, MOST_BUCKETS, LISTED_KEYS = 500_000, 10_000, 1_000


def _bucket(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def write_keyed(rows: DataFrame, path: str, key: str, *order: str, bucket_rows: int = BUCKET_ROWS) -> None:
    """Write ``rows`` to the empty ``path``, for ``read_keys``; ``order`` sorts the rows of a key.

    All rows of a key are written by one task and read together, so keys should have
    few rows each.  Rows without a key are not kept.
    """
    rows = materialize(rows.where(F.col(key).isNotNull()), "keyed")
    buckets = max(1, min(MOST_BUCKETS, math.ceil(rows.count() / bucket_rows)))
    placed = rows.withColumn("_bucket", _bucket(F.col(key), buckets))
    placed = placed.repartition(buckets, "_bucket").sortWithinPartitions("_bucket", key, *order)
    writer = placed.write.option(f"parquet.bloom.filter.enabled#{key}", "true")
    writer = writer.option(f"parquet.bloom.filter.expected.ndv#{key}", bucket_rows)
    writer.partitionBy("_bucket").parquet(f"{path}/_buckets={buckets}")


def _buckets_at(spark: SparkSession, path: str) -> int:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [status.getPath().getName() for status in system.listStatus(place)]
    return next(int(name.removeprefix("_buckets=")) for name in names if name.startswith("_buckets="))


def read_keys(spark: SparkSession, path: str, key: str, keys: Sequence | DataFrame) -> DataFrame:
    """The rows of the wanted keys, from their buckets alone.

    ``keys`` is a list of values or a frame with the column ``key`` of any size; of a
    frame only the numbers of its buckets come to the driver.
    """
    buckets = _buckets_at(spark, path)
    root = f"{path}/_buckets={buckets}"
    listed = [value for value in keys if value is not None] if not isinstance(keys, DataFrame) else None
    # Folders are named by the reader, so no listing of all buckets is needed; any of them has the schema.
    if listed is not None:
        wanted = spark.range(1).select(F.explode(F.lit(listed)).alias(key)) if listed else None
    else:
        wanted = keys.select(key).dropna().distinct()
    numbers = [] if wanted is None else [row[0] for row in wanted.select(_bucket(F.col(key), buckets)).distinct().collect()]
    folders = [folder for folder in (f"{root}/_bucket={n}" for n in sorted(numbers)) if path_exists(spark, folder)]
    if not folders:
        return spark.read.parquet(root).drop("_bucket").limit(0) if path_exists(spark, root) else spark.createDataFrame([], f"{key} string")
    rows = spark.read.parquet(*folders).drop("_bucket")
    if listed is not None and len(listed) <= LISTED_KEYS:
        return rows.where(F.col(key).isin(listed))
    return rows.join(wanted, key, "left_semi")
