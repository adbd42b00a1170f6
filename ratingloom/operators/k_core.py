"""The k-core of a ratings table: peeling users and items until none is too light.

Ratings are edges between user and item nodes.  Edges are stored once from either
end, and every node's count of rows, both cut by a hash of the node into bucket
folders.  A round then costs what it removes: the nodes that just fell below the
minimum meet their edges in the buckets they lie in, the rows they take from
other nodes are summed, and only the counts in those nodes' buckets are lowered
and written anew.  Nothing is recounted, no bucket without a change is read, and a
round's plan reads stored tables only, so plans do not grow with the rounds.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratingloom.scratch import scratch_path

# Rows of the edge table that one bucket aims at, and the most buckets.
BUCKET_ROWS, MOST_BUCKETS = 2_000_000, 4_096

_SIDES = {"user_id": "u", "item_id": "i"}


def node(key: str) -> Column:
    """The node of a user or an item; no user's node is an item's."""
    return F.concat(F.lit(_SIDES[key]), F.col(key).cast("string"))


def keys_of(nodes: DataFrame, key: str, kind: T.DataType) -> DataFrame:
    """(key, cnt) of the nodes that are users, or items."""
    mine = nodes.where(F.col("node").startswith(_SIDES[key]))
    return mine.select(F.substring("node", 2, 2**31 - 1).cast(kind).alias(key), "cnt")


class Counts:
    """Rows left per node: one folder per bucket, a newer one where counts fell."""

    def __init__(self, spark: SparkSession, buckets: int) -> None:
        self.spark, self.buckets = spark, buckets
        self.folders: dict[int, str] = {}

    def bucket(self, name: str) -> Column:
        return F.pmod(F.xxhash64(name), F.lit(self.buckets)).cast("int")

    def gathered(self, rows: DataFrame) -> DataFrame:
        """Rows of a bucket beside each other; a large bucket may still lie in many tasks."""
        return rows.hint("rebalance", "bucket") if self.buckets > 1 else rows.coalesce(1)

    def read(self, buckets: list[int]) -> DataFrame:
        """(node, base, left, fell, bucket) of the given buckets."""
        folders = [self.folders[b] for b in buckets if b in self.folders]
        schema = "node string, base bigint, left bigint, fell boolean, bucket int"
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    def write(self, counts: DataFrame) -> tuple[list[int], int]:
        """Replace the buckets that ``counts`` has; where nodes fell, and how many did."""
        seen, path = Observation(), scratch_path(self.spark, "core-counts")
        noted = self.gathered(counts).withColumn("_bucket", F.col("bucket")).observe(
            seen,
            F.collect_set("bucket").alias("present"),
            F.collect_set(F.when(F.col("fell"), F.col("bucket"))).alias("open"),
            F.count_if("fell").alias("fallen"),
        )
        noted.write.partitionBy("_bucket").parquet(path)
        found = seen.get
        self.folders |= {b: f"{path}/_bucket={b}" for b in found["present"]}
        return sorted(found["open"]), found["fallen"]


def surviving(ratings: DataFrame, minimum: int, iterations: int | None = None, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(node, cnt) of the users and items that are left; ``cnt`` is their rows in ``ratings``.

    With ``iterations`` None peeling goes on until nothing falls.  A number stops it
    after so many rounds, each of which looks at what the one before has left.
    ``ratings`` holds user_id and item_id and is read twice; rows with a null id
    belong to no node.  The number of rounds is that of the longest chain of nodes
    of which each falls because of the one before.
    """
    spark = ratings.sparkSession
    counts = Counts(spark, max(1, min(MOST_BUCKETS, math.ceil(2 * ratings.count() / bucket_rows))))
    ends = ratings.select(node("user_id").alias("u"), node("item_id").alias("i"))
    pairs = ends.dropna().groupBy("u", "i").agg(F.count("*").alias("times"))
    both = [F.struct(F.col(a).alias("node"), F.col(b).alias("other")) for a, b in ("ui", "iu")]
    links = pairs.select(F.explode(F.array(*both)).alias("e"), "times").select("e.node", "e.other", "times")
    links = links.withColumn("bucket", counts.bucket("node"))
    path, seen = scratch_path(spark, "core-links"), Observation()
    counts.gathered(links).observe(seen, F.count("*").alias("rows")).write.partitionBy("bucket").parquet(path)
    if not seen.get["rows"]:
        return spark.createDataFrame([], "node string, cnt bigint")
    links = spark.read.schema("node string, other string, times bigint, bucket int").parquet(path)

    base = links.groupBy("node", "bucket").agg(F.sum("times").alias("base"))
    started = base.select("node", "base", F.col("base").alias("left"), (F.col("base") < minimum).alias("fell"), "bucket")
    open_buckets, fallen = counts.write(started)
    rounds = 1
    while fallen and rounds != iterations:
        fell = counts.read(open_buckets).where("fell").select("node")
        taken = links.where(F.col("bucket").isin(open_buckets)).join(fell, "node").groupBy(F.col("other").alias("node")).agg(F.sum("times").alias("lost"))
        noted, lost_path = Observation(), scratch_path(spark, "core-lost")
        taken.withColumn("bucket", counts.bucket("node")).observe(noted, F.collect_set("bucket").alias("buckets")).write.parquet(lost_path)
        lost = spark.read.schema("node string, lost bigint, bucket int").parquet(lost_path).drop("bucket")
        left = F.col("left") - F.coalesce("lost", F.lit(0))
        now = counts.read(noted.get["buckets"]).join(lost, "node", "left")
        lowered = now.select("node", "base", left.alias("left"), ((F.col("left") >= minimum) & (left < minimum)).alias("fell"), "bucket")
        open_buckets, fallen = counts.write(lowered)
        rounds += 1
    return counts.read(sorted(counts.folders)).where(F.col("left") >= minimum).select("node", F.col("base").alias("cnt"))
