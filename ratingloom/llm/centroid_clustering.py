"""Integer k-means whose every step is an expression of the JVM.

1. A component x becomes the integer floor(1024 * x); from here on all sums are
   exact, so no result depends on the order in which rows meet.
2. The first centroids are the vectors with the smallest hashes of their ids.
3. A round writes the centroids as literal arrays.  ``zip_with`` and ``aggregate``
   give a vector's squared distance to each, and ``array_min`` over structs of
   (distance, number) picks the nearest, equal distances by number.
4. One aggregation sums each component as a column of its own, with partial sums
   before the shuffle, so a round moves one row for each cluster and task, however
   many vectors a cluster holds.  Floors of the means are the next centroids.
5. Rounds end early only where nothing moved, since the rest would repeat it.

The driver sees the centroids and sums of each cluster, a number of values fixed
by the parameters, and never a vector besides the first centroids.

Nulls and odd input: a vector that is null, has another length, or holds a null,
NaN or infinite component is left out.  Repeated rows count as often as they are
there; among equal hashes the smaller integer vector comes first, and rows whose
id is null come last and are assigned like others.  With fewer vectors than
centroids there are as many centroids as vectors.  Components beyond ±131072
raise an error, since distances between such vectors need not fit a long.  Other
columns play no part.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratingloom.scratch import materialize

#: Components of a vector, integer steps to one, first centroids, rounds, and what stands before an id in its hash.
DIMENSIONS, SCALE, CENTROIDS, ROUNDS, SALT = 64, 1024, 8, 10, "3:"
#: Largest integer component: 64 squares of twice as much still fit a long.
LARGEST = 1 << 27


def _finite(value: Column) -> Column:
    return value.isNotNull() & ~F.isnan(value) & (F.abs(value) != float("inf"))


def integer_vectors(rows: DataFrame, key: str, vector: str, dimensions: int = DIMENSIONS) -> DataFrame:
    """(key, ``v``): the whole vectors of ``rows``, in integers."""
    whole = (F.size(vector) == dimensions) & F.forall(vector, _finite)
    whole_only = rows.where(whole).select(key, F.transform(vector, lambda x: F.floor(F.lit(float(SCALE)) * x.cast("double"))).alias("v"))
    fits = F.forall("v", lambda x: x.between(-LARGEST, LARGEST))
    return whole_only.withColumn("v", F.when(fits, F.col("v")).otherwise(F.raise_error(F.lit("a component is too large for distances in longs"))))


def _literal(centroid: list[int]) -> Column:
    return F.expr(f"array({','.join(f'{c}L' for c in centroid)})")


def nearest(vector: Column, centroids: list[list[int]]) -> Column:
    """Struct (distance, cluster) of the nearest centroid."""

    def distance(centroid: list[int]) -> Column:
        squares = F.zip_with(vector, _literal(centroid), lambda x, c: (x - c) * (x - c))
        return F.aggregate(squares, F.lit(0).cast("long"), lambda total, square: total + square)

    return F.array_min(F.array(*[F.struct(distance(c).alias("distance"), F.lit(i).alias("cluster")) for i, c in enumerate(centroids)]))


def first_centroids(vectors: DataFrame, key: str, count: int = CENTROIDS) -> list[list[int]]:
    """The vectors whose ids hash lowest, in the order of their hashes."""
    digest = F.sha2(F.concat(F.lit(SALT), F.col(key).cast("string")), 256)
    return [row["v"] for row in vectors.orderBy(digest.asc_nulls_last(), "v").select("v").limit(count).collect()]


def moved(vectors: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """Floors of the means of each centroid's vectors; a centroid without vectors stays."""
    sums = [F.sum(F.col("v")[i]).alias(f"s{i}") for i in range(len(centroids[0]))]
    assigned = vectors.select(nearest(F.col("v"), centroids)["cluster"].alias("cluster"), "v")
    following = list(centroids)
    for cluster, n, *totals in assigned.groupBy("cluster").agg(F.count("*").alias("n"), *sums).collect():
        following[cluster] = [total // n for total in totals]
    return following


def cluster(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", count: int = CENTROIDS, rounds: int = ROUNDS, dimensions: int = DIMENSIONS) -> tuple[DataFrame, list[list[int]]]:
    """(key, cluster, distance) of every whole vector, and the final centroids."""
    vectors = materialize(integer_vectors(rows, key, vector, dimensions), "integer-vectors")
    centroids = first_centroids(vectors, key, count)
    if not centroids:
        return vectors.select(key, F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), []
    for _ in range(rounds):
        following = moved(vectors, centroids)
        if following == centroids:
            break
        centroids = following
    best = vectors.select(key, nearest(F.col("v"), centroids).alias("best"))
    return materialize(best.select(key, "best.cluster", "best.distance"), "clusters"), centroids


def digest(centroid: list[int]) -> str:
    """Hex SHA-256 of a centroid's components as decimal integers, joined by commas."""
    return hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()


def with_inertia(assigned: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """``assigned`` with its cluster's and the whole inertia, and the centroid's digest."""
    sums = dict(assigned.groupBy("cluster").agg(F.sum("distance")).collect())

    def by_cluster(values: list, kind: str) -> Column:
        return F.element_at(F.array(*[F.lit(v).cast(kind) for v in values] or [F.lit(None).cast(kind)]), F.col("cluster") + 1)

    return assigned.withColumns(
        {
            "cluster_inertia": by_cluster([sums.get(i, 0) for i in range(len(centroids))], "long"),
            "inertia": F.lit(sum(sums.values())).cast("long"),
            "centroid_sha256": by_cluster([digest(c) for c in centroids], "string"),
        }
    )
