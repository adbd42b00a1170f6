"""Integer k-means against a plain version in exact Python integers."""

import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from ratingloom.llm import centroid_clustering as cc
from ratingloom.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int, v int, cluster int, distance string"


def brute(rows, count=8, rounds=10, dims=64):
    kept = [(i, [math.floor(1024 * x) for x in e]) for i, e in rows if e is not None and len(e) == dims and all(x is not None and math.isfinite(x) for x in e)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    centroids = [v for _, v in order[:count]]

    def assign(v):
        return min((sum((x - c) ** 2 for x, c in zip(v, centroid)), k) for k, centroid in enumerate(centroids))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(assign(v)[1], []).append(v)
        centroids = [[sum(xs) // len(groups[k]) for xs in zip(*groups[k])] if k in groups else c for k, c in enumerate(centroids)]
    found = [(i, *assign(v)[::-1]) for i, v in kept]
    inertia = {}
    for _, k, d in found:
        inertia[k] = inertia.get(k, 0) + d
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, k, d, inertia[k], sum(inertia.values()), digests[k]) for i, k, d in found), key=repr)


def found(spark, rows, **options):
    table = spark.createDataFrame([(i, e, 0, 1, 2, "x") for i, e in rows], SCHEMA)
    result = cc.with_inertia(*cc.cluster(table, **options))
    assert result.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return sorted(map(tuple, result.collect()), key=repr)


def vector(rng, centre=0.0, dims=64):
    # Multiples of 2**-12 are the same as floats and doubles.
    return [round((centre + rng.gauss(0, 0.2)) * 4096) / 4096 for _ in range(dims)]


def test_query_is_the_brute_force(spark, small_dir):
    table = spark.read.parquet(f"{small_dir}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in table.collect()]
    got = QUERIES["op11_centroid_clustering"](spark, small_dir)
    assert [f.dataType.simpleString() for f in got.schema] == ["bigint", "int", "bigint", "bigint", "bigint", "string"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows)


def test_odd_rows_ties_and_repeats(spark):
    rng = random.Random(5)
    rows = [(i, vector(rng, i % 3)) for i in range(40)]
    rows += [(3, rows[3][1]), (3, vector(rng)), (100, rows[5][1]), (None, vector(rng)), (101, [0.0] * 64), (102, [0.0] * 64), (103, [-0.0] * 64)]
    rows += [(200, None), (201, []), (202, [1.0] * 63), (203, [None] + [0.0] * 63), (204, [float("nan")] + [0.0] * 63), (205, [float("-inf")] + [0.0] * 63)]
    assert found(spark, rows) == brute(rows)


def test_one_vector_in_many_copies(spark):
    rng = random.Random(6)
    rows = [(i, [0.25] * 64) for i in range(60)] + [(i, vector(rng)) for i in range(60, 90)]
    assert found(spark, rows) == brute(rows)


def test_fewer_vectors_than_centroids_and_none(spark):
    rows = [(i, [float(i)] * 64) for i in range(3)]
    assert found(spark, rows) == brute(rows)
    assert found(spark, []) == [] and found(spark, [(1, None)]) == []


def test_other_sizes(spark):
    rng = random.Random(7)
    rows = [(i, vector(rng, dims=5)) for i in range(50)]
    assert found(spark, rows, count=3, rounds=2, dimensions=5) == brute(rows, 3, 2, 5)


def test_components_beyond_longs_are_an_error(spark):
    with pytest.raises(Exception, match="too large"):
        found(spark, [(1, [3e38] * 64), (2, [-3e38] * 64)])


def test_no_python_worker_and_one_small_shuffle(spark, small_dir, capsys):
    table = spark.read.parquet(f"{small_dir}/embeddings.parquet")
    vectors = cc.integer_vectors(table, "vec_id", "embedding")
    assigned = vectors.select(cc.nearest(F.col("v"), [[0] * 64] * 8)["cluster"].alias("c"), "v").groupBy("c").agg(*[F.sum(F.col("v")[i]) for i in range(64)])
    assigned.explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Arrow" not in plan and plan.count("Exchange") == 1 and "partial_sum" in plan
