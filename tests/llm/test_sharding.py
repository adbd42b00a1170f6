import random
from collections import Counter
from math import comb

import pytest
from pyspark.sql import functions as F

from ratingloom.llm import sharding


def test_draws_follow_the_hypergeometric_law():
    rng = random.Random(7)
    for marked, others, drawn in ((5, 7, 4), (3, 1, 2), (20, 30, 10)):
        n = 20_000
        seen = Counter(sharding.hypergeometric(rng, marked, others, drawn) for _ in range(n))
        for k in range(drawn + 1):
            chance = comb(marked, k) * comb(others, drawn - k) / comb(marked + others, drawn) if drawn - k <= others else 0
            assert abs(seen[k] / n - chance) < 0.015


def test_large_draws_stay_in_range():
    rng = random.Random(1)
    for _ in range(200):
        drawn = sharding.hypergeometric(rng, 10**9, 23 * 10**9, 30_000_000)
        assert abs(drawn - 1_250_000) < 8 * 1100


def test_matrix_margins():
    sizes = [0, 5, 17, 100, 3, 1]
    matrix = sharding.communication_matrix(sizes, 7, 42)
    assert [sum(row) for row in matrix] == sizes
    columns = [sum(c) for c in zip(*matrix)]
    assert sum(columns) == sum(sizes) and max(columns) - min(columns) <= 1


@pytest.mark.parametrize("n,shards", [(1000, 24), (7, 24), (101, 3)])
def test_exact_sizes_and_gapless_slots(spark, n, shards):
    dealt = sharding.into_shards(spark.range(n), shards).cache()
    assert dealt.count() == n and dealt.select("id").distinct().count() == n
    sizes = Counter(r["shard"] for r in dealt.collect())
    assert max(sizes.values()) - min(sizes[s] for s in range(shards)) <= 1 and set(sizes) <= set(range(shards))
    for shard, size in sizes.items():
        assert sorted(r["slot"] for r in dealt.where(F.col("shard") == shard).collect()) == list(range(size))
    again = sharding.into_shards(spark.range(n).repartition(5), shards)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, dealt.collect()))


def test_shuffle_is_uniform(spark):
    """Over many seeds every row is in every shard about equally often."""
    seen = Counter()
    for seed in range(30):
        for r in sharding.into_shards(spark.range(8).coalesce(1), 2, seed=seed, partitions=4).collect():
            seen[r["id"], r["shard"]] += 1
    assert all(4 <= seen[i, s] <= 26 for i in range(8) for s in range(2))


def test_no_python_runs(documents):
    plan = sharding.into_shards(documents.select("doc_id"), 24)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_odd_rows(odd, nothing, wide):
    for table in (odd, wide):
        dealt = sharding.into_shards(table, 3)
        assert dealt.columns.count("shard") == dealt.columns.count("slot") == 1
        assert dealt.count() == table.count()
        assert dealt.groupBy("shard", "slot").count().where("count > 1").count() == 0
    assert sharding.into_shards(nothing, 3).count() == 0
