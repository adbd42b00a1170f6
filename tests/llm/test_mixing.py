import math

import pytest
from pyspark.sql import functions as F

from ratingloom.llm import mixing


def slow_exponent(sizes, entropy=None, repetition=None):
    total = sum(sizes)
    shares = [s / total for s in sizes]

    def weights(a):
        powers = [s**a for s in shares]
        return [p / sum(powers) for p in powers]

    def too_high(a):
        if repetition is not None:
            return (max(shares) / min(shares)) ** (1 - a) < repetition
        return -sum(w * math.log(w) for w in weights(a)) < entropy

    if too_high(0):
        return 0.0
    if not too_high(1):
        return 1.0
    low, high = 0.0, 1.0
    for _ in range(50):
        middle = (low + high) / 2
        low, high = (low, middle) if too_high(middle) else (middle, high)
    return high if repetition is not None else low


@pytest.mark.parametrize("target", [{"repetition": 2.0}, {"repetition": 100.0}, {"entropy": 1.2}, {"entropy": 0.1}, {"entropy": 9.0}])
def test_exponent(spark, target):
    sizes = [900, 250, 40, 40, 7]
    table = spark.createDataFrame([(str(i), n) for i, n in enumerate(sizes)], "source string, tokens long")
    assert mixing.solve_exponent(table, **target) == pytest.approx(slow_exponent(sizes, **target), abs=1e-9)


def test_targets_are_exclusive(spark):
    table = spark.createDataFrame([("a", 1)], "source string, tokens long")
    for wrong in ({}, {"entropy": 1.0, "repetition": 2.0}):
        with pytest.raises(ValueError):
            mixing.solve_exponent(table, **wrong)


def test_mixture_meets_weights_and_limits(documents):
    skewed = documents.withColumn("source", F.when(F.col("doc_id") % 3 == 0, "big").otherwise(F.col("source")))
    mixed = mixing.mixture(skewed, repetition=2.0, block_tokens=20_000).cache()
    sizes = {r["source"]: r["n"] for r in skewed.groupBy("source").agg(F.sum(mixing.token_count(F.col("text"))).alias("n")).collect()}
    dealt = {r["source"]: r["n"] for r in mixed.groupBy("source").agg(F.sum("n_tokens").alias("n")).collect()}
    a = slow_exponent(list(sizes.values()), repetition=2.0)
    factor = 1 / min(n ** (a - 1) for n in sizes.values())
    longest = mixed.agg(F.max("n_tokens")).first()[0]
    for source, n in sizes.items():
        assert n <= dealt[source] <= 2 * n + longest
        assert abs(dealt[source] - factor * n**a) <= longest + 1
    assert mixed.groupBy("doc_id", "epoch").count().where("count > 1").count() == 0
    assert {r["doc_id"] for r in mixed.collect()} == {r["doc_id"] for r in documents.collect()}
    for block in mixed.groupBy("block").agg(F.min("slot").alias("low"), F.max("slot").alias("high"), F.count_distinct("slot").alias("n")).collect():
        assert (block["low"], block["high"]) == (0, block["n"] - 1)
    again = mixing.mixture(skewed.repartition(7), repetition=2.0, block_tokens=20_000)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, mixed.collect()))
    rows = mixing.repeated(skewed, repetition=2.0)
    assert rows.columns == documents.columns and rows.count() == mixed.count()


def test_a_small_budget_leaves_documents_out(documents):
    budget = 20_000
    mixed = mixing.mixture(documents, entropy=2.9, budget=budget)
    total, longest = mixed.agg(F.sum("n_tokens"), F.max("n_tokens")).first()
    assert abs(total - budget) <= 20 * longest and mixed.agg(F.max("epoch")).first()[0] == 0


def test_odd_rows(odd, nothing, wide):
    for table in (odd, wide):
        mixed = mixing.mixture(table, repetition=3.0)
        assert {r["doc_id"] for r in mixed.collect()} == {r["doc_id"] for r in odd.collect()}
        rows = mixing.repeated(table, repetition=3.0)
        assert rows.columns == table.columns and rows.count() == mixed.count()
        twins = [r for r in mixed.collect() if r["doc_id"] == 2]
        assert len(twins) % 2 == 0
    assert mixing.mixture(nothing, repetition=2.0).count() == 0
    assert mixing.repeated(nothing, entropy=1.0).count() == 0
