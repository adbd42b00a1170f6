"""Peeling against recounting, on random, chain-shaped, skewed and odd ratings."""

import random
from collections import Counter

import pytest

from ratingloom.operators import k_core
from ratingloom.operators.thresholds import min_interactions
from ratingloom.scratch import materialize

SCHEMA = "user_id string, item_id string, rating double"


def peeled(pairs, minimum, iterations=None):
    rounds = 0
    while iterations is None or rounds < iterations:
        users, items = Counter(u for u, _ in pairs), Counter(i for _, i in pairs)
        kept = [(u, i) for u, i in pairs if users[u] >= minimum and items[i] >= minimum]
        rounds += 1
        if len(kept) == len(pairs):
            break
        pairs = kept
    return Counter(pairs)


def found(spark, pairs, minimum, iterations=None, **options):
    table = materialize(spark.createDataFrame([(u, i, 1.0) for u, i in pairs], SCHEMA), "ratings")
    rows = min_interactions(table, minimum, iterations=iterations, **options).collect()
    return Counter((r["user_id"], r["item_id"]) for r in rows)


@pytest.mark.parametrize("iterations", [None, 2, 3])
def test_random_ratings_in_many_buckets(spark, monkeypatch, iterations):
    monkeypatch.setattr(k_core.surviving, "__defaults__", (None, 60))
    rng = random.Random(4)
    pairs = [(f"u{int(rng.random() ** 2 * 60)}", f"u{int(rng.random() ** 2 * 80)}") for _ in range(400)]
    assert found(spark, pairs, 6, iterations) == peeled(pairs, 6, iterations)


def test_a_third_of_all_rows_on_one_item(spark):
    rng = random.Random(5)
    pairs = [(f"u{n}", "hot") for n in range(150)] + [(f"u{rng.randrange(150)}", f"i{rng.randrange(40)}") for _ in range(300)]
    assert found(spark, pairs, 4, slice_rows=20) == peeled(pairs, 4)


def test_chain_plans_do_not_grow(spark, monkeypatch):
    """A path falls node by node from its ends; a cycle beside it stays."""
    depth = 12
    path = [(f"c{n}", f"d{n}") for n in range(depth)] + [(f"c{n + 1}", f"d{n}") for n in range(depth)]
    cycle = [("x", "p"), ("x", "q"), ("y", "p"), ("y", "q")]
    sizes = []
    write = k_core.Counts.write

    def measured(self, counts):
        sizes.append(len(counts._jdf.queryExecution().optimizedPlan().toString()))
        return write(self, counts)

    monkeypatch.setattr(k_core.Counts, "write", measured)
    assert found(spark, path + cycle, 2) == Counter(cycle)
    assert len(sizes) > depth / 2 and max(sizes[2:]) <= min(sizes[1:]) * 1.2


def test_numbers_as_ids_repeats_nulls_and_nothing(spark):
    rows = [(1, 7), (1, 7), (2, 7), (2, 7), (3, 8), (None, 7), (1, None)]
    table = materialize(spark.createDataFrame(rows, "user_id long, item_id int"), "numbers")
    kept = min_interactions(table, 2, iterations=None)
    assert kept.schema == table.schema
    assert sorted(map(tuple, kept.collect())) == [(1, 7), (1, 7), (2, 7), (2, 7)]
    assert found(spark, [], 2) == Counter()
    assert found(spark, [("a", "b")], 2) == Counter()
