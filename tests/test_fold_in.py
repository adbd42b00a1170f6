"""Folded-in factors against a dense solution, for explicit and implicit feedback and hot keys."""

import numpy as np
import pytest

from ratingloom.operators import factor_models, fold_in

RANK = 5


def dense(rated, factors, reg, alpha):
    shared = sum(np.outer(y, y) for y in factors.values()) if alpha is not None else 0
    out = {}
    for key, pairs in rated.items():
        known = [(factors[o], r) for o, r in pairs if o in factors]
        if not known:
            continue
        matrix, right, count = np.zeros((RANK, RANK)) + shared, np.zeros(RANK), 0
        for y, r in known:
            if alpha is None:
                matrix, right, count = matrix + np.outer(y, y), right + r * y, count + 1
            else:
                c = alpha * abs(r)
                matrix = matrix + c * np.outer(y, y)
                if r > 0:
                    right, count = right + (1 + c) * y, count + 1
        out[key] = np.linalg.solve(matrix + reg * count * np.eye(RANK), right)
    return out


@pytest.mark.parametrize("alpha", [None, 1.5])
@pytest.mark.parametrize("slice_rows", [4_000_000, 100])
def test_folded_factors_solve_the_equations(spark, monkeypatch, alpha, slice_rows):
    monkeypatch.setattr(fold_in, "HELD_ROWS", 64)
    rng = np.random.default_rng(3)
    factors = {int(i): rng.normal(size=RANK) for i in range(400)}
    pairs = [(int(u), int(i), float(r)) for u, i, r in zip(rng.integers(0, 40, 900), rng.integers(0, 420, 900), rng.integers(-2, 6, 900))]
    pairs += [(77, i, float(i % 5)) for i in range(400)]  # a third of all rows
    pairs += [(78, 9999, 3.0)]  # rated nothing that has factors
    ratings = spark.createDataFrame(pairs, "user_idx int, item_idx int, rating double")
    items = spark.createDataFrame([(i, v.tolist()) for i, v in factors.items()], "id int, features array<double>")
    found = fold_in.fold_in(ratings, items, "user_idx", "item_idx", 0.1, alpha, slice_rows)
    got = {r["id"]: np.array(r["features"]) for r in found.collect()}
    rated = {}
    for u, i, r in pairs:
        rated.setdefault(u, []).append((i, r))
    want = dense(rated, factors, 0.1, alpha)
    assert got.keys() == want.keys()
    assert max(np.abs(got[u] - want[u]).max() for u in want) < 1e-4


def test_alpha_counts_only_for_implicit_feedback(spark):
    ratings = spark.createDataFrame([(u, i, float((u * i) % 4)) for u in range(12) for i in range(9)], "user_idx int, item_idx int, rating double")
    fits = {}
    for implicit in (False, True):
        for alpha in (1.0, 20.0):
            model = factor_models.fit_als(ratings, rank=3, maxIter=3, alpha=alpha, implicit=implicit)
            fits[implicit, alpha] = {r["id"]: tuple(r["features"]) for r in model.userFactors.collect()}
    assert fits[False, 1.0] == fits[False, 20.0] and fits[True, 1.0] != fits[True, 20.0]


def test_no_ratings(spark):
    none = spark.createDataFrame([], "user_idx int, item_idx int, rating double")
    items = spark.createDataFrame([(1, [1.0, 2.0])], "id int, features array<float>")
    assert fold_in.fold_in(none, items, "user_idx", "item_idx").collect() == []
