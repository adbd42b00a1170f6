"""Factor models, grid search and stored results."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratingloom.operators import factor_models, grid
from ratingloom.plans import inputs
from ratingloom.plans.serve_tables import recommendation_table, similarity_table
from ratingloom.plans.train import train_als
from ratingloom.sources import experiments, models, tables
from ratingloom.plans.etl import preprocess_reviews


@pytest.fixture(scope="module")
def fitted(spark):
    pairs = inputs.rated_pairs(spark, "/root/testdata/sf0.001").cache()
    return pairs, factor_models.fit_als(pairs, rank=6, regParam=0.1, maxIter=4)


def test_item_factors_solve_their_normal_equations(spark, fitted):
    """Items are solved from users or users from items last; the last side is exact."""
    pairs, model = fitted
    users = {r.id: np.array(r.features, dtype=np.float64) for r in model.userFactors.collect()}
    items = {r.id: np.array(r.features, dtype=np.float64) for r in model.itemFactors.collect()}
    by_user = {}
    for r in pairs.collect():
        by_user.setdefault(r.user_idx, []).append((r.item_idx, r.rating))
    worst = 0.0
    for user, rated in by_user.items():
        q = np.stack([items[i] for i, _ in rated])
        target = np.array([r for _, r in rated])
        p = np.linalg.solve(q.T @ q + 0.1 * len(rated) * np.eye(6), q.T @ target)
        worst = max(worst, float(np.abs(p - users[user]).max()))
    assert worst < 1e-4


def test_top_n_agrees_with_the_model(fitted):
    pairs, model = fitted
    mine = factor_models.recommend_for_users(model, pairs, 5).collect()
    theirs = model.recommendForUserSubset(pairs.select("user_idx").distinct(), 5).collect()
    scores = {(r.user_idx, r["rank"]): r.score for r in mine}
    for row in theirs:
        for rank, rec in enumerate(row.recommendations, 1):
            assert scores[row.user_idx, rank] == pytest.approx(rec.rating, abs=1e-4)
    assert len(scores) == sum(len(r.recommendations) for r in theirs)


def test_predict_drops_unseen_pairs(spark, fitted):
    _, model = fitted
    pairs = spark.createDataFrame(
        [(1, 1, 3.0), (999_999, 1, 3.0), (1, 999_999, 3.0)], "user_idx int, item_idx int, rating double"
    )
    assert factor_models.predict(model, pairs).select("user_idx", "item_idx").collect() == [(1, 1)]


def test_the_model_does_not_depend_on_the_session(spark, fitted):
    pairs, model = fitted
    want = {(r.user_idx, r.item_idx): r.prediction for r in factor_models.predict(model, pairs).collect()}
    for parts in (1, 13):
        again = factor_models.fit_als(pairs.repartition(parts), rank=6, regParam=0.1, maxIter=4)
        for r in factor_models.predict(again, pairs).collect():
            assert r.prediction == pytest.approx(want[r.user_idx, r.item_idx], abs=1e-4)


def test_predictions_are_mllibs(fitted):
    pairs, model = fitted
    mine = {(r.user_idx, r.item_idx): r.prediction for r in factor_models.predict(model, pairs).collect()}
    theirs = model.transform(pairs).collect()
    assert len(theirs) == len(mine)
    assert all(r.prediction == pytest.approx(mine[r.user_idx, r.item_idx], abs=1e-4) for r in theirs)


def test_default_grid_and_order():
    assert [c["regParam"] for c in grid.grid(grid.ALS_GRID)] == [0.02, 0.05, 0.1, 0.2, 0.4, 0.8]
    assert grid.grid({"a": (1, 2), "b": (3, 4)})[1] == {"a": 1, "b": 4}


def test_best_trial_breaks_ties_by_error_then_place(spark):
    scores = [(0.80, 1.3), (0.81, 1.4), (0.81, 1.2), (0.81, 1.2)]
    trials = [
        grid.Trial(
            {"rank": 32, "regParam": 0.1 * at},
            {"rmse": e, "precision_at_k": p, "recall_at_k": 0.0, "ndcg_at_k": 0.0},
        )
        for at, (p, e) in enumerate(scores)
    ]
    frame = grid.trials_frame(spark, trials)
    assert grid.best_trial(frame).first()["ordinal"] == 2
    rows = frame.orderBy("ordinal").collect()
    assert [r.is_best for r in rows] == [False, False, True, False]
    assert rows[0].tags == {"candidate": "true"} and rows[2].tags == {"best": "true"}
    assert rows[2].run_name == "best_rank=32_reg=0.2"


def test_search_keeps_the_best_model(spark):
    class Constant:
        def __init__(self, value):
            self.value = value

        def transform(self, df):
            return df.withColumn("prediction", F.lit(self.value))

    pairs = spark.createDataFrame([(0, 0, 4.0), (0, 1, 4.0)], "user_idx int, item_idx int, rating double")
    trials, best = grid.search(
        pairs, pairs, [{"value": 1.0}, {"value": 4.0}, {"value": 9.0}], lambda _, value: Constant(value)
    )
    assert best.value == 4.0 and [t.metrics["rmse"] for t in trials] == [3.0, 0.0, 5.0]


def test_latest_grid_needs_a_run(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        experiments.read_latest_grid(spark, str(tmp_path))


def test_train_then_serve(spark, tmp_path):
    source, out, artifacts = (str(tmp_path / name) for name in ("raw.parquet", "tables", "artifacts"))
    inputs.ratings(spark, "/root/testdata/sf0.001").write.parquet(source)
    preprocess_reviews(spark, source, out, 30)
    interactions = tables.read_table(spark, out, tables.INTERACTIONS)
    done = train_als(
        spark, interactions, artifacts, {"rank": (4,), "regParam": (0.1, 0.8)}, maxIter=3, k=5
    )
    assert set(done.metrics) == {"rmse", "precision@k", "ndcg@k"}
    assert done.params["rank"] == 4 and done.params["regParam"] in (0.1, 0.8)
    document = models.read_metadata_document(spark, done.model_path).first()
    assert document.params.regParam == done.params["regParam"]
    assert document.metrics.rmse == pytest.approx(done.metrics["rmse"])
    latest = experiments.read_latest_grid(spark, f"{artifacts}/metrics").collect()
    assert sorted(r.regParam for r in latest) == [0.1, 0.8]
    assert spark.read.parquet(done.results["runs"]).count() == 2
    assert models.load_model(done.model_path).rank == 4

    users = spark.createDataFrame([("1",), ("nobody",)], "user_id string")
    recs = recommendation_table(spark, out, done.model_path, users, 7).collect()
    assert len(recs) == 14
    assert {r.user_id: r.source for r in recs}["nobody"] == "popularity"
    items = tables.read_table(spark, out, tables.ITEM_MAP)
    similar = similarity_table(spark, out, done.model_path, n=4)
    assert similar.count() == 4 * items.count()
    assert similar.where("item_id = similar_item_id AND source = 'als'").isEmpty()
