"""All candidates scored in one pass against one evaluation each."""

import pytest
from pyspark.sql import functions as F

from ratingloom.operators import factor_models, grid, ranking_metrics
from ratingloom.plans import bias_model, inputs


@pytest.fixture(scope="module")
def split(spark):
    pairs = inputs.rated_pairs(spark, "/root/testdata/sf0.001")
    held = F.pmod(F.xxhash64("user_idx", "item_idx"), F.lit(5)) == 0
    return pairs.where(~held).cache(), pairs.where(held).cache()


@pytest.mark.parametrize("kind", ["als", "bias"])
def test_grouped_metrics_are_those_of_each_model(split, kind):
    train, validation = split
    if kind == "als":
        candidates = [{"rank": r, "regParam": g} for r in (2, 5) for g in (0.05, 0.4)]
        fit, score_all, score = lambda t, **p: factor_models.fit_als(t, maxIter=2, **p), factor_models.predict_all, factor_models.predict
    else:
        candidates = [{"item_damping": a, "user_damping": b} for a in (0.0, 10.0) for b in (1.0, 30.0)]
        fit, score_all, score = bias_model.RatingSums.of(train).fit, bias_model.predict_all, lambda model, pairs: model.transform(pairs)
    trials, best = grid.search(train, validation, candidates, fit, 5, score_all=score_all)
    assert [t.params for t in trials] == candidates
    for trial in trials:
        alone = ranking_metrics.evaluate(score(fit(train, **trial.params), validation), 5).first()
        for name in grid.METRICS:
            assert trial.metrics[name] == pytest.approx(alone[name], abs=1e-6)
    plain, _ = grid.search(train, validation, candidates[:2], fit, 5)
    assert [t.metrics for t in plain] == [pytest.approx(t.metrics, abs=1e-5) for t in trials[:2]]


def test_validation_is_read_once(split, capsys):
    train, validation = split
    models = [factor_models.fit_als(train, rank=2, maxIter=1, regParam=g) for g in (0.1, 0.2, 0.3)]
    factor_models.predict_all(models, validation).explain()
    plan = capsys.readouterr().out
    assert plan.count("InMemoryTableScan") == 1
    sums = bias_model.RatingSums.of(train)
    bias_model.predict_all([sums.fit(train, d, d) for d in (0.0, 1.0, 2.0)], validation).explain()
    assert capsys.readouterr().out.count("InMemoryTableScan") == 1


def test_models_that_predict_nothing(spark, split):
    train, _ = split
    strangers = spark.createDataFrame([(-1, -1, 3.0)], "user_idx int, item_idx int, rating double")
    fit = bias_model.RatingSums.of(train).fit
    trials, _ = grid.search(train, strangers, [{"item_damping": 1.0, "user_damping": 1.0}], fit, score_all=bias_model.predict_all)
    assert trials[0].metrics == {"rmse": None, "precision_at_k": 0.0, "recall_at_k": 0.0, "ndcg_at_k": 0.0}
