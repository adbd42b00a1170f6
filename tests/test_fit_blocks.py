from ratingloom.operators import factor_models


def test_blocks_grow_with_the_ratings(spark, monkeypatch):
    """A task holds a bounded number of ratings; few of them are fitted in ten blocks, as ever."""
    assert [factor_models.blocks_for(n) for n in (0, 40_000_000, 40_000_001, 216_000_000)] == [10, 10, 11, 54]
    asked = []

    class Recorded(factor_models.ALS):
        def __init__(self, **given):
            asked.append((given["numUserBlocks"], given["numItemBlocks"]))
            super().__init__(**given)

    monkeypatch.setattr(factor_models, "ALS", Recorded)
    monkeypatch.setattr(factor_models, "BLOCK_RATINGS", 20)
    train = spark.createDataFrame([(n % 17, n % 19, 1.0 + n % 5) for n in range(300)], "user_idx int, item_idx int, rating double")
    model = factor_models.fit_als(train, rank=2, maxIter=1)
    factor_models.fit_als(train, rank=2, maxIter=1, blocks=3)
    assert asked == [(15, 15), (3, 3)]
    assert model.userFactors.count() == 17 and model.itemFactors.count() == 19
