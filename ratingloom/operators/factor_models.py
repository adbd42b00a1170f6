"""Matrix factorisation of explicit or implicit feedback with MLlib's ALS."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingloom.functions.vectors import dot
from ratingloom.operators.lookup import attach_counted
from ratingloom.operators.nearest import top_n
from ratingloom.scratch import materialize, shared_folder

# MLlib draws the first factors block by block, so the number of blocks is part of the
# model like its seed: it must not follow from the cluster, and grows with the ratings alone.
BLOCKS = 10
# Most ratings that a task should hold as one block; building one takes some 60 bytes for each.
BLOCK_RATINGS = 4_000_000
# Iterations whose shuffle files (all factors, once for each block that needs them) are on disk at once.
CHECKPOINT_INTERVAL = 1


def blocks_for(ratings: int) -> int:
    """Blocks of users and of items for so many ratings: ten, unless those would hold too many each."""
    return max(BLOCKS, -(-ratings // BLOCK_RATINGS))


def fit_als(
    train: DataFrame,
    rank: int = 10,
    regParam: float = 0.1,
    alpha: float = 1.0,
    maxIter: int = 10,
    seed: int = 42,
    blocks: int | None = None,
    implicit: bool = False,
) -> ALSModel:
    """Fit factors on (user_idx, item_idx, rating).

    With ``implicit`` a rating is how often or how long something was used: a
    positive one is a preference, held with a confidence of 1 + ``alpha`` times it,
    and every pair without one is weakly taken for the lack of a preference.
    Otherwise ``alpha`` has no effect.  ``blocks`` cuts users and items; give the same number to get the
    same model.  Without it the number follows from that of the ratings, so that a task holds a
    bounded number of them, and the same ratings give the same model on any cluster.  Factors
    are checkpointed in the shared folder in every iteration: a lost executor does
    not replay the fit, and MLlib deletes an iteration's shuffle files with the next
    checkpoint, so a fit holds those of one iteration on disk, however many it has.
    """
    shared_folder(train.sparkSession)
    if blocks is None:
        blocks = blocks_for(train.count())
    als = ALS(
        userCol="user_idx",
        itemCol="item_idx",
        ratingCol="rating",
        rank=rank,
        regParam=regParam,
        alpha=alpha,
        implicitPrefs=implicit,
        maxIter=maxIter,
        seed=seed,
        numUserBlocks=blocks,
        numItemBlocks=blocks,
        coldStartStrategy="drop",
        checkpointInterval=CHECKPOINT_INTERVAL,
    )
    return als.fit(train)


def predict(model: ALSModel, pairs: DataFrame) -> DataFrame:
    """Score (user_idx, item_idx) pairs; pairs the fit has not seen are dropped.

    Factors are joined with the pairs' own key counts, so a user or item with
    very many pairs is sliced.
    """
    users = model.userFactors.select(F.col("id").alias("user_idx"), F.col("features").alias("_user"))
    items = model.itemFactors.select(F.col("id").alias("item_idx"), F.col("features").alias("_item"))
    scored = attach_counted(pairs, users, "user_idx")
    scored = attach_counted(scored, items, "item_idx", counted=pairs)
    score = dot(F.col("_user"), F.col("_item")).cast("float")
    return scored.select(*pairs.columns, score.alias("prediction"))


def predict_all(models: Sequence[ALSModel], pairs: DataFrame) -> DataFrame:
    """``predict`` of several models at once: (ordinal, the pairs' columns, prediction).

    The models' factors of a user or item are stacked in one row, so the pairs are
    joined to each side once however many models there are.  All models must know the
    same users and items, as fits on the same ratings do.
    """

    def stacked(side: str, key: str, name: str) -> DataFrame:
        factors = [getattr(model, side).select(F.col("id").alias(key), F.struct(F.lit(at).alias("ordinal"), "features").alias("one")) for at, model in enumerate(models)]
        rows = reduce(DataFrame.union, factors).groupBy(key).agg(F.sort_array(F.collect_list("one")).alias(name))
        return materialize(rows, f"stacked-{key}")

    users, items = stacked("userFactors", "user_idx", "_users"), stacked("itemFactors", "item_idx", "_items")
    scored = attach_counted(pairs, users, "user_idx")
    scored = attach_counted(scored, items, "item_idx", counted=pairs)
    each = F.zip_with("_users", "_items", lambda p, q: F.struct(p["ordinal"].alias("ordinal"), dot(p["features"], q["features"]).cast("float").alias("prediction")))
    return scored.select(*pairs.columns, F.explode(each).alias("one")).select("one.ordinal", *pairs.columns, "one.prediction")


def recommend_for_users(model: ALSModel, users: DataFrame, n: int = 10, seen: DataFrame | None = None) -> DataFrame:
    """(user_idx, rank, item_idx, score) for the requested ``user_idx`` values.

    Pairs (user_idx, item_idx) of ``seen`` are left out.
    """
    vectors = model.userFactors.select(F.col("id").alias("user_idx"), "features")
    items = model.itemFactors.select(F.col("id").alias("item_idx"), "features")
    wanted = vectors.join(users.select("user_idx").distinct(), "user_idx", "left_semi")
    return top_n(materialize(wanted, "wanted-users"), items, n, "user_idx", "item_idx", seen=seen)
