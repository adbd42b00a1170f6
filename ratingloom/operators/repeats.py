"""One rating per user and item where a user rated an item more than once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOW = ("max", "last", "avg")


def one_per_pair(ratings: DataFrame, how: str) -> DataFrame:
    """(user_id, item_id, rating): each pair's highest, latest or mean rating.

    The latest is the one of greatest ``rated_at``, unknown times before all known
    ones; among equal times it is the one that its files list last, by ``place``.
    All three are partial aggregates, so a pair with very many ratings is reduced
    in every task.
    """
    if how not in HOW:
        raise ValueError(f"unknown way {how}: use {', '.join(HOW)}")
    if how == "last":
        # Structs order by their first difference, false before true.
        asof = F.struct(F.col("rated_at").isNotNull(), "rated_at", "place")
        chosen = F.max_by("rating", asof)
    else:
        chosen = F.max("rating") if how == "max" else F.avg("rating")
    return ratings.groupBy("user_id", "item_id").agg(chosen.alias("rating"))
