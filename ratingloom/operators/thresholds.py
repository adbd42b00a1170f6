"""Dropping users and items with too few ratings."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingloom.operators import k_core
from ratingloom.operators.lookup import SLICE_ROWS, KeyTable, attach, key_counts, store_keys
from ratingloom.scratch import materialize, side_by_side


def _frequent(ratings: DataFrame, key: str, minimum: int) -> KeyTable:
    counts = key_counts(ratings, key).where(F.col("cnt") >= minimum)
    return store_keys(counts, f"frequent-{key}")


def min_interactions(
    ratings: DataFrame, minimum: int = 5, slice_rows: int = SLICE_ROWS, iterations: int | None = 1
) -> DataFrame:
    """Ratings whose user and item both have at least ``minimum`` rows.

    By default both counts look at the input as given.  It is a single pass: what
    is left of a user may fall below the minimum once light items are gone.  More
    ``iterations`` repeat the pass on what the one before has left; None repeats it
    until nothing changes, which leaves the largest set of ratings in which every
    user and item has the minimum.

    ``ratings`` is read three times; pass a stored table when it is expensive.
    """
    if iterations != 1:
        nodes = materialize(k_core.surviving(ratings, minimum, iterations), "core")
        for key in ("user_id", "item_id"):
            keys = store_keys(k_core.keys_of(nodes, key, ratings.schema[key].dataType), f"core-{key}")
            ratings = attach(ratings, keys, key, "left_semi", slice_rows)
        return ratings
    users, items = side_by_side(
        ratings.sparkSession,
        partial(_frequent, ratings, "user_id", minimum),
        partial(_frequent, ratings, "item_id", minimum),
    )
    kept = attach(ratings, users, "user_id", "left_semi", slice_rows)
    return attach(kept, items, "item_id", "left_semi", slice_rows)
