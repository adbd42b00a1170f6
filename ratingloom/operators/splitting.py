"""Samples and train/validation splits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingloom.functions.scalars import falls_below

_PAIR = ("user_idx", "item_idx")


def bernoulli_sample(df: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    """Spark's row sample; a fraction outside (0, 1) keeps every row."""
    return df.sample(False, fraction, seed) if 0 < fraction < 1 else df


def hash_sample(
    df: DataFrame, fraction: float, seed: int = 42, keys: tuple[str, ...] = _PAIR
) -> DataFrame:
    """The same sample whatever the partitioning; copies of a key stay together."""
    if not 0 < fraction < 1:
        return df
    return df.where(falls_below(fraction, *map(F.col, keys), purpose="sample", seed=seed))


def mark_split(
    df: DataFrame, train_share: float = 0.8, seed: int = 42, keys: tuple[str, ...] = _PAIR
) -> DataFrame:
    """``df`` with ``in_train``, decided by the key's hash, independently of any sample."""
    return df.withColumn(
        "in_train", falls_below(train_share, *map(F.col, keys), purpose="split", seed=seed)
    )


def hash_split(
    df: DataFrame, train_share: float = 0.8, seed: int = 42, keys: tuple[str, ...] = _PAIR
) -> tuple[DataFrame, DataFrame]:
    """Train and validation parts by ``mark_split``."""
    marked = mark_split(df, train_share, seed, keys)
    return marked.where("in_train").drop("in_train"), marked.where("NOT in_train").drop("in_train")


def random_split(
    df: DataFrame, train_share: float = 0.8, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """Spark's own split; the outcome depends on the input's partitioning."""
    train, validation = df.randomSplit([train_share, 1 - train_share], seed)
    return train, validation
