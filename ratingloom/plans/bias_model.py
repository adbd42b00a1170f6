"""Damped mean ratings: a closed-form model whose grid search SQL can repeat."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratingloom.operators.lookup import KeyTable, attach_counted, store_keys
from ratingloom.scratch import side_by_side


def _sums(train: DataFrame, key: str, name: str) -> KeyTable:
    totals = train.groupBy(key).agg(F.sum("rating").alias(f"{name}_sum"), F.count("*").alias("cnt"))
    return store_keys(totals.withColumn(f"{name}_cnt", F.col("cnt")), f"{name}-sums")


@dataclass(frozen=True)
class RatingSums:
    """What every candidate's fit needs: rating sums of the training rows."""

    mean: float
    users: KeyTable
    items: KeyTable

    @classmethod
    def of(cls, train: DataFrame) -> RatingSums:
        users, items = side_by_side(
            train.sparkSession,
            partial(_sums, train, "user_idx", "user"),
            partial(_sums, train, "item_idx", "item"),
        )
        whole = users.rows.agg(F.sum("user_sum") / F.sum("cnt"))
        return cls(whole.first()[0], users, items)

    def attached(self, pairs: DataFrame) -> DataFrame:
        """Pairs with the sums of their user and item; those without are dropped."""
        scored = attach_counted(pairs, self.items.rows, "item_idx")
        return attach_counted(scored, self.users.rows, "user_idx", counted=pairs)

    def fit(self, train: DataFrame, item_damping: float, user_damping: float) -> BiasModel:
        return BiasModel(self, item_damping, user_damping)


@dataclass(frozen=True)
class BiasModel:
    """Global mean plus the user's and the item's mean deviation from it.

    A deviation is shrunk as if ``damping`` more average ratings existed.
    """

    sums: RatingSums
    item_damping: float
    user_damping: float

    def _bias(self, name: str, damping: float) -> Column:
        count = F.col(f"{name}_cnt")
        return (F.col(f"{name}_sum") - self.sums.mean * count) / (count + damping)

    def prediction(self) -> Column:
        """From the columns of a pair with the sums of its user and item."""
        biases = self._bias("item", self.item_damping) + self._bias("user", self.user_damping)
        return F.round(self.sums.mean + biases, 9).alias("prediction")

    def transform(self, pairs: DataFrame) -> DataFrame:
        """Add ``prediction``; pairs with an unseen user or item are dropped."""
        return self.sums.attached(pairs).select(*pairs.columns, self.prediction())


def predict_all(models: Sequence[BiasModel], pairs: DataFrame) -> DataFrame:
    """(ordinal, the pairs' columns, prediction) of models of the same sums, which are joined once."""
    each = F.array(*[F.struct(F.lit(at).alias("ordinal"), model.prediction()) for at, model in enumerate(models)])
    scored = models[0].sums.attached(pairs).select(*pairs.columns, F.explode(each).alias("one"))
    return scored.select("one.ordinal", *pairs.columns, "one.prediction")
