"""Vector arithmetic on ``array`` columns without leaving the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(left: Column, right: Column) -> Column:
    products = F.zip_with(left, right, lambda a, b: a.cast("double") * b.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def norm(vector: Column) -> Column:
    return F.sqrt(dot(vector, vector))


def unit(vector: Column) -> Column:
    """``vector`` at length one, as doubles; a zero vector stays zero."""
    # The one-element array computes the norm once per vector, not once per element.
    scaled = F.transform(
        F.array(norm(vector)),
        lambda length: F.transform(
            vector, lambda x: F.when(length > 0, x / length).otherwise(x.cast("double"))
        ),
    )
    return F.get(scaled, F.lit(0))


def cosine(left: Column, right: Column) -> Column:
    """Cosine of the angle; zero when either vector is zero."""
    scale = norm(left) * norm(right)
    return F.when(scale > 0, dot(left, right) / scale).otherwise(0.0)
