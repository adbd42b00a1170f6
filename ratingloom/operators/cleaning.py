"""From whatever columns a review file has to (user_id, item_id, rating)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Accepted column names per field, in order of preference.
ALIASES: dict[str, tuple[str, ...]] = {
    "user_id": ("user_id", "reviewerID", "user", "userId"),
    "item_id": ("item_id", "asin", "item", "itemId"),
    "rating": ("rating", "overall", "stars", "score"),
}

# The time of a rating, for those who ask for it; seconds since 1970, or anything that orders.
TIME_ALIASES = ("rated_at", "unixReviewTime", "timestamp", "time")


def resolve_columns(present: Sequence[str]) -> dict[str, str]:
    """Which present column feeds each field."""
    chosen = {}
    for field, names in ALIASES.items():
        found = [name for name in names if name in present]
        if not found:
            raise ValueError(f"no column for {field}: expected one of {', '.join(names)}")
        chosen[field] = found[0]
    return chosen


def _typed(df: DataFrame, columns: Mapping[str, str] | None) -> DataFrame:
    source = columns or resolve_columns(df.columns)
    types = {"user_id": "string", "item_id": "string", "rating": "double"}
    return df.select(
        *[F.col(f"`{source[field]}`").try_cast(kind).alias(field) for field, kind in types.items()]
    )


def clean_ratings(df: DataFrame, columns: Mapping[str, str] | None = None) -> DataFrame:
    """Project, cast and keep complete rows; an unreadable rating is incomplete."""
    return _typed(df, columns).dropna()


def timed_ratings(df: DataFrame, columns: Mapping[str, str] | None = None) -> DataFrame:
    """The same rows with ``rated_at`` (bigint, null where there is none or none that can be read) and ``place``."""
    source = dict(columns or resolve_columns(df.columns))
    time = source.pop("rated_at", None) or next((name for name in TIME_ALIASES if name in df.columns), None)
    rated_at = F.lit(None).cast("bigint") if time is None else F.col(f"`{time}`").try_cast("double").cast("bigint")
    types = {"user_id": "string", "item_id": "string", "rating": "double"}
    fields = [F.col(f"`{source[field]}`").try_cast(kind).alias(field) for field, kind in types.items()]
    return df.select(*fields, rated_at.alias("rated_at"), "place").dropna(subset=list(types))


def rejected_count(df: DataFrame, columns: Mapping[str, str] | None = None) -> DataFrame:
    """One row with the input size, the kept rows and the rejected rows."""
    typed = _typed(df, columns)
    complete = (
        F.col("user_id").isNotNull()
        & F.col("item_id").isNotNull()
        & F.col("rating").isNotNull()
        & ~F.isnan("rating")
    )
    return typed.agg(
        F.count("*").alias("num_rows"),
        F.count_if(complete).alias("num_kept"),
        F.count_if(~complete).alias("num_rejected"),
    )
