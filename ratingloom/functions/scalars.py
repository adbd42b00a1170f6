"""Column expressions shared by the operators; all of them stay in codegen."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: a rating of at least this much counts as relevant.
RELEVANT_FROM = 4.0


def half_step(value: Column) -> Column:
    """``value`` rounded half-up to the nearest 0.5."""
    return F.round(2 * value) / 2


def relevance(rating: Column, threshold: float = RELEVANT_FROM) -> Column:
    return (rating >= threshold).cast("int")


def discounted(gain: Column, rank: Column) -> Column:
    """Gain at a 1-based rank under the binary-logarithm discount."""
    return gain / F.log2(1 + rank)


def ideal_gain(relevant: Column, k: int) -> Column:
    """Discounted gain of the best possible top ``k`` given the relevant rows.

    Gains are 0/1, so the ideal order depends on the count alone and needs no
    second ranking of the rows.
    """
    totals = [0.0]
    for rank in range(1, k + 1):
        totals.append(totals[-1] + 1 / math.log2(rank + 1))
    return F.get(F.lit(totals), F.least(relevant, F.lit(k)).cast("int"))


def ratio_or_zero(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(0.0)


def falls_below(share: float, *keys: Column, purpose: str, seed: int = 42) -> Column:
    """True for a ``share`` of all key tuples, decided by their md5 alone.

    Hex digests compare like the numbers they spell, so a share is one string
    comparison.  Partitioning, retries and row order have no influence.  Draws
    for different purposes are independent, whatever their seeds.
    """
    if not 0 <= share <= 1:
        raise ValueError("share must lie between 0 and 1")
    if share == 1:
        return F.lit(True)
    digest = F.md5(F.concat_ws("|", *keys, F.lit(purpose), F.lit(str(seed))))
    return digest < format(int(share * 2**32), "08x")


def label_or_index(label: Column, index: Column) -> Column:
    """The decoded id, or the index itself as text where no id is known."""
    return F.coalesce(label, index.cast("string"))
