"""Joins of a large frame to a table with one row per key, safe under skew."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ratingloom.scratch import materialize

# Most rows of one key that a single join task should have to read.
SLICE_ROWS = 4_000_000


class KeyTable(NamedTuple):
    """A stored table, unique on its key.

    ``cnt`` is how many rows of the frame it will be joined to carry the key, or
    an upper bound; ``peak`` is the largest ``cnt``.  A table that has no ``cnt`` yet
    gives the one that has it by ``counted``, for those who need it.
    """

    rows: DataFrame
    peak: int
    counted: Callable[[], DataFrame] | None = None


def key_counts(rows: DataFrame, key: str) -> DataFrame:
    """Rows per key as ``cnt``; partial counts leave each task before the shuffle."""
    return rows.groupBy(key).agg(F.count("*").alias("cnt"))


def store_keys(table: DataFrame, label: str) -> KeyTable:
    """Store a keyed table; its peak is observed while it is written."""
    seen = Observation()
    stored = materialize(table.observe(seen, F.max("cnt").alias("peak")), label)
    return KeyTable(stored, seen.get.get("peak") or 0)


def attach(
    rows: DataFrame, table: KeyTable, key: str, how: str = "inner", slice_rows: int = SLICE_ROWS
) -> DataFrame:
    """Join ``rows`` to a keyed table.

    While no key exceeds ``slice_rows`` the join is left to Catalyst, which
    broadcasts the table when its stored size allows.  Otherwise each hot key is
    cut into ``cnt / slice_rows`` slices: its rows spread over the slices and
    its table row is repeated once per slice.  The list of hot keys has at most
    (all rows / slice_rows) entries, which bounds what is broadcast.
    """
    lookup = table.rows
    columns = list(rows.columns)
    if how not in ("left_semi", "left_anti"):
        columns += [name for name in lookup.columns if name not in (key, "cnt")]
    if table.peak <= slice_rows:
        return rows.join(lookup.drop("cnt"), key, how).select(columns)

    lookup = table.counted() if table.counted is not None else lookup
    slices = F.ceil(F.col("cnt") / slice_rows).cast("int")
    hot = lookup.where(F.col("cnt") > slice_rows).select(key, slices.alias("_slices"))
    # Copies of one row read by different tasks must not share a slice either,
    # hence the partition id next to the row's hash.
    spread = F.pmod(F.xxhash64(*rows.columns), F.lit(1 << 30)) + F.spark_partition_id()
    sliced_rows = (
        rows.withColumn("_spread", spread)
        .join(F.broadcast(hot), key, "left")
        .withColumn("_slice", F.coalesce(F.col("_spread") % F.col("_slices"), F.lit(0)).cast("int"))
        .drop("_spread", "_slices")
    )
    every_slice = F.explode(F.sequence(F.lit(0), F.greatest(slices, F.lit(1)) - 1))
    repeated = lookup.withColumn("_slice", every_slice).drop("cnt")
    return sliced_rows.join(repeated, [key, "_slice"], how).select(columns)


def attach_counted(
    rows: DataFrame,
    table: DataFrame,
    key: str,
    counted: DataFrame | None = None,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Inner join to a table unique on ``key``, sliced by the counts of the frame joined.

    ``counted`` is a cheaper frame with at least as many rows of every key.  Only
    where some key is hot are the counts kept and stored beside the table.
    """
    counts = key_counts(rows if counted is None else counted, key)
    peak = counts.agg(F.max("cnt")).first()[0] or 0

    def with_counts() -> DataFrame:
        return store_keys(table.drop("cnt").join(counts, key), f"counted-{key}").rows

    return attach(rows, KeyTable(table, peak, with_counts), key, slice_rows=slice_rows)
