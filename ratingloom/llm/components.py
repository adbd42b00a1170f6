"""Connected components of an edge table, in rounds of joins and minima."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ratingloom.scratch import materialize


def _store(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """The distinct edges as a stored table, and a print of its content."""
    seen = Observation()
    digest = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    stored = materialize(edges.distinct().observe(seen, F.count("*").alias("n"), digest.alias("digest")), "edges")
    return stored, (seen.get["n"], seen.get["digest"])


def components(edges: DataFrame) -> DataFrame:
    """(id, component) for every id on an edge (u, v); component is the smallest id.

    Alternates large-star and small-star steps until nothing changes: each step
    hooks a node's neighbours to the smallest of them, so the graph turns into
    stars in a number of rounds that grows with the logarithm of its size.  The
    rounds' joins are on a node; the other side has one row per node, so a node
    with very many edges can be split.  Loops and repeated edges do no harm.
    """
    larger = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    current, mark = _store(larger)
    while mark[0]:
        both = current.union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("v")).select("u", F.least("u", "v").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = materialize(large.where("u <> v").distinct(), "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        hooked = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        following, new_mark = _store(hooked.union(least.select("u", F.col("m").alias("v"))))
        if new_mark == mark:
            break
        current, mark = following, new_mark
    members = current.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return members.union(current.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
