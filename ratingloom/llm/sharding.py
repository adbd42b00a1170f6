"""A uniform shuffle into shards of exact sizes, by a communication matrix.

Rows lie in many source partitions.  How many rows of each go to each shard is
drawn first: row by row of the matrix, each a multivariate hypergeometric draw
from what the shards still lack, so that row sums are the partitions' sizes,
column sums the shards' sizes, and every assignment of rows to shards is equally
likely.  Then each partition is permuted by itself and cut along its counts, the
rows are exchanged, and each shard is permuted again.

Only DataFrame functions touch rows; the driver sees one count per source
partition, a fixed number of them, and draws the matrix from those.

Nulls and odd input: nulls are values like others.  Equal rows are told apart
by their place in the permutation, so each gets its own slot.  Columns named
shard or slot are replaced.  An empty table gives an empty result.
"""

from __future__ import annotations

import json
import math
import random
from itertools import accumulate

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratingloom.scratch import materialize

#: Source partitions, dealt by a hash; ranges into which a shard's second permutation is cut.
PARTITIONS, RANGES = 1024, 256
_DRAWS = 1 << 40


def hypergeometric(rng: random.Random, marked: int, others: int, drawn: int) -> int:
    """How many of ``drawn`` items out of ``marked`` and ``others`` are marked.

    Inversion from the mode outwards, so the steps taken grow with the standard
    deviation only.
    """
    low, high = max(0, drawn - others), min(marked, drawn)
    if low == high:
        return low

    def log_choose(n: int, k: int) -> float:
        return math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)

    mode = min(high, max(low, (drawn + 1) * (marked + 1) // (marked + others + 2)))
    chance = math.exp(log_choose(marked, mode) + log_choose(others, drawn - mode) - log_choose(marked + others, drawn))
    left = rng.random() - chance
    down, up, below, above = mode, mode, chance, chance
    while left > 0 and (down > low or up < high):
        if up < high:
            above *= (marked - up) * (drawn - up) / ((up + 1) * (others - drawn + up + 1))
            up += 1
            left -= above
            if left <= 0:
                return up
        if down > low:
            below *= down * (others - drawn + down) / ((marked - down + 1) * (drawn - down + 1))
            down -= 1
            left -= below
            if left <= 0:
                return down
    return mode


def communication_matrix(sizes: list[int], shards: int, seed: int) -> list[list[int]]:
    """Rows to send from each partition to each shard; shard sizes differ by one at most."""
    rng = random.Random(seed)
    total = sum(sizes)
    lacking = [total // shards + (s < total % shards) for s in range(shards)]
    matrix = []
    for size in sizes:
        row, rest = [], sum(lacking)
        for s in range(shards):
            rest -= lacking[s]
            sent = hypergeometric(rng, lacking[s], rest, size)
            row.append(sent)
            size -= sent
            lacking[s] -= sent
        matrix.append(row)
    return matrix


def into_shards(rows: DataFrame, shards: int, seed: int = 42, partitions: int = PARTITIONS) -> DataFrame:
    """``rows`` with shard and slot.  All columns decide the draws and travel along,
    so give wide rows by their keys and join the rest to the result."""
    kept = rows.drop("shard", "slot")
    packed = kept.select(F.struct("*").alias("row"))
    drawn = packed.withColumn("turn", F.pmod(F.xxhash64(F.lit(f"local-{seed}"), "row"), F.lit(_DRAWS)))
    drawn = materialize(drawn.withColumn("part", F.pmod(F.xxhash64(F.lit(f"part-{seed}"), "row"), F.lit(partitions)).cast("int")), "shuffle-rows")

    sizes = [0] * partitions
    for part in drawn.groupBy("part").agg(F.count("*").alias("cnt")).collect():
        sizes[part["part"]] = part["cnt"]
    matrix = communication_matrix(sizes, shards, seed)
    ends = json.dumps([list(accumulate(row)) for row in matrix])

    # A row's place in its permuted partition falls between two ends.
    local = Window.partitionBy("part").orderBy("turn", "row")
    table = F.from_json(F.lit(ends), "array<array<bigint>>")
    placed = drawn.withColumn("place", F.row_number().over(local) - 1).withColumn("ends", F.element_at(table, F.col("part") + 1))
    placed = placed.withColumn("shard", F.size(F.filter("ends", lambda end: end <= F.col("place"))))
    placed = placed.withColumn("turn", F.pmod(F.xxhash64(F.lit(f"shard-{seed}"), "row", "place"), F.lit(_DRAWS)))
    placed = placed.withColumn("range", F.floor(F.col("turn") / (_DRAWS // RANGES)).cast("int"))
    sent = materialize(placed.select("row", "turn", "shard", "range", "place"), "shuffle-sent")

    # Slots: those before in lower ranges of the shard, and the place in the own range.
    lower = Window.partitionBy("shard").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sent.groupBy("shard", "range").agg(F.count("*").alias("cnt"))
    starts = starts.select("shard", "range", F.coalesce(F.sum("cnt").over(lower), F.lit(0)).alias("start"))
    within = Window.partitionBy("shard", "range").orderBy("turn", "row", "place")
    slot = (F.row_number().over(within) - 1 + F.col("start")).cast("long")
    return sent.join(materialize(starts, "shuffle-starts"), ["shard", "range"]).withColumn("slot", slot).select("row.*", "shard", "slot")
